"""Closed-form Spark expressions vs literal re-statements of the recursive rules.

The reference implementations below follow the recursion step by step
(one character or one separator at a time); the Spark side is the
closed form in bibspark.functions.text.  Checked on random strings built
from the characters the rules react to, plus non-ASCII and astral ones.
"""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from bibspark.functions import text as X

ALPHABET = list(".:,;/ []()&-uUaAbZ019\t\n=x") + ["é", "Ж", "𝄞", " and", " and ", "AE", "Æ", "ß", "'", "\""]


def _strings(n=1500, seed=7):
    rnd = random.Random(seed)
    out = ["", " ", "[", "]", "()", "author and", "editor,", ",", " and", "&", "1999", "19uu", "--"]
    for _ in range(n):
        k = rnd.randint(0, 14)
        out.append("".join(rnd.choice(ALPHABET) for _ in range(k)))
    return out


def ns(s):
    return " ".join(x for x in re.split(r"[ \t\r\n]+", s) if x)


def ref_chop(s, p=".:,;/ "):
    while s and s[-1] in p:
        s = s[:-1]
    return s


def ref_brackets(s, p=".:,;/ ", o="[", c="]"):
    s = ref_chop(s, p)
    if s[:1] == o:
        return ref_brackets(s[1:], p, o, c)
    if s[-1:] == c:
        return ref_brackets(s[:-1], p, o, c)
    return s


def ref_edtf(s):
    while "-" in s[:12]:
        i = s.index("-")
        s = s[:i] + "X" + s[i + 1:]
    date = s[0:4] + "-" + s[4:6] + ("-" + s[6:8] if s[6:8] != "" else "")
    time = "T" + s[8:10] + ":" + s[10:12] + ":00" if s[8:12] != "" else ""
    diff = s[12:15] + ":" + s[15:17] if s[12:17] != "" else ""
    return date + time + diff


ASCII = " !\"#$%&'()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\\]^_`abcdefghijklmnopqrstuvwxyz{|}~"


def ref_url(s):
    out = []
    for ch in s:
        if ch in X.URL_SAFE:
            out.append(ch)
        else:
            cp = ASCII.index(ch) + 32 if ch in ASCII else 63
            out.append("%" + "0123456789ABCDEF"[cp // 16] + "0123456789ABCDEF"[cp % 16])
    return "".join(out)


def ref_lcc(s):
    alpha, num = string.ascii_uppercase, string.digits

    def isin(ch, chars):
        return all(c in chars for c in ch)

    def c(i):
        return s[i - 1:i]
    if isin(c(1), alpha):
        if isin(c(2), alpha):
            if isin(c(3), alpha):
                return isin(c(4), num)
            return isin(c(3), num)
        return isin(c(2), num)
    return False


def ref_roles(s):
    if "," in s:
        before, after = s.split(",", 1)
        out = [ns(before)] if len(ns(before)) > 0 else []
        if len(ns(after)) > 0:
            out += ref_roles(after)
        return out
    for sep in (" and", "&"):
        if sep in s:
            before, after = s.split(sep, 1)
            out = [ns(before)] if len(ns(before)) > 0 else []
            return out + ref_roles(after)
    return [ns(s)]


def ref_u2x(s):
    return s.replace("u", "X").replace("U", "X")


def ref_parse041(s):
    return [s[i:i + 3] for i in range(0, len(s), 3) if len(s[i:i + 3]) == 3]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, s) for i, s in enumerate(_strings())]
    df = spark.createDataFrame(data, "i int, s string")
    out = df.select(
        "i", "s",
        X.chop_punct("s").alias("chop"), X.chop_brackets("s").alias("brackets"), X.chop_parens("s").alias("parens"),
        X.edtf_format("s").alias("edtf"), X.url_encode("s").alias("url"), X.lcc_valid("s").alias("lcc"),
        X.split_roles("s").alias("roles"), X.u2x("s").alias("u2x"), X.split_languages("s").alias("langs"),
        X.normalize_space("s").alias("ns"),
    ).collect()
    return out


@pytest.mark.parametrize("col,ref", [
    ("chop", ref_chop), ("brackets", ref_brackets),
    ("parens", lambda s: ref_brackets(s, o="(", c=")")), ("edtf", ref_edtf), ("url", ref_url),
    ("lcc", ref_lcc), ("roles", ref_roles), ("u2x", ref_u2x), ("langs", ref_parse041), ("ns", ns),
])
def test_closed_form_equals_recursion(rows, col, ref):
    bad = [(r["s"], r[col], ref(r["s"])) for r in rows if (list(r[col]) if isinstance(r[col], list) else r[col])
           != ref(r["s"])]
    assert bad == [], bad[:5]


def test_naco_key_examples(spark):
    df = spark.createDataFrame([("Æsop's [Fables]: vol. 2¹",), ("Þórr  &  ÐAVID",), ("ΑΒΓ straße",)], "s string")
    got = [r[0] for r in df.select(X.naco_key("s")).collect()]
    # precomposed letters (ó) are not in the table and stay as they are
    assert got == ["aesops fables vol 21", "thórr & david", "αβγ strasse"]


def test_no_python_udf_in_expressions(spark):
    df = spark.createDataFrame([("a",)], "s string").select(X.url_encode("s"), X.split_roles("s"), X.naco_key("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
