"""Quality rules, spelling variants and tokenizer alignment against brute force, with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bibspark.llm import alignment, quality_rules, queries, spelling

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "text string, doc_id long, words string, lines int, row string, n long, run string, pairs int, row_id long"


def docs_of(spark, texts, ids=None):
    """Documents with extra columns, some with names used inside."""
    ids = range(1, len(texts) + 1) if ids is None else ids
    return spark.createDataFrame([(t, i, "w", 1, "r", 2, "s", 3, 4) for t, i in zip(texts, ids, strict=True)], DOC)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 11: quality rules

def base_counts(text):
    text = text or ""
    ws = WORD.findall(text)
    wins = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    often, covered = Counter(wins), set()
    for i, w in enumerate(wins):
        if often[w] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(ws) < 20 or 100 * len(covered) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def gram_buckets(text):
    h = [zlib.crc32(w.encode()) for w in WORD.findall(text or "")]
    return [x % quality_rules.BUCKETS for x in h] + [((a * 31 + b) >> 14) % quality_rules.BUCKETS for a, b in zip(h, h[1:])]


def verdicts(docs, trusted):
    """docs: (doc_id, text) to kept, as the multinomials say."""
    raw, own = Counter(), Counter()
    for i, t in docs:
        raw.update(gram_buckets(t))
        if i in trusted:
            own.update(gram_buckets(t))
    n, m, size = sum(raw.values()), sum(own.values()), quality_rules.BUCKETS
    ratio = {}
    for b, c in raw.items():
        p = (c + 1) / (n + size)
        ratio[b] = math.floor(math.log(0.9 * ((own[b] + size * p) / (m + size)) / p + 0.1) * 1_000_000 + 0.5)
    out = []
    for _, t in docs:
        g = gram_buckets(t)
        out.append(not base_counts(t)[-1] and sum(ratio[b] for b in g) >= len(g) * -50_000)
    return out


def odd_texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(50)] + ["<b>", "é€", "a|b", "100%", " x", " "]
    made = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))) for _ in range(40)]
    loops = ["a b c d e f g h " * 4, "x " * 30, "one two three four five six seven eight " * 2 + "end", "l1 a\nl1 a\n\n \n\t\nl1 a\r\nl1 a \n"]
    long = " ".join(f"u{i % 9973}" for i in range(40_000))
    return [None, "", " \t\n\x0b\x0c\r ", "\x1c\x1d\x85word", *loops, *made, made[0], made[1], long]


def test_quality_rules_against_brute_force(spark):
    texts = odd_texts()
    ids = [None, *range(1, len(texts))]
    ids[-1] = ids[6]  # a repeated id
    labels = spark.createDataFrame([(i, i % 2) for i in range(4, 30)] + [(None, 1), (4, 1), (999, 1)], "doc_id long, label int")
    got = quality_rules.judged(docs_of(spark, texts, ids), labels).select(
        "row.text", "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "row.lines")
    trusted = {i for i in range(4, 30) if i % 2} | {4}
    kept = verdicts(list(zip(ids, texts, strict=True)), trusted)
    assert rows(got) == sorted([(t, i, *base_counts(t), k, 1) for i, t, k in zip(ids, texts, kept, strict=True)], key=repr)
    assert len(set(kept)) == 2


def test_quality_rules_filter_is_pushed_without_harm(spark):
    texts = [t for t in odd_texts() if t and len(t) < 2000]
    labels = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    got = quality_rules.judged(docs_of(spark, texts), labels)
    assert got.where("kept").count() == sum(r["kept"] for r in got.select("kept").collect())


def test_quality_rules_without_trusted_documents_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    text = " ".join(f"w{i}" for i in range(30))
    got = quality_rules.judged(docs_of(spark, [text, "short", None]), none).select("score", "kept")
    assert rows(got) == [(0, False), (0, True), (None, False)]
    assert rows(quality_rules.judged(docs_of(spark, []), none)) == []


def test_quality_rules_trusted_ids_have_a_bound(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("label"))
    assert quality_rules.trusted_ids(labels, 5000).count() == 5000
    assert abs(quality_rules.trusted_ids(labels, 500).count() - 500) < 100


def test_quality_rules_run_no_python(spark):
    plan = queries.QUERIES["op11_quality_rules"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_quality_rules_keep_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op11_quality_rules"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r["quality"]: r["share"] for r in got.where("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.97 and share[0] < 0.3


# 12: spelling variants

def variants(docs):
    counts = Counter()
    az = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(az)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                counts[w] += 1
    v = {w: n for w, n in counts.items() if n >= 3}
    near, cuts = defaultdict(set), defaultdict(set)
    for w in v:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1:]
            cuts[i, rest].add(w)
            if rest in v:
                near[w].add(rest)
                near[rest].add(w)
    for same in cuts.values():
        for a in same:
            near[a] |= same - {a}
    form = {}
    for w in v:
        best = min(near[w], key=lambda x: (-v[x], x), default=None)
        if best and v[best] >= 2 * v[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted([(w, form.get(w), root(w), n, len(near[w]), v[form[w]] if w in form else None) for w, n in v.items()], key=repr)


def test_spelling_variants_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = ["".join(rng.choice("abÀé") for _ in range(rng.randrange(4, 9))) for _ in range(250)]
        texts.append(rng.choice([" ", "-", "1", "\n"]).join(rng.choice([w, w.upper(), w.title()]) for w in words))
    texts += [None, "", "123 ×÷ \U0001f642", "abc abcd", "zzzzzzzz " * 20 + "zzzzzzz " * 9 + "zzzzzz " * 4, texts[0], texts[0]]
    ids = [None, *range(1, len(texts) - 2), 1, 1]
    got = rows(spelling.spelling_variants(docs_of(spark, texts, ids)))
    assert got == variants(list(zip(ids, texts, strict=True)))
    assert sum(r[4] for r in got) > 1000 and any(r[1] and r[2] != r[1] for r in got)


def test_spelling_variants_long_words_and_empty(spark):
    rng = random.Random(6)
    word = "".join(rng.choice("abcdefgh") for _ in range(3000))
    texts = [f"{word} {word[:17]}x{word[18:]} {word[:2900]}{word[2901:]} {word}y {word}"] * 3
    got = rows(spelling.spelling_variants(docs_of(spark, texts)))
    assert got == variants(list(enumerate(texts, 1))) and sum(r[4] for r in got) > 3
    assert rows(spelling.spelling_variants(docs_of(spark, [None, ""]))) == []
    assert rows(spelling.spelling_variants(docs_of(spark, []))) == []


@pytest.mark.parametrize("back", [False, True])
def test_partition_pairs_are_unique_and_complete(back):
    rng = random.Random(7)
    m, half = 7, "abc" if not back else "abca"
    rests = {"".join(rng.choice("ab") for _ in range(n)) for n in (m - len(half), m + 1 - len(half)) for _ in range(60)}
    words = sorted(r + half if back else half + r for r in rests)
    got = list(spelling.partition_pairs(half, back, m, words))
    assert len(got) == len({frozenset(p) for p in got})

    def one_edit(a, b):
        if len(a) == len(b):
            return len(a) == m and sum(x != y for x, y in zip(a, b)) == 1
        return len(b) < len(a) and any(a[:i] + a[i + 1:] == b for i in range(len(a))) and not (back and a[: m // 2] == b[: m // 2])

    assert {frozenset(p) for p in got} == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_acceptor_is_minimal():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abc") for _ in range(6)) for _ in range(200)})
    acceptor = spelling.Acceptor(words)

    def language(state):
        return frozenset([""]) if not acceptor.arcs[state] else frozenset(c + w for c, to in acceptor.arcs[state].items() for w in language(to))

    assert sorted(language(acceptor.start)) == words
    languages = [language(s) for s in range(len(acceptor.arcs))]
    assert len(set(languages)) == len(languages)


# 13: alignment

def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = public_tokenizers.path(queries.BYTE_FILE), public_tokenizers.path(queries.PIECE_FILE)
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a_path, b_path, a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def alignments(docs, a_model, b_model):
    """What the operator returns, with the libraries' tokens and groups cut at common ends."""
    from bibspark.llm.bpe import byte_chars

    byte = {c: i for i, c in enumerate(byte_chars())}
    found, counts = [], Counter()
    for i, t in docs:
        own = None
        if t:
            a, b = a_model.encode(" " + t, add_special_tokens=False).ids, b_model.encode(t)
            pieces = ([bytes(byte[c] for c in a_model.id_to_token(x)) for x in a],
                      [bytes([int(b_model.id_to_piece(x)[3:5], 16)]) if b_model.is_byte(x) else b_model.id_to_piece(x).replace("▁", " ").encode() for x in b])
            if b"".join(pieces[0]) == b"".join(pieces[1]) == (" " + t).encode():
                a_ends, b_ends = (np.cumsum([len(p) for p in x]).tolist() for x in pieces)
                said, links, lo_a, lo_b = [], [], 0, 0
                for cut in sorted(set(a_ends) & set(b_ends)):
                    hi_a, hi_b = a_ends.index(cut, lo_a) + 1, b_ends.index(cut, lo_b) + 1
                    said.append(",".join(map(str, a[lo_a:hi_a])) + "|" + ",".join(map(str, b[lo_b:hi_b])))
                    links.append((a[hi_a - 1], b[hi_b - 1]))
                    lo_a, lo_b = hi_a, hi_b
                counts.update(links)
                own = len(a), len(b), links, hashlib.sha256(";".join(said).encode()).hexdigest()
        found.append((i, own))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted([(i, 0, 0, 0, 0, 0, 0, "") if x is None else (
        i, x[0], x[1], len(x[2]), len(x[2]), sum(counts[k] == best[k[1]] for k in x[2]), sum(counts[k] for k in x[2]), x[3])
        for i, x in found], key=repr)


def test_alignment_against_libraries(spark):
    a_path, b_path, a, b = tokenizers()
    rng = random.Random(9)
    odd = [None, "", "a▁b", "<|endoftext|> <s></s> <unk> <0x41>", "  two  spaces\n\n\tx", "é日本語🙂🙂 zx", "ﬁ ½ Ⅳ ​́", " ", "\x00\x01", "don't WON'T we'll",
           "a" * 5000, "x " * 3000, "\n" * 2000 + "end", "".join(chr(rng.randrange(32, 0x3000)) for _ in range(3000))]
    made = ["".join(rng.choice("ab é,.1\n'sTll ") for _ in range(rng.randrange(200))) for _ in range(60)]
    texts = [*odd, *made, odd[3], made[0]]
    ids = [*range(1, len(texts) - 1), 4, None]
    got = rows(alignment.aligned(docs_of(spark, texts, ids), a_path, b_path))
    assert got == alignments(list(zip(ids, texts, strict=True)), a, b)


def test_alignment_of_a_table(spark):
    a_path, b_path, a, b = tokenizers()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert rows(queries.QUERIES["op13_alignment"](spark, SMALL)) == alignments(docs, a, b)


def test_alignment_of_nothing(spark):
    a_path, b_path, _, _ = tokenizers()
    assert rows(alignment.aligned(docs_of(spark, []), a_path, b_path)) == []
    zeros = (0, 0, 0, 0, 0, 0, "")
    assert rows(alignment.aligned(docs_of(spark, [None, "", "▁"]), a_path, b_path)) == [(i, *zeros) for i in (1, 2, 3)]


def test_pointer_jumping_labels_components():
    rng = np.random.default_rng(10)
    for _ in range(50):
        end = int(rng.integers(1, 200))
        a, b = (np.union1d(rng.integers(1, end + 1, rng.integers(0, 60)), [end]) for _ in range(2))
        got = alignment.grouped(a, b)
        cuts = np.intersect1d(a, b)
        assert got.of_a.tolist() == np.searchsorted(cuts, a).tolist()
        assert got.of_b.tolist() == np.searchsorted(cuts, b).tolist()
        assert a[got.last_a].tolist() == b[got.last_b].tolist() == cuts.tolist()
