"""Column expressions used by the rule jobs.

All are closed forms over built-in Spark SQL functions, so they stay
inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the conversion rules --------------------
PUNCT = ".:,;/ "            # default chopPunctuation set
URL_SAFE = "!'()*-.0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz~"
URL_UNSAFE_ASCII = "".join(chr(c) for c in range(32, 127) if chr(c) not in URL_SAFE)
BF = "http://id.loc.gov/ontologies/bibframe/"
BFLC = "http://id.loc.gov/ontologies/bflc/"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
MADSRDF = "http://www.loc.gov/mads/rdf/v1#"
XS = "http://www.w3.org/2001/XMLSchema#"
EDTF = "http://id.loc.gov/datatypes/edtf"
RELATORS = "http://id.loc.gov/vocabulary/relators/"
LANGUAGES = "http://id.loc.gov/vocabulary/languages/"
COUNTRIES = "http://id.loc.gov/vocabulary/countries/"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rtrim_set(s, chars: str) -> Column:
    """Strip trailing characters of ``chars`` (a set, not a pattern)."""
    return F.rtrim(_c(s), F.lit(chars))


def ltrim_set(s, chars: str) -> Column:
    return F.ltrim(_c(s), F.lit(chars))


def chop_punct(s, chars: str = PUNCT) -> Column:
    """X01 chopPunctuation: repeatedly drop a trailing char of the set."""
    return rtrim_set(s, chars)


def chop_brackets(s, chars: str = PUNCT) -> Column:
    """X02 chopBrackets: leading '[' and trailing ']' with the punctuation set."""
    return rtrim_set(ltrim_set(s, "["), chars + "]")


def chop_parens(s, chars: str = PUNCT) -> Column:
    """X03 chopParens: leading '(' and trailing ')' with the punctuation set."""
    return rtrim_set(ltrim_set(s, "("), chars + ")")


def u2x(s) -> Column:
    """Unknown digits u/U become X."""
    return F.translate(_c(s), "uU", "XX")


def edtf_format(s) -> Column:
    """X05 edtfFormat: '-' -> 'X' in the first 12 chars, then date[Thh:mm:00][+hh:mm]."""
    s = _c(s)
    d = F.concat(F.translate(F.substring(s, 1, 12), "-", "X"), F.substr(s, F.lit(13)))
    date_part = F.when(F.substring(d, 7, 2) != "",
                       F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))) \
        .otherwise(F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, 5, 2)))
    time_part = F.when(F.substring(d, 9, 4) != "",
                       F.concat(F.lit("T"), F.substring(d, 9, 2), F.lit(":"), F.substring(d, 11, 2), F.lit(":00"))) \
        .otherwise(F.lit(""))
    diff = F.when(F.substring(d, 13, 5) != "",
                  F.concat(F.substring(d, 13, 3), F.lit(":"), F.substring(d, 16, 2))).otherwise(F.lit(""))
    return F.concat(date_part, time_part, diff)


def url_encode(s) -> Column:
    """ASCII percent-encoding; non-ASCII (and control) chars become %3F.

    Closed form: '%' first, then every other unsafe printable ASCII char, then one
    regex for everything outside printable ASCII (one code point at a time, as the
    recursive rule).  All steps are code-generated string replaces; the inserted text
    is never re-encoded because '%' is handled before anything inserts one.
    """
    out = F.replace(_c(s), F.lit("%"), F.lit("%25"))
    for ch in URL_UNSAFE_ASCII:
        if ch != "%":
            out = F.replace(out, F.lit(ch), F.lit("%%%02X" % ord(ch)))
    return F.regexp_replace(out, r"[^\x20-\x7E]", "%3F")


def lcc_valid(s) -> Column:
    """X07 validateLCC (an exhausted string after 0-3 capitals also passes)."""
    return F.coalesce(_c(s), F.lit("")).rlike(r"^([A-Z]{1,3}[0-9]|[A-Z]{0,3}\z)")


def _after(s: Column, sep: str) -> Column:
    """XPath substring-after (empty when sep is absent)."""
    i = F.instr(s, sep)
    return F.when(i > 0, F.substr(s, i + len(sep))).otherwise(F.lit(""))


def _before(s: Column, sep: str) -> Column:
    """XPath substring-before (empty when sep is absent)."""
    i = F.instr(s, sep)
    return F.when(i > 0, F.substr(s, F.lit(1), i - 1)).otherwise(F.lit(""))


def control_number_source(s) -> Column:
    """X08 source part of a $0/$w: text between '(' and ')' as the stylesheet cuts it."""
    s = _c(s)
    n = F.greatest(F.length(_before(s, ")")) - 1, F.lit(0))
    return F.substr(_after(s, "("), F.lit(1), n)


def control_number_value(s) -> Column:
    """X08 value part: after ')' when a source was found, else the whole text."""
    s = _c(s)
    return F.when(control_number_source(s) != "", _after(s, ")")).otherwise(s)


def is_uri_value(s) -> Column:
    return F.instr(_c(s), "://") > 0


def uri_from_identifier(s) -> Column:
    """X09 core: '(uri)x' -> x, 'http...' -> itself, else null."""
    s = _c(s)
    return F.when(s.startswith("(uri)"), F.substr(s, F.lit(6))) \
        .when(s.startswith("http"), s)


def is_uri_identifier(s) -> Column:
    s = _c(s)
    return s.startswith("(uri)") | s.startswith("http")


def normalize_space(s) -> Column:
    """X22 XPath normalize-space."""
    return F.trim(F.regexp_replace(_c(s), r"[ \t\r\n]+", " "))


def split_roles(s) -> Column:
    """X10 splitRole -> array of role labels in order.

    Every comma part is a role (blank ones dropped); the last comma part is
    kept only when it is not blank (or there was no comma) and is split on
    ' and', whose last part is split on '&'; the very last piece is always
    emitted, even when empty.
    """
    s = _c(s)
    parts = F.split(s, ",", -1)
    n = F.size(parts)
    head = F.slice(parts, 1, n - 1)
    last = F.element_at(parts, -1)
    keep_last = (n == 1) | (F.length(normalize_space(last)) > 0)
    ands = F.split(last, " and", -1)
    na = F.size(ands)
    amps = F.split(F.element_at(ands, -1), "&", -1)
    nm = F.size(amps)

    def nonblank(a):
        return F.filter(F.transform(a, normalize_space), lambda x: x != "")

    tail = F.concat(nonblank(F.slice(ands, 1, na - 1)), nonblank(F.slice(amps, 1, nm - 1)),
                    F.array(normalize_space(F.element_at(amps, -1))))
    return F.concat(nonblank(head), F.when(keep_last, tail).otherwise(F.array().cast("array<string>")))


def split_languages(s) -> Column:
    """X11 parse041: whole 3-char chunks only."""
    s = _c(s)
    k = F.floor(F.length(s) / 3).cast("int")
    return F.when(k > 0, F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.substr(s, i * 3 + 1, F.lit(3)))) \
        .otherwise(F.array().cast("array<string>"))


# --- fixed values: codes of 045 time periods ---------------------------------
TIME_PERIODS = [
    ("a0", "-XXXX/-3000"), ("b0", "-29XX"), ("b1", "-28XX"), ("b2", "-27XX"), ("b3", "-26XX"),
    ("b4", "-25XX"), ("b5", "-24XX"), ("b6", "-23XX"), ("b7", "-22XX"), ("b8", "-21XX"),
    ("b9", "-20XX"), ("c0", "-19XX"), ("c1", "-18XX"), ("c2", "-17XX"), ("c3", "-16XX"),
    ("c4", "-15XX"), ("c5", "-14XX"), ("c6", "-13XX"), ("c7", "-12XX"), ("c8", "-11XX"),
    ("c9", "-10XX"), ("d0", "-09XX"), ("d1", "-08XX"), ("d2", "-07XX"), ("d3", "-06XX"),
    ("d4", "-05XX"), ("d5", "-04XX"), ("d6", "-03XX"), ("d7", "-02XX"), ("d8", "-01XX"),
    ("d9", "-00XX"), ("e", "00"), ("f", "01"), ("g", "02"), ("h", "03"),
    ("i", "04"), ("j", "05"), ("k", "06"), ("l", "07"), ("m", "08"),
    ("n", "09"), ("o", "10"), ("p", "11"), ("q", "12"), ("r", "13"),
    ("s", "14"), ("t", "15"), ("u", "16"), ("v", "17"), ("w", "18"),
    ("x", "19"), ("y", "20"),
]
# ---------------------------------------------------------------------------


def time_period_code(code) -> Column:
    """Code list of 045 time periods; null for any other code."""
    return F.try_element_at(F.create_map(*[F.lit(x) for row in TIME_PERIODS for x in row]), _c(code))


def _period_half(s: Column, pos: int) -> Column:
    c1 = F.substring(s, pos, 1)
    two = F.substring(s, pos, 2)
    return F.when(c1.isin("a", "b", "c", "d", "e"), F.coalesce(time_period_code(two), F.lit(""))) \
        .otherwise(F.concat(F.coalesce(time_period_code(c1), F.lit("")), F.substring(s, pos + 1, 1), F.lit("X")))


def time_period(s) -> Column:
    """X12 045 $a: two period codes; equal -> one, else a/b."""
    s = _c(s)
    d1, d2 = _period_half(s, 1), _period_half(s, 3)
    return F.when(d1 == d2, d1).otherwise(F.concat(d1, F.lit("/"), d2))


def time_date(s) -> Column:
    """X13 045 $b: c -> BCE year; yyyy[mm[dd[hh]]]."""
    s = _c(s)
    year = F.when(F.substring(s, 1, 1) == "c", F.concat(F.lit("-"), F.substring(s, 2, 4))) \
        .otherwise(F.substring(s, 2, 4))
    mo, dd, hh = F.substring(s, 6, 2), F.substring(s, 8, 2), F.substring(s, 10, 2)
    return (F.when(hh != "", F.concat(year, F.lit("-"), mo, F.lit("-"), dd, F.lit("T"), hh))
            .when(dd != "", F.concat(year, F.lit("-"), mo, F.lit("-"), dd))
            .when(mo != "", F.concat(year, F.lit("-"), mo))
            .otherwise(year))


def change_date(s) -> Column:
    """X14 005 -> xs:dateTime text."""
    s = _c(s)
    return F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2), F.lit("-"), F.substring(s, 7, 2),
                    F.lit("T"), F.substring(s, 9, 2), F.lit(":"), F.substring(s, 11, 2), F.lit(":"),
                    F.substring(s, 13, 2))


def creation_date(c008) -> Column:
    """X15 008/00-05 -> yyyy-mm-dd, yy < 50 -> 20yy (non-numeric -> 19yy)."""
    s = _c(c008)
    yy = F.substring(s, 1, 2)
    century = F.when(yy.try_cast("double") < 50, F.lit("20")).otherwise(F.lit("19"))
    return F.concat(century, yy, F.lit("-"), F.substring(s, 3, 2), F.lit("-"), F.substring(s, 5, 2))


def provision_date(c008) -> Column:
    """X16 008 provision date by date type (06), then u -> X."""
    s = _c(c008)
    t = F.substring(s, 7, 1)
    d1raw, d2raw = F.substring(s, 8, 4), F.substring(s, 12, 4)
    has1 = ~d1raw.isin("    ", "||||")
    has2 = ~d2raw.isin("    ", "||||")
    r = (F.when(t == "c", F.concat(d1raw, F.lit("/..")))
         .when(t.isin("d", "i", "k", "m", "q", "u") | ((t == "|") & has1 & has2),
               F.concat(d1raw, F.lit("/"), d2raw))
         .when(t == "e",
               F.when(F.substring(s, 14, 2) == "  ", F.concat(d1raw, F.lit("-"), F.substring(s, 12, 2)))
               .otherwise(F.concat(d1raw, F.lit("-"), F.substring(s, 12, 2), F.lit("-"), F.substring(s, 14, 2))))
         .when(t.isin("p", "r", "s", "t") | ((t == "|") & has1), d1raw))
    return u2x(r)


def pub_place(c008) -> Column:
    """X17 place code: 2 chars when 008/17 is blank, else 3."""
    s = _c(c008)
    return F.when(F.substring(s, 18, 1) == " ", F.substring(s, 16, 2)).otherwise(F.substring(s, 16, 3))


def sort_key(label, nonfiling) -> Column:
    """X18 title without its non-filing characters (indicator digit)."""
    n = F.coalesce(_c(nonfiling).try_cast("int"), F.lit(0))
    return F.substr(_c(label), n + 1)


def shelf_mark(a, b) -> Column:
    """$a $b joined with a space unless $b starts with '.'."""
    a, b = _c(a), _c(b)
    return F.when(b.isNull() | (b == ""), a) \
        .when(b.startswith("."), F.concat(a, b)).otherwise(F.concat(a, F.lit(" "), b))


def script_code(sf6) -> Column:
    """X20 script part of $6 (between the first and the second '/')."""
    rest = _after(_c(sf6), "/")
    return F.when(F.instr(rest, "/") > 0, _before(rest, "/")).otherwise(rest)


def script_name(sf6, lang008) -> Column:
    sc, lg = script_code(sf6), _c(lang008)
    return (F.when(sc == "(3", F.lit("arab")).when(sc == "(B", F.lit("latn"))
            .when((sc == "$1") & (lg == "kor"), F.lit("hang"))
            .when((sc == "$1") & (lg == "chi"), F.lit("hani"))
            .when((sc == "$1") & (lg == "jpn"), F.lit("jpan"))
            .when(sc == "(N", F.lit("cyrl")).when(sc == "(S", F.lit("grek"))
            .when(sc == "(2", F.lit("hebr")))


def issue_first(s) -> Column:
    """X23 first issue: before the first '-' (whole text when none)."""
    s = _c(s)
    return F.when(F.instr(s, "-") > 0, _before(s, "-")).otherwise(s)


def issue_last(s) -> Column:
    """X23 last issue: after the first '-' (empty when none)."""
    return _after(_c(s), "-")


def single_token(s) -> Column:
    """Normalised text has no inner space."""
    return F.instr(normalize_space(s), " ") == 0


def log_data_code(line) -> Column:
    """First '^' item starting with IQ or NQ (null when none)."""
    return F.try_element_at(F.filter(F.split(_c(line), r"\^"), lambda x: x.rlike("^(IQ|NQ)")), F.lit(1))


def is_org_code(s) -> Column:
    """850/852 $a shorter than 10 chars is an organisation code."""
    return F.length(_c(s)) < 10


def date_017(s) -> Column:
    """X27 017 $d yyyymmdd -> yyyy-mm-dd."""
    s = _c(s)
    return F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2), F.lit("-"), F.substring(s, 7, 2))


def node_text(obj, kind) -> Column:
    """URI -> its text; blank node and literal -> ''."""
    return F.when(_c(kind) == "uri", _c(obj)).otherwise(F.lit(""))


# --- fixed values: NACO normalisation character table (natural order) -----
NACO_DELETE = ("'[]\u02bc\u02be\u02bf\u044a\u042a\u044c\u042c"
               "\u0301\u0306\u0310\u0327\u030a\u0325\u0302\u0323\u0360\ufe22\ufe23\u0333\u0300"
               "\u030c\u0313\u0315\u0326\u0361\u0304\u0309\u031c\u0328\u0307\u0303\u0308\u0332\u032e")
NACO_BLANK = ("!\"()-{}<>;:.?¿¡,/\\*|%=±∓⁺⁻®©°^_`~·")
NACO_SUPER = "⁰¹²³⁴⁵⁶⁷⁸⁹"
NACO_SUB = "₀₁₂₃₄₅₆₇₈₉"
NACO_LETTER_FROM = "ĐđÐðİıŁłℓƠơƯưØø"
NACO_LETTER_TO = "DdDdIiLllOoUuOo"
NACO_MULTI = [("Æ", "AE"), ("æ", "ae"), ("Œ", "OE"), ("œ", "oe"),
              ("Þ", "TH"), ("þ", "th"), ("ẞ", "SS"), ("ß", "ss")]
NACO_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZΑΒΓ"
NACO_LOWER = "abcdefghijklmnopqrstuvwxyzαβγ"
# ---------------------------------------------------------------------------


def naco_translate_args() -> tuple[str, str]:
    """(from, to) of the single-char part; chars beyond ``to`` are deleted."""
    src = NACO_BLANK + NACO_SUPER + NACO_SUB + NACO_LETTER_FROM + NACO_DELETE
    dst = " " * len(NACO_BLANK) + "0123456789" * 2 + NACO_LETTER_TO
    return src, dst


def naco_key(s) -> Column:
    """X21 NACO normalisation: the table's replacements never feed each
    other, so one translate + the two-letter replacements equal the
    sequential walk; then A-Z and three Greek capitals are lowered."""
    src, dst = naco_translate_args()
    c = F.translate(_c(s), src, dst)
    for a, b in NACO_MULTI:
        c = F.replace(c, F.lit(a), F.lit(b))
    return normalize_space(F.translate(c, NACO_UPPER, NACO_LOWER))
