"""Queries for the rule jobs (fields -> triples) and record-level shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures
from ..functions import text as X
from ..plans import common as C
from ..plans import names as N
from . import query
from .expressions import _ns, _url_sql, sql_lit

BF, BFLC, RDF, RDFS = X.BF, X.BFLC, X.RDF, X.RDFS
TYPE, LABEL = RDF + "type", RDFS + "label"


def nested(fx: Fixtures):
    return fx.nested("fx_subfields")


def ruris(fx: Fixtures):
    return C.record_uris(fx.fx_records)


# ---- DuckDB fragments shared by the oracles ---------------------------------
R_CTE = f"r AS (SELECT record_id, '{C.BASE_URI}' || {_url_sql('c001')} AS ruri FROM fx_records)"


def nested_cte(name: str, where: str) -> str:
    return (f"{name} AS (SELECT record_id, ord, tag, ind1, ind2, list(struct_pack(sf_ord := sf_ord, code := code, "
            f"value := value) ORDER BY sf_ord) AS sfs FROM fx_subfields WHERE {where} GROUP BY record_id, ord, tag, ind1, ind2)")


def roles_sql(e: str) -> str:
    """DuckDB list of role labels of text ``e`` (splitRole)."""
    parts = f"string_split({e}, ',')"
    last = f"{parts}[len({parts})]"
    ands = f"string_split({last}, ' and')"
    amps = f"string_split({ands}[len({ands})], '&')"

    def nb(lst, n):
        return f"list_filter(list_transform(list_slice({lst}, 1, {n}), lambda x: {_ns('x')}), lambda x: x <> '')"
    tail = (f"list_concat({nb(ands, f'len({ands}) - 1')}, {nb(amps, f'len({amps}) - 1')}, "
            f"[{_ns(f'{amps}[len({amps})]')}])")
    return (f"list_concat({nb(parts, f'len({parts}) - 1')}, CASE WHEN len({parts}) = 1 OR length({_ns(last)}) > 0 "
            f"THEN {tail} ELSE [] END)")


def has_sql(code: str, sfs: str = "sfs") -> str:
    return f"len(list_filter({sfs}, lambda s: s.code = '{code}')) > 0"


def uri_sql(v: str) -> str:
    return f"CASE WHEN starts_with({v}, '(uri)') THEN substr({v}, 6) WHEN starts_with({v}, 'http') THEN {v} END"


def bn(rule: str, sf: str = "0", n: str = "1") -> str:
    return f"'_:' || record_id || '-' || CAST(ord AS VARCHAR) || '-' || CAST({sf} AS VARCHAR) || '-{rule}-' || CAST({n} AS VARCHAR)"


def triple_select(src: str, subj: str, pred: str, obj: str, kind: str = "'literal'", where: str = "",
                  lang: str = "NULL", datatype: str = "NULL") -> str:
    w = f" WHERE {where}" if where else ""
    return (f"SELECT record_id, {subj} AS subj, {pred} AS pred, CAST({obj} AS VARCHAR) AS obj, {kind} AS obj_kind, "
            f"CAST({lang} AS VARCHAR) AS lang, CAST({datatype} AS VARCHAR) AS datatype FROM {src}{w}")


def q(s: str) -> str:
    return sql_lit(s)


def finish(rule: str, selects: list[str]) -> str:
    body = "\n  UNION ALL ".join(selects)
    return (f"SELECT record_id, subj, pred, obj, obj_kind, lang, datatype, '{rule}' AS rule FROM (\n  {body}\n) z "
            f"WHERE obj IS NOT NULL AND subj IS NOT NULL")


# ---- R15 contributions ---------------------------------------------------------
_MARK = ("array_to_string(list_transform(sfs, lambda s: CASE WHEN s.code = 't' THEN 'T' WHEN s.code IN ('0', 'w') AND "
         "(starts_with(s.value, '(uri)') OR starts_with(s.value, 'http')) THEN 'Q' ELSE '-' END), '')")

_CONTRIB_PREP = f"""WITH {R_CTE},
{nested_cte('f', "tag IN ('100','110','111','700','710','711','720')")},
g AS (SELECT f.*, r.ruri, {_MARK} AS m FROM f JOIN r USING (record_id)),
h AS (SELECT *, instr(m, 'T') > 0 AS has_t, instr(m, 'Q') AS first_q, instr(m, 'T') AS pos_t,
        CASE WHEN regexp_matches(m, 'Q-*T') THEN length(regexp_extract(m, '^(.*?)Q-*T', 1)) + 1 ELSE 0 END AS agent_t FROM g),
h2 AS (SELECT *, CASE WHEN instr(substr(m, pos_t + 1), 'Q') > 0 THEN pos_t + instr(substr(m, pos_t + 1), 'Q') ELSE 0 END AS work_t FROM h),
u AS (SELECT *, CASE WHEN has_t THEN agent_t ELSE first_q END AS apos, CASE WHEN has_t THEN work_t ELSE first_q END AS wpos FROM h2),
v AS (SELECT *, {uri_sql('CASE WHEN apos > 0 THEN sfs[apos].value END')} AS auri,
        {uri_sql('CASE WHEN wpos > 0 THEN sfs[wpos].value END')} AS wuri FROM u),
x AS (SELECT record_id, ord, tag, ind2, sfs, ruri || '#Work' AS work,
        CASE WHEN coalesce(auri, '') <> '' THEN auri ELSE ruri || '#Agent' || tag || '-' || CAST(ord AS VARCHAR) END AS agent,
        CASE WHEN coalesce(wuri, '') <> '' THEN wuri ELSE ruri || '#Work' || tag || '-' || CAST(ord AS VARCHAR) END AS wiri,
        has_t, substr(tag, 1, 1) = '7' AS is7, {bn('contribution')} AS c,
        ((substr(tag, 3, 1) = '0' AND {has_sql('e')}) OR (substr(tag, 3, 1) = '1' AND {has_sql('j')}) OR {has_sql('4')}) AS from_sf
      FROM v),
rs AS (SELECT x.*, unnest(list_filter(sfs, lambda s: s.code = CASE WHEN substr(tag, 2, 2) = '11' THEN 'j' ELSE 'e' END)) AS s FROM x WHERE from_sf),
rl AS (SELECT *, s.sf_ord AS rsf, {roles_sql('s.value')} AS roles FROM rs),
ro AS (SELECT record_id, ord, c, rsf, generate_subscripts(roles, 1) AS n, unnest(roles) AS role FROM rl),
r4 AS (SELECT x.record_id, x.c, unnest(list_filter(sfs, lambda s: s.code = '4')) AS s FROM x WHERE from_sf),
ri AS (SELECT x.*, unnest(list_filter(sfs, lambda s: s.code = 'i')) AS s FROM x WHERE is7),
rr AS (SELECT *, {bn('relationship', 's.sf_ord')} AS rel, {bn('relation', 's.sf_ord')} AS rln FROM ri)
"""

_CONTRIB_SQL = _CONTRIB_PREP + finish("R15", [
    triple_select("x", "CASE WHEN is7 AND has_t THEN wiri ELSE work END", q(BF + "contribution"), "c", "'bnode'"),
    triple_select("x", "c", q(TYPE), q(BF + "Contribution"), "'uri'"),
    triple_select("x", "c", q(BF + "agent"), "agent", "'uri'"),
    triple_select("x", "c", q(TYPE), q(BFLC + "PrimaryContribution"), "'uri'", "substr(tag, 1, 1) = '1'"),
    triple_select("ro", "c", q(BF + "role"), bn("role", "rsf", "n"), "'bnode'"),
    triple_select("ro", bn("role", "rsf", "n"), q(TYPE), q(BF + "Role"), "'uri'"),
    triple_select("ro", bn("role", "rsf", "n"), q(LABEL), "role"),
    triple_select("ro", bn("role", "rsf", "n"), q(BFLC + "relatorMatchKey"), "rtrim(role, '.:,;/ ')"),
    triple_select("r4", "c", q(BF + "role"), f"{q(X.RELATORS)} || substr(s.value, 1, 3)", "'uri'"),
    triple_select("r4", f"{q(X.RELATORS)} || substr(s.value, 1, 3)", q(TYPE), q(BF + "Role"), "'uri'"),
    triple_select("x", "c", q(BF + "role"), q(X.RELATORS + "ctb"), "'uri'", "NOT from_sf"),
    triple_select("x", q(X.RELATORS + "ctb"), q(TYPE), q(BF + "Role"), "'uri'", "NOT from_sf"),
    triple_select("x", "work", f"CASE WHEN ind2 = '2' THEN {q(BF + 'hasPart')} ELSE {q(BF + 'relatedTo')} END", "wiri",
                  "'uri'", "is7 AND has_t"),
    triple_select("x", "wiri", q(TYPE), q(BF + "Work"), "'uri'", "is7 AND has_t"),
    triple_select("rr", "work", q(BFLC + "relationship"), "rel", "'bnode'"),
    triple_select("rr", "rel", q(TYPE), q(BFLC + "Relationship"), "'uri'"),
    triple_select("rr", "rel", q(BFLC + "relation"), "rln", "'bnode'"),
    triple_select("rr", "rln", q(TYPE), q(BFLC + "Relation"), "'uri'"),
    triple_select("rr", "rln", q(LABEL), "rtrim(s.value, '.:,;/ ')"),
    triple_select("rr", "rel", q(BF + "relatedTo"), "CASE WHEN has_t THEN wiri ELSE agent END",
                  "CASE WHEN has_t THEN 'uri' ELSE 'literal' END"),
])


@query("contributions", _CONTRIB_SQL)
def contributions(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return N.contributions(ruris(fx), nested(fx))


@query("mint_record_id", f"""
WITH a AS (SELECT DISTINCT record_id FROM fx_subfields),
c AS (SELECT record_id, count(*) AS n, min({_ns('value')}) AS v FROM fx_subfields WHERE tag = '490' AND code = 'a' GROUP BY record_id),
j AS (SELECT a.record_id, c.n, c.v FROM a LEFT JOIN c USING (record_id)),
m AS (SELECT record_id, CASE WHEN n = 1 AND {_url_sql('v')} <> '' THEN '{C.BASE_URI}' || {_url_sql('v')} END AS minted FROM j)
SELECT record_id, coalesce(minted, '{C.BASE_URI}r' || substr(sha256(record_id), 1, 16)) AS ruri, minted IS NULL AS generated FROM m""")
def mint_record_id(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return C.mint_record_id(fx.fx_subfields, idfield="490a")


# ---- rule-table families (R21 3XX properties, R23 / R22 notes, R11 identifiers) ----
from .. import fixture_more  # noqa: E402,F401  (registers fx_notes)
from ..functions import vocab as V  # noqa: E402
from ..plans import ruletable as RT  # noqa: E402


def _vals(rows, cols, alias):
    return V.values_sql(rows, cols).replace(" AS v(", f" AS {alias}(")


def _uris(fx):
    return C.record_uris(fx.fx_records)


def _subfield_rule_sql(rows, rule, src="fx_notes"):
    tags = ", ".join(sorted({f"'{r[0]}'" for r in rows}))
    node = f"'_:' || s.record_id || '-' || CAST(s.ord AS VARCHAR) || '-' || CAST(s.sf_ord AS VARCHAR) || '-{rule}-1'"
    prep = f"""{R_CTE},
s AS (SELECT * FROM {src} WHERE tag IN ({tags})),
side AS (SELECT record_id, ord,
    coalesce(list(struct_pack(sf_ord := sf_ord, value := value) ORDER BY sf_ord) FILTER (WHERE code = '3'), []) AS s3,
    coalesce(list(struct_pack(sf_ord := sf_ord, value := value) ORDER BY sf_ord) FILTER (WHERE code = '2'), []) AS s2
  FROM s WHERE code IN ('2', '3') GROUP BY record_id, ord),
h AS (SELECT s.record_id, s.ord, s.sf_ord, s.value, tb.prop, tb.cls,
        r.ruri || CASE WHEN tb.pass = 'work' THEN '#Work' ELSE '#Instance' END AS S, {node} AS B
      FROM s JOIN {_vals(rows, 'r_tag, r_code, pass, prop, cls', 'tb')} ON s.tag = tb.r_tag AND s.code = tb.r_code
      JOIN r ON r.record_id = s.record_id),
a3 AS (SELECT h.record_id, h.B, unnest(side.s3) AS x FROM h JOIN side USING (record_id, ord)),
a2 AS (SELECT h.record_id, h.B, unnest(side.s2) AS x FROM h JOIN side USING (record_id, ord))"""
    at = "B || '-appliesTo-' || CAST(x.sf_ord AS VARCHAR)"
    so = "B || '-source-' || CAST(x.sf_ord AS VARCHAR)"
    sels = [
        triple_select("h", "S", f"'{BF}' || prop", "B", "'bnode'"),
        triple_select("h", "B", q(TYPE), f"'{BF}' || cls", "'uri'"),
        triple_select("h", "B", q(LABEL), "value"),
        triple_select("a3", "B", q(BFLC + "appliesTo"), at, "'bnode'"),
        triple_select("a3", at, q(TYPE), q(BFLC + "AppliesTo"), "'uri'"),
        triple_select("a3", at, q(LABEL), "rtrim(x.value, '.:,;/ ')"),
        triple_select("a2", "B", q(BF + "source"), so, "'bnode'"),
        triple_select("a2", so, q(TYPE), q(BF + "Source"), "'uri'"),
        triple_select("a2", so, q(LABEL), "x.value"),
    ]
    return prep, sels


_P3_PREP, _P3_SELS = _subfield_rule_sql(RT.PROPERTY_3XX, "R21")


@query("property_map_3xx", f"WITH {_P3_PREP}\n" + finish("R21", _P3_SELS))
def property_map_3xx(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return RT.subfield_rules(spark, fx.fx_notes, _uris(fx), RT.PROPERTY_3XX, "R21")


def _note_label_sql(codes_col: str) -> str:
    return _ns(f"array_to_string(list_transform(list_filter(sfs, lambda s: instr({codes_col}, s.code) > 0), lambda s: s.value), ' ')")


_FUND = "CASE x.code " + " ".join(f"WHEN '{c}' THEN {q(k)}" for c, k in RT.FUNDING_CONSTANTS) + " END"

_INOTE_TAGS = [r[0] for r in RT.INSTANCE_NOTES + RT.INSTANCE_CONTENTS + RT.INSTANCE_AUDIENCE] + ["507", "524", "880"]
_LEVEL = "CASE ind1 " + " ".join(f"WHEN '{k}' THEN {q(v)}" for k, v in RT.AUDIENCE_NOTE) + " END"


def _inote_prep() -> str:
    return f"""{R_CTE},
{nested_cte('f', "tag IN (" + ", ".join(f"'{t}'" for t in _INOTE_TAGS) + ")").replace('fx_subfields', 'fx_instnotes')},
s6 AS (SELECT f.*, CASE WHEN f.tag = '880' THEN list_filter(sfs, lambda s: s.code = '6')[1].value END AS sf6, substr(h.c008, 36, 3) AS lang008
       FROM f JOIN fx_records h USING (record_id)),
k6 AS (SELECT s6.*, CASE WHEN tag = '880' THEN substr(sf6, 1, 3) ELSE tag END AS et, CASE WHEN instr(sf6, '/') > 0 THEN substr(sf6, instr(sf6, '/') + 1) ELSE '' END AS rest FROM s6),
c6 AS (SELECT k6.*, CASE WHEN instr(rest, '/') > 0 THEN substr(rest, 1, instr(rest, '/') - 1) ELSE rest END AS sc FROM k6),
n6 AS (SELECT c6.*, CASE WHEN sc = '(3' THEN 'arab' WHEN sc = '(B' THEN 'latn' WHEN sc = '$1' AND lang008 = 'kor' THEN 'hang'
        WHEN sc = '$1' AND lang008 = 'chi' THEN 'hani' WHEN sc = '$1' AND lang008 = 'jpn' THEN 'jpan' WHEN sc = '(N' THEN 'cyrl'
        WHEN sc = '(S' THEN 'grek' WHEN sc = '(2' THEN 'hebr' END AS script, lm.xl FROM c6
      LEFT JOIN {_vals(LANGUAGE_MAP, 'iso, xl', 'lm')} ON lm.iso = c6.lang008),
e AS (SELECT n6.*, CASE WHEN tag = '880' AND coalesce(xl, '') <> '' AND coalesce(script, '') <> '' THEN xl || '-' || script END AS lang,
        r.ruri || '#Instance' AS I FROM n6 JOIN r USING (record_id)),
g AS (SELECT e.*, nt.codes, coalesce(it.itype, nt.ntype) AS ty, {bn('note')} AS N
      FROM e JOIN {_vals(RT.INSTANCE_NOTES, 'n_tag, codes, ntype', 'nt')} ON nt.n_tag = e.et
      LEFT JOIN {_vals(RT.INSTANCE_NOTE_IND1, 'i_tag, i_ind1, itype', 'it')} ON it.i_tag = e.et AND it.i_ind1 = e.ind1),
l AS (SELECT *, {_note_label_sql('codes')} AS lbl FROM g),
x AS (SELECT l.record_id, l.et AS tag, l.N, l.I, l.lang, unnest(l.sfs) AS x FROM l),
ce AS (SELECT e.*, ct.prop, ct.cls, coalesce(ct.codes, 'ab') AS codes, {bn('contents')} AS N
       FROM e LEFT JOIN {_vals(RT.INSTANCE_CONTENTS, 'c_tag, codes, prop, cls', 'ct')} ON ct.c_tag = e.et WHERE et IN ('505', '506', '507', '538', '540')),
cl AS (SELECT *, {_note_label_sql('codes')} AS lbl FROM ce),
cx AS (SELECT record_id, et AS tag, N, lang, unnest(sfs) AS x FROM ce),
ae AS (SELECT e.*, au.prop, au.cls, {_LEVEL} AS lvl, unnest(list_filter(sfs, lambda s: s.code = 'a')) AS x
       FROM e LEFT JOIN {_vals(RT.INSTANCE_AUDIENCE, 'c_tag, prop, cls', 'au')} ON au.c_tag = e.et WHERE et IN ('521', '525') OR tag = '524'),
an AS (SELECT *, {bn('audience', 'x.sf_ord')} AS N FROM ae),
ax AS (SELECT record_id, N, lang, unnest(sfs) AS x FROM an WHERE et = '521')"""


def _appended_sql(src: str, codes: str, where: str) -> list[str]:
    k = "CAST(x.sf_ord AS VARCHAR)"
    at, ins = f"N || '-appliesTo-' || {k}", f"N || '-institution-' || {k}"
    rows = {"u": [triple_select(src, "N", q(LABEL), "x.value", "'literal'", f"x.code = 'u' AND {where}", datatype=q(X.XS + "anyURI"))],
            "3": [triple_select(src, "N", q(BFLC + "appliesTo"), at, "'bnode'", f"x.code = '3' AND {where}"),
                  triple_select(src, at, q(TYPE), q(BFLC + "AppliesTo"), "'uri'", f"x.code = '3' AND {where}"),
                  triple_select(src, at, q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", f"x.code = '3' AND {where}", lang="lang")],
            "5": [triple_select(src, "N", q(BFLC + "applicableInstitution"), ins, "'bnode'", f"x.code = '5' AND {where}"),
                  triple_select(src, ins, q(TYPE), q(BF + "Agent"), "'uri'", f"x.code = '5' AND {where}"),
                  triple_select(src, ins, q(BF + "code"), "x.value", "'literal'", f"x.code = '5' AND {where}")]}
    return [t for c in codes for t in rows[c]]


def _named_sql(src: str, kind: str, prop: str, cls: str, label: str, where: str) -> list[str]:
    n = f"N || '-{kind}-' || CAST(x.sf_ord AS VARCHAR)"
    return [triple_select(src, "N", q(BF + prop), n, "'bnode'", where), triple_select(src, n, q(TYPE), q(BF + cls), "'uri'", where),
            triple_select(src, n, q(LABEL), label, "'literal'", where, lang="lang")]


_CHOPPED = "rtrim(x.value, '.:,;/ ')"
_INOTE_SELS = [
    triple_select("l", "I", q(BF + "note"), "N", "'bnode'"),
    triple_select("l", "N", q(TYPE), q(BF + "Note"), "'uri'"),
    triple_select("l", "N", q(LABEL), "lbl", "'literal'", "lbl <> ''", lang="lang"),
    triple_select("l", "N", q(BF + "noteType"), "ty", "'literal'", "ty IS NOT NULL"),
    triple_select("x", "N", q(BF + "count"), "x.value", "'literal'", "tag = '504' AND x.code = 'b'"),
    triple_select("x", "N", q(LABEL), f"{_FUND} || x.value", "'literal'", "tag = '536' AND x.code IN ('b','c','d','e','f','g','h')", lang="lang"),
    triple_select("x", "N", q(BF + "identifiedBy"), "N || '-isbn-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'", "tag = '581' AND x.code = 'z'"),
    triple_select("x", "N || '-isbn-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Isbn"), "'uri'", "tag = '581' AND x.code = 'z'"),
    triple_select("x", "N || '-isbn-' || CAST(x.sf_ord AS VARCHAR)", q(RDF + "value"), "x.value", "'literal'", "tag = '581' AND x.code = 'z'"),
    *_appended_sql("x", "u35", "TRUE"),
    triple_select("cl", "I", q(BF + "scale"), "lbl", "'literal'", "et = '507'", lang="lang"),
    triple_select("cl", "I", f"'{BF}' || prop", "N", "'bnode'", "et <> '507'"),
    triple_select("cl", "N", q(TYPE), f"'{BF}' || cls", "'uri'", "et <> '507'"),
    triple_select("cl", "N", q(LABEL), "lbl", "'literal'", "et IN ('505', '506')", lang="lang"),
    triple_select("cx", "N", q(LABEL), "x.value", "'literal'", "tag = '538' AND x.code = 'a'", lang="lang"),
    triple_select("cx", "N", q(LABEL), _CHOPPED, "'literal'", "tag = '540' AND x.code = 'a'", lang="lang"),
    *_named_sql("cx", "source", "source", "Source", _CHOPPED, "tag = '540' AND x.code = 'c'"),
    *_named_sql("cx", "users", "note", "Note", f"{q(RT.AUTHORIZED)} || {_CHOPPED}", "tag = '540' AND x.code = 'd'"),
    *_appended_sql("cx", "u35", "tag IN ('506', '538', '540')"),
    triple_select("an", "I", q(BF + "preferredCitation"), "x.value", "'literal'", "et = '524'", lang="lang"),
    triple_select("an", "I", f"'{BF}' || prop", "N", "'bnode'", "et <> '524'"),
    triple_select("an", "N", q(TYPE), f"'{BF}' || cls", "'uri'", "et <> '524'"),
    triple_select("an", "N", q(LABEL), "x.value", "'literal'", "et <> '524'", lang="lang"),
    triple_select("an", "N", q(BF + "note"), "N || '-level'", "'bnode'", "et = '521' AND lvl IS NOT NULL"),
    triple_select("an", "N || '-level'", q(TYPE), q(BF + "Note"), "'uri'", "et = '521' AND lvl IS NOT NULL"),
    triple_select("an", "N || '-level'", q(LABEL), "lvl", "'literal'", "et = '521' AND lvl IS NOT NULL"),
    *_named_sql("ax", "source", "source", "Source", "x.value", "x.code = 'b'"),
    *_appended_sql("ax", "3", "TRUE"),
]

from ..fixtures import register_extra  # noqa: E402
from ..plans.convert import LANGUAGES as LANGUAGE_MAP  # noqa: E402

register_extra("fx_allnotes", """
SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM fx_subfields
UNION ALL SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM fx_notes
""")

# contents, policies, scale, audience, citation, supplement and system, and 880s linked to them and to a note
register_extra("fx_instnotes", """
SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM fx_allnotes
UNION ALL SELECT 'ord' || CAST(l_orderkey AS STRING), t.ord, t.tag, CASE WHEN t.tag = '521' THEN substr('0128 ', CAST(l_orderkey % 5 AS INT) + 1, 1) ELSE ' ' END,
  ' ', t.sf_ord, t.code, CASE t.code WHEN '6' THEN t.link || substr('01/(N01/(B01/$101   ', CAST(l_orderkey % 4 AS INT) * 5 + 1, 5) WHEN 'u' THEN 'http://example.org/p/' || CAST(l_orderkey AS STRING)
    WHEN '5' THEN 'INST' WHEN '3' THEN 'v. ' || CAST(p_size AS STRING) || ':' ELSE t.code || ' ' || p_name || ' ;' END
FROM fx_lines CROSS JOIN (SELECT 1001 AS ord, '505' AS tag, 1 AS sf_ord, 'a' AS code, '' AS link
  UNION ALL SELECT 1001, '505', 2, 'r', '' UNION ALL SELECT 1001, '505', 3, 't', '' UNION ALL SELECT 1002, '506', 1, 'a', ''
  UNION ALL SELECT 1002, '506', 2, 'c', '' UNION ALL SELECT 1002, '506', 3, 'u', '' UNION ALL SELECT 1002, '506', 4, '3', ''
  UNION ALL SELECT 1002, '506', 5, '5', '' UNION ALL SELECT 1003, '507', 1, 'a', '' UNION ALL SELECT 1003, '507', 2, 'b', ''
  UNION ALL SELECT 1004, '521', 1, 'a', '' UNION ALL SELECT 1004, '521', 2, 'a', '' UNION ALL SELECT 1004, '521', 3, 'b', ''
  UNION ALL SELECT 1004, '521', 4, '3', '' UNION ALL SELECT 1005, '524', 1, 'a', '' UNION ALL SELECT 1006, '525', 1, 'a', ''
  UNION ALL SELECT 1007, '538', 1, 'a', '' UNION ALL SELECT 1007, '538', 2, 'u', '' UNION ALL SELECT 1007, '538', 3, '5', ''
  UNION ALL SELECT 1008, '540', 1, 'a', '' UNION ALL SELECT 1008, '540', 2, 'c', '' UNION ALL SELECT 1008, '540', 3, 'd', ''
  UNION ALL SELECT 1008, '540', 4, '3', '' UNION ALL SELECT 1009, '880', 1, '6', '505-' UNION ALL SELECT 1009, '880', 2, 'a', '505-'
  UNION ALL SELECT 1010, '880', 1, '6', '540-' UNION ALL SELECT 1010, '880', 2, 'c', '540-' UNION ALL SELECT 1011, '880', 1, '6', '524-'
  UNION ALL SELECT 1011, '880', 2, 'a', '524-' UNION ALL SELECT 1012, '880', 1, '6', '536-' UNION ALL SELECT 1012, '880', 2, 'a', '536-'
  UNION ALL SELECT 1012, '880', 3, 'c', '536-' UNION ALL SELECT 1013, '880', 1, '6', '521-' UNION ALL SELECT 1013, '880', 2, 'a', '521-') t
WHERE n = 1 AND (l_orderkey + t.ord) % 9 = 0 AND (t.code NOT IN ('3', 'u', '5') OR l_orderkey % 2 = 0)
""")


@query("instance_notes", f"WITH {_inote_prep()}\n" + finish("R23", _INOTE_SELS))
def instance_notes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return RT.instance_notes(spark, fx.nested("fx_instnotes", linked=True), _uris(fx))


_WN_SF = [(t, c, "work", p, k) for t, c, p, k in RT.WORK_NOTE_SUBFIELDS]
_WN_PREP, _WN_SELS = _subfield_rule_sql(_WN_SF, "R22")
_WNOTE_PREP = _WN_PREP + f""",
{nested_cte('wf', "tag IN (" + ", ".join(f"'{r[0]}'" for r in RT.WORK_NOTES) + ")").replace('fx_subfields', 'fx_notes')},
wg AS (SELECT wf.*, wn.codes, wn.prop AS wprop, wn.cls AS wcls, r.ruri || '#Work' AS W, {bn('worknote')} AS N
       FROM wf JOIN {_vals(RT.WORK_NOTES, 'w_tag, codes, prop, cls', 'wn')} ON wn.w_tag = wf.tag JOIN r USING (record_id)),
wl AS (SELECT *, {_note_label_sql('codes')} AS lbl FROM wg),
cr AS (SELECT n.record_id, r.ruri || '#Work' AS W, CASE WHEN n.tag = '511' AND n.ind1 = '1' THEN 'Cast: ' ELSE '' END || n.value AS v
       FROM fx_notes n JOIN r USING (record_id) WHERE n.tag IN ('508', '511') AND n.code = 'a')"""

_WNOTE_SELS = _WN_SELS + [
    triple_select("wl", "W", f"'{BF}' || wprop", "N", "'bnode'"),
    triple_select("wl", "N", q(TYPE), f"'{BF}' || wcls", "'uri'"),
    triple_select("wl", "N", q(LABEL), "lbl", "'literal'", "lbl <> ''"),
    triple_select("cr", "W", q(BF + "credits"), "v"),
]


@query("work_notes", f"WITH {_WNOTE_PREP}\n" + finish("R22", _WNOTE_SELS))
def work_notes(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return RT.work_notes(spark, fx.nested("fx_notes"), fx.fx_notes, _uris(fx))


_ID_TAGS = ", ".join(sorted({f"'{r[0]}'" for r in RT.IDENTIFIER_CLASS}))
_IDS_PREP = f"""{R_CTE},
{nested_cte('f', f"tag IN ({_ID_TAGS})").replace('fx_subfields', 'fx_notes')},
c AS (SELECT f.*, coalesce(ex.cls, st.cls) AS id_cls, r.ruri || '#Instance' AS I FROM f
      LEFT JOIN {_vals([r for r in RT.IDENTIFIER_CLASS if r[1] != '*'], 'c_tag, c_ind1, cls', 'ex')} ON ex.c_tag = f.tag AND ex.c_ind1 = f.ind1
      LEFT JOIN {_vals([r for r in RT.IDENTIFIER_CLASS if r[1] == '*'], 'c_tag, c_ind1, cls', 'st')} ON st.c_tag = f.tag
      JOIN r USING (record_id)),
i AS (SELECT c.*, unnest(list_filter(sfs, lambda s: s.code IN ('a', 'y', 'z'))) AS s FROM c),
j AS (SELECT record_id, tag, sfs, I, id_cls, s.code AS code,
        CASE WHEN tag = '035' AND instr(s.value, ')') > 0 THEN substr(s.value, instr(s.value, ')') + 1)
          WHEN tag = '020' THEN rtrim(s.value, '.:,;/ ') ELSE s.value END AS vid,
        '_:' || record_id || '-' || CAST(ord AS VARCHAR) || '-' || CAST(s.sf_ord AS VARCHAR) || '-identifier-1' AS B,
        list_filter(sfs, lambda y: y.code = 'd')[1].value AS d017 FROM i),
k AS (SELECT j.record_id, j.B, unnest(list_filter(sfs, lambda s: s.code IN ('c', 'q'))) AS x FROM j)"""

_IDS_SELS = [
    triple_select("j", "I", q(BF + "identifiedBy"), "B", "'bnode'"),
    triple_select("j", "B", q(TYPE), f"'{BF}' || id_cls", "'uri'"),
    triple_select("j", "B", q(RDF + "value"), "vid"),
    triple_select("j", "B", q(BF + "status"), "B || '-status'", "'bnode'", "code IN ('y', 'z')"),
    triple_select("j", "B || '-status'", q(TYPE), q(BF + "Status"), "'uri'", "code IN ('y', 'z')"),
    triple_select("j", "B || '-status'", q(LABEL), "CASE WHEN code = 'y' THEN 'incorrect' WHEN tag = '022' THEN 'canceled' ELSE 'invalid' END", "'literal'",
                  "code IN ('y', 'z')"),
    triple_select("k", "B", f"CASE WHEN x.code = 'c' THEN {q(BF + 'acquisitionTerms')} ELSE {q(BF + 'qualifier')} END",
                  "rtrim(x.value, ':,;/ ')"),
    triple_select("j", "B", q(BF + "date"), "substr(d017, 1, 4) || '-' || substr(d017, 5, 2) || '-' || substr(d017, 7, 2)",
                  "'literal'", "tag = '017' AND d017 IS NOT NULL AND d017 <> ''", datatype=q(X.XS + "date")),
]


@query("instance_ids", f"WITH {_IDS_PREP}\n" + finish("R11", _IDS_SELS))
def instance_ids(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return RT.instance_ids(spark, fx.fx_notes, fx.nested("fx_notes"), _uris(fx))


# ---- R18 titles ------------------------------------------------------------------
from ..plans import titles as TI  # noqa: E402


def _spaced_sql(codes: str) -> str:
    cs = ", ".join(f"'{c}'" for c in codes)
    return f"array_to_string(list_transform(list_filter(sfs, lambda s: s.code IN ({cs})), lambda s: s.value || ' '), '')"


def _parts_sql(src: str, parts: dict[str, str]) -> list[str]:
    return [triple_select(src, "T", q(BF + prop), "rtrim(x.value, '.:,;/ ')", "'literal'", f"x.code = '{code}'")
            for code, prop in parts.items()]


_T245_PREP = f"""{R_CTE},
{nested_cte('f', "tag = '245'")},
u AS (SELECT DISTINCT record_id FROM fx_subfields WHERE tag IN ('130', '240')),
g AS (SELECT f.*, r.ruri || '#Work' AS W, r.ruri || '#Instance' AS I, {bn('worktitle')} AS Tw, {bn('instancetitle')} AS Ti,
        u.record_id IS NOT NULL AS has_uniform, {_spaced_sql('abfgknps')} AS L
      FROM f JOIN r USING (record_id) LEFT JOIN u USING (record_id)),
k AS (SELECT *, CASE WHEN TRY_CAST(ind2 AS INT) IS NULL THEN ''
        ELSE substr(L, TRY_CAST(ind2 AS INT) + 1, greatest(length(L) - TRY_CAST(ind2 AS INT) - 1, 0)) END AS key FROM g),
t2 AS (SELECT record_id, W AS owner, Tw AS T, L, key, sfs FROM k WHERE NOT has_uniform
       UNION ALL SELECT record_id, I, Ti, L, key, sfs FROM k),
p AS (SELECT record_id, T, unnest(sfs) AS x FROM t2),
c AS (SELECT record_id, I, unnest(sfs) AS x FROM k)"""

_T245_SELS = [
    triple_select("t2", "owner", q(BF + "title"), "T", "'bnode'"),
    triple_select("t2", "T", q(TYPE), q(BF + "Title"), "'uri'"),
    triple_select("t2", "owner", q(LABEL), _ns("L"), "'literal'", "L <> ''"),
    triple_select("t2", "T", q(LABEL), "substr(L, 1, greatest(length(L) - 1, 0))", "'literal'", "L <> ''"),
    triple_select("t2", "T", q(BFLC + "titleSortKey"), "key", "'literal'", "L <> ''"),
    triple_select("c", "I", q(BF + "responsibilityStatement"), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = 'c'"),
] + _parts_sql("p", {"a": "mainTitle", "b": "subtitle", "n": "partNumber", "p": "partName"})


@query("title_parts", f"WITH {_T245_PREP}\n" + finish("R18", _T245_SELS))
def title_parts(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return TI.title_245(fx.nested("fx_subfields"), ruris(fx))


_VT = " ".join(f"WHEN '{k}' THEN {q(v)}" for k, v in TI.VARIANT_246)
_T246_PREP = f"""{R_CTE},
{nested_cte('f', "tag = '246'").replace('fx_subfields', 'fx_notes')},
g AS (SELECT f.*, r.ruri || '#Instance' AS I, {bn('varianttitle')} AS T, {_spaced_sql('abginp')} AS L, {_spaced_sql('abgnp')} AS S,
        CASE ind2 {_VT} END AS vtype
      FROM f JOIN r USING (record_id)),
p AS (SELECT record_id, T, unnest(sfs) AS x FROM g)"""

_T246_SELS = [
    triple_select("g", "I", q(BF + "title"), "T", "'bnode'"),
    triple_select("g", "T", q(TYPE), q(BF + "Title"), "'uri'"),
    triple_select("g", "T", q(TYPE), q(BF + "VariantTitle"), "'uri'"),
    triple_select("g", "T", q(TYPE), q(BF + "ParallelTitle"), "'uri'", "ind2 = '1'"),
    triple_select("g", "T", q(BF + "variantType"), "vtype", "'literal'", "vtype IS NOT NULL"),
    triple_select("g", "T", q(LABEL), "substr(L, 1, greatest(length(L) - 1, 0))", "'literal'", "L <> ''"),
    triple_select("g", "T", q(BFLC + "titleSortKey"), "substr(S, 1, greatest(length(L) - 1, 0))", "'literal'", "S <> ''"),
    triple_select("p", "T", q(BFLC + "applicableInstitution"), "T || '-institution-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'", "x.code = '5'"),
    triple_select("p", "T || '-institution-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Agent"), "'uri'", "x.code = '5'"),
    triple_select("p", "T || '-institution-' || CAST(x.sf_ord AS VARCHAR)", q(BF + "code"), "x.value", "'literal'", "x.code = '5'"),
] + _parts_sql("p", {"a": "mainTitle", "b": "subtitle", "f": "date", "n": "partNumber", "p": "partName"})


@query("variant_titles", f"WITH {_T246_PREP}\n" + finish("R18", _T246_SELS))
def variant_titles(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return TI.variant_246(fx.nested("fx_notes"), ruris(fx))


# ---- R16 agent keys ----------------------------------------------------------------
def x08_source_sql(v: str) -> str:
    aft = f"CASE WHEN instr({v}, '(') > 0 THEN substr({v}, instr({v}, '(') + 1) ELSE '' END"
    bef = f"CASE WHEN instr({v}, ')') > 0 THEN substr({v}, 1, instr({v}, ')') - 1) ELSE '' END"
    return f"substr({aft}, 1, greatest(length({bef}) - 1, 0))"


def x08_value_sql(v: str) -> str:
    aft2 = f"CASE WHEN instr({v}, ')') > 0 THEN substr({v}, instr({v}, ')') + 1) ELSE '' END"
    return f"CASE WHEN {x08_source_sql(v)} <> '' THEN {aft2} ELSE {v} END"


def _sp(filter_expr: str, sfs: str = "y.sfs") -> str:
    return f"array_to_string(list_transform(list_filter({sfs}, lambda s: {filter_expr}), lambda s: s.value || ' '), '')"


_QUAL = "(starts_with(s.value, '(uri)') OR starts_with(s.value, 'http'))"

_AGENT_PREP = _CONTRIB_PREP.split("rs AS (")[0].rstrip().rstrip(",") + f""",
y AS (SELECT x.*, list_max(list_transform(list_filter(sfs, lambda s: s.code = 't'), lambda s: s.sf_ord)) AS lt,
        substr(tag, 2, 2) AS xx FROM x),
z AS (SELECT y.*, f.ind1, f.ind2 AS find2,
        CASE WHEN y.tag = '720' THEN list_filter(y.sfs, lambda s: s.code = 'a')[1].value
             WHEN xx = '00' THEN {_sp("s.code IN ('a','b','c','d','j','q')")}
             WHEN xx = '10' THEN {_sp("s.code IN ('a','b','c','d','n','g') AND (lt IS NULL OR s.sf_ord < lt)")}
             WHEN xx = '11' THEN {_sp("s.code IN ('a','c','d','e','n','g','q') AND (lt IS NULL OR s.sf_ord < lt)")} END AS label,
        CASE WHEN y.tag = '720' THEN CASE WHEN f.ind1 = '1' THEN 'Person' END
             WHEN xx = '00' THEN CASE WHEN f.ind1 = '3' THEN 'Family' ELSE 'Person' END
             WHEN xx = '10' THEN CASE WHEN f.ind1 = '1' THEN 'Jurisdiction' ELSE 'Organization' END
             WHEN xx = '11' THEN 'Meeting' END AS cls,
        y.tag || f.ind1 || f.ind2 || {_ns("array_to_string(list_transform(y.sfs, lambda s: '$' || s.code || s.value), '')")} AS mk,
        list_filter(y.sfs, lambda s: s.code IN ('0', 'w') AND (lt IS NULL OR s.sf_ord < lt)) AS ids0,
        '_:' || record_id || '-' || CAST(ord AS VARCHAR) || '-0-agent-1' AS np
      FROM y JOIN f USING (record_id, ord)),
w AS (SELECT z.*, list_filter(ids0, lambda s: {_QUAL})[1].sf_ord AS fq FROM z),
k AS (SELECT w.*, {_ns('label')} AS lbl, coalesce(label, '') <> '' AS has_label FROM w),
ii AS (SELECT record_id, agent, np, unnest(list_filter(ids0, lambda s: NOT {_QUAL} OR s.sf_ord <> fq)) AS s FROM w),
iv AS (SELECT *, np || '-id-' || CAST(s.sf_ord AS VARCHAR) AS node, {x08_source_sql('s.value')} AS src,
        {x08_value_sql('s.value')} AS val FROM ii)"""

_AGENT_SELS = [
    triple_select("k", "agent", q(TYPE), q(BF + "Agent"), "'uri'"),
    triple_select("k", "agent", q(TYPE), f"'{BF}' || cls", "'uri'", "cls IS NOT NULL"),
    triple_select("k", "agent", f"'{BFLC}name' || xx || 'MatchKey'", "lbl", "'literal'", "xx IN ('00','10','11') AND has_label"),
    triple_select("k", "agent", f"'{BFLC}primaryContributorName' || xx || 'MatchKey'", "lbl", "'literal'",
                  "xx IN ('00','10','11') AND has_label AND substr(tag, 1, 1) = '1'"),
    triple_select("k", "agent", f"'{BFLC}name' || xx || 'MarcKey'", "mk", "'literal'", "xx IN ('00','10','11')"),
    triple_select("k", "agent", q(LABEL), "lbl", "'literal'", "has_label"),
    triple_select("iv", "agent", q(BF + "identifiedBy"), "node", "'bnode'"),
    triple_select("iv", "node", q(TYPE), q(BF + "Identifier"), "'uri'"),
    triple_select("iv", "node", q(RDF + "value"), "val", "CASE WHEN instr(val, '://') > 0 THEN 'uri' ELSE 'literal' END"),
    triple_select("iv", "node", q(BF + "source"), "node || '-source'", "'bnode'", "src <> ''"),
    triple_select("iv", "node || '-source'", q(TYPE), q(BF + "Source"), "'uri'", "src <> ''"),
    triple_select("iv", "node || '-source'", q(LABEL), "src", "'literal'", "src <> ''"),
]


@query("agent_keys", _AGENT_PREP + "\n" + finish("R16", _AGENT_SELS))
def agent_keys(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return N.agent_keys(ruris(fx), nested(fx))


# ---- R20 publication ------------------------------------------------------------------
from ..plans import publication as PUB  # noqa: E402

_ACT = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PUB.ACTIVITY_264)


def _brackets_sql(v: str, punct: str = ".:,;/ ") -> str:
    return f"rtrim(ltrim({v}, '['), '{punct}]')"


def _parens_sql(v: str) -> str:
    return f"rtrim(ltrim({v}, '('), '.:,;/ )')"


_PUB_PREP = f"""{R_CTE},
{nested_cte('f', "tag IN ('260', '262', '264')")},
g AS (SELECT f.*, tag AS etag, r.ruri || '#Instance' AS I, {bn('provision')} AS P, {bn('manufacture')} AS M,
        {_ns("array_to_string(list_transform(list_filter(sfs, lambda s: s.code IN ('a','b','c')), lambda s: s.value), ' ')")} AS stmt,
        CASE WHEN tag = '264' THEN coalesce(CASE ind2 {_ACT} END, '') ELSE 'Publication' END AS activity,
        tag = '264' AND ind2 = '4' AS copyright_,
        len(list_filter(sfs, lambda s: s.code IN ('a','b','c'))) > 0 AS has_abc,
        len(list_filter(sfs, lambda s: s.code IN ('e','f','g'))) > 0 AS has_efg
      FROM f JOIN r USING (record_id)),
pv AS (SELECT * FROM g WHERE NOT copyright_ AND has_abc),
px AS (SELECT pv.record_id, pv.etag, pv.P, unnest(pv.sfs) AS x FROM pv),
mf AS (SELECT * FROM g WHERE etag = '260' AND has_efg),
mx AS (SELECT mf.record_id, mf.M, unnest(mf.sfs) AS x FROM mf),
dx AS (SELECT g.record_id, g.I, g.P, unnest(g.sfs) AS x FROM g WHERE etag = '260')"""


def _node(base, kind):
    return f"{base} || '-{kind}-' || CAST(x.sf_ord AS VARCHAR)"


_PUB_SELS = [
    triple_select("g", "I", q(BF + "copyrightDate"), "stmt", "'literal'", "copyright_"),
    triple_select("pv", "I", q(BF + "provisionActivity"), "P", "'bnode'"),
    triple_select("pv", "P", q(TYPE), f"'{BF}' || activity", "'uri'"),
    triple_select("pv", "I", q(BF + "provisionActivityStatement"), "stmt"),
    triple_select("pv", "P", q(BF + "status"), "P || '-status'", "'bnode'", "etag IN ('260','264') AND ind1 = '3'"),
    triple_select("pv", "P || '-status'", q(TYPE), q(BF + "Status"), "'uri'", "etag IN ('260','264') AND ind1 = '3'"),
    triple_select("pv", "P || '-status'", q(LABEL), "'current'", "'literal'", "etag IN ('260','264') AND ind1 = '3'"),
    triple_select("px", "P", q(BFLC + "appliesTo"), _node("P", "appliesTo"), "'bnode'", "x.code = '3' AND etag IN ('260','264')"),
    triple_select("px", _node("P", "appliesTo"), q(TYPE), q(BFLC + "AppliesTo"), "'uri'", "x.code = '3' AND etag IN ('260','264')"),
    triple_select("px", _node("P", "appliesTo"), q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = '3' AND etag IN ('260','264')"),
    triple_select("px", "P", q(BF + "place"), _node("P", "place"), "'bnode'", "x.code = 'a'"),
    triple_select("px", _node("P", "place"), q(TYPE), q(BF + "Place"), "'uri'", "x.code = 'a'"),
    triple_select("px", _node("P", "place"), q(LABEL), _brackets_sql("x.value", ":,;/ "), "'literal'", "x.code = 'a'"),
    triple_select("px", "P", q(BF + "agent"), _node("P", "agent"), "'bnode'", "x.code = 'b'"),
    triple_select("px", _node("P", "agent"), q(TYPE), q(BF + "Agent"), "'uri'", "x.code = 'b'"),
    triple_select("px", _node("P", "agent"), q(LABEL), _brackets_sql("x.value", ":,;/ "), "'literal'", "x.code = 'b'"),
    triple_select("px", "P", q(BF + "date"), _brackets_sql("x.value"), "'literal'", "x.code = 'c'"),
    triple_select("mf", "I", q(BF + "provisionActivity"), "M", "'bnode'"),
    triple_select("mf", "M", q(TYPE), q(BF + "Manufacture"), "'uri'"),
    triple_select("mx", "M", q(BFLC + "appliesTo"), _node("M", "appliesTo"), "'bnode'", "x.code = '3'"),
    triple_select("mx", _node("M", "appliesTo"), q(TYPE), q(BFLC + "AppliesTo"), "'uri'", "x.code = '3'"),
    triple_select("mx", _node("M", "appliesTo"), q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = '3'"),
    triple_select("mx", "M", q(BF + "place"), _node("M", "place"), "'bnode'", "x.code = 'e'"),
    triple_select("mx", _node("M", "place"), q(TYPE), q(BF + "Place"), "'uri'", "x.code = 'e'"),
    triple_select("mx", _node("M", "place"), q(LABEL), _parens_sql("x.value"), "'literal'", "x.code = 'e'"),
    triple_select("mx", "M", q(BF + "agent"), _node("M", "agent"), "'bnode'", "x.code = 'f'"),
    triple_select("mx", _node("M", "agent"), q(TYPE), q(BF + "Agent"), "'uri'", "x.code = 'f'"),
    triple_select("mx", _node("M", "agent"), q(LABEL), _parens_sql("x.value"), "'literal'", "x.code = 'f'"),
    triple_select("mx", "M", q(BF + "date"), _parens_sql("x.value"), "'literal'", "x.code = 'g'"),
    triple_select("dx", "I", q(BF + "identifiedBy"), _node("P", "publisherNumber"), "'bnode'", "x.code = 'd'"),
    triple_select("dx", _node("P", "publisherNumber"), q(TYPE), q(BF + "PublisherNumber"), "'uri'", "x.code = 'd'"),
    triple_select("dx", _node("P", "publisherNumber"), q(RDF + "value"), "x.value", "'literal'", "x.code = 'd'"),
]


@query("publication_events", f"WITH {_PUB_PREP}\n" + finish("R20", _PUB_SELS))
def publication_events(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return PUB.publication_events(nested(fx), ruris(fx))


# ---- R26 subjects and keywords ---------------------------------------------------------
from ..plans import subjects as SU  # noqa: E402
from ..operators.windows import THESAURUS  # noqa: E402


def _th_rows():
    out = []
    for i, c, schemes in THESAURUS:
        for s in schemes or [None]:
            out.append((i, c, s))
    return out


_COMP_CLASS = ("CASE WHEN x.code = 'v' THEN 'GenreForm' WHEN x.code = 'x' THEN 'Topic' WHEN x.code = 'y' THEN 'Temporal' "
               "WHEN x.code = 'z' THEN 'Geographic' WHEN tag = '648' THEN 'Temporal' WHEN tag = '650' THEN "
               "CASE WHEN x.code = 'c' THEN 'Geographic' WHEN x.code = 'd' THEN 'Temporal' ELSE 'Topic' END "
               "WHEN tag = '651' THEN 'Geographic' WHEN tag = '655' THEN 'GenreForm' END")

_SUBJ_PREP = f"""{R_CTE},
{nested_cte('f', "tag IN ('648', '650', '651') OR (tag = '655' AND ind1 = ' ')")},
th AS (SELECT DISTINCT t_ind2, t_code FROM {_vals(_th_rows(), 't_ind2, t_code, t_scheme', 'tv')}),
ts AS (SELECT t_ind2, t_scheme FROM {_vals(_th_rows(), 't_ind2, t_code, t_scheme', 'tw')} WHERE t_scheme IS NOT NULL),
g AS (SELECT f.*, r.ruri || '#Work' AS W, {_MARK} AS m, th.t_code,
        r.ruri || CASE WHEN tag = '648' THEN '#Temporal' WHEN tag = '655' THEN '#GenreForm' ELSE '#Topic' END || tag || '-' || CAST(ord AS VARCHAR) AS dflt,
        list_filter(sfs, lambda s: instr(CASE WHEN tag = '650' THEN 'abcdvxyz' WHEN tag = '651' THEN 'abvxyz' ELSE 'avxyz' END, s.code) > 0) AS comps,
        CASE WHEN len(list_filter(sfs, lambda s: s.code IN ('v','x','y','z'))) > 0 THEN 'ComplexSubject'
             WHEN tag = '648' THEN 'Temporal'
             WHEN tag = '650' THEN CASE WHEN len(list_filter(sfs, lambda s: s.code IN ('b','c','d'))) > 0 THEN 'ComplexSubject' ELSE 'Topic' END
             WHEN tag = '651' THEN CASE WHEN len(list_filter(sfs, lambda s: s.code = 'b')) > 0 THEN 'ComplexSubject' ELSE 'Geographic' END
             WHEN tag = '655' THEN 'GenreForm' END AS mads
      FROM f JOIN r USING (record_id) LEFT JOIN th ON th.t_ind2 = f.ind2),
h AS (SELECT *, CASE WHEN instr(m, 'T') > 0 THEN NULL WHEN instr(m, 'Q') > 0 THEN {uri_sql("sfs[instr(m, 'Q')].value")} END AS u FROM g),
k AS (SELECT *, CASE WHEN coalesce(u, '') <> '' THEN u ELSE dflt END AS T,
        rtrim(array_to_string(list_transform(comps, lambda s: s.value || '--'), ''), '- ') AS L, len(comps) AS n,
        list_filter(sfs, lambda s: s.code = '2')[1].value AS code2,
        list_filter(sfs, lambda s: s.code IN ('0', 'w')) AS ids0 FROM h),
cx AS (SELECT record_id, tag, T, n, generate_subscripts(comps, 1) AS i, unnest(comps) AS x FROM k WHERE mads = 'ComplexSubject' AND n > 0),
sc AS (SELECT k.record_id, k.T, ts.t_scheme FROM k JOIN ts ON ts.t_ind2 = k.ind2),
gx AS (SELECT record_id, T, unnest(sfs) AS x FROM k),
w2 AS (SELECT k.*, list_filter(ids0, lambda s: {_QUAL})[1].sf_ord AS fq FROM k),
ii AS (SELECT record_id, T, unnest(list_filter(ids0, lambda s: NOT {_QUAL} OR s.sf_ord <> fq)) AS s FROM w2),
iv AS (SELECT *, T || '-id-' || CAST(s.sf_ord AS VARCHAR) AS node, {x08_source_sql('s.value')} AS src,
        {x08_value_sql('s.value')} AS val FROM ii)"""

_LN = "T || '-list-' || CAST(i AS VARCHAR)"
_CN = "T || '-component-' || CAST(i AS VARCHAR)"
_SUBJ_SELS = [
    triple_select("k", "W", f"CASE WHEN tag = '655' THEN {q(BF + 'genreForm')} ELSE {q(BF + 'subject')} END", "T", "'uri'"),
    triple_select("k", "T", q(TYPE), f"'{BF}' || CASE WHEN tag = '648' THEN 'Temporal' WHEN tag = '651' THEN 'Place' "
                  "WHEN tag = '655' THEN 'GenreForm' ELSE 'Topic' END", "'uri'"),
    triple_select("k", "T", q(LABEL), "L"),
    triple_select("k", "T", q(X.MADSRDF + "authoritativeLabel"), "L"),
    triple_select("k", "T", q(TYPE), f"'{X.MADSRDF}' || mads", "'uri'", "mads IS NOT NULL"),
    triple_select("sc", "T", q(X.MADSRDF + "isMemberofMADSScheme"), "t_scheme", "'uri'"),
    triple_select("k", "T", q(X.MADSRDF + "componentList"), "T || '-list-1'", "'bnode'", "mads = 'ComplexSubject' AND n > 0"),
    triple_select("cx", _LN, q(RDF + "first"), _CN, "'bnode'"),
    triple_select("cx", _LN, q(RDF + "rest"), f"CASE WHEN i < n THEN T || '-list-' || CAST(i + 1 AS VARCHAR) ELSE {q(RDF + 'nil')} END",
                  "CASE WHEN i < n THEN 'bnode' ELSE 'uri' END"),
    triple_select("cx", _CN, q(TYPE), f"'{X.MADSRDF}' || {_COMP_CLASS}", "'uri'"),
    triple_select("cx", _CN, q(X.MADSRDF + "authoritativeLabel"), "rtrim(x.value, '.:,;/ ')"),
    triple_select("gx", "T", q(BF + "note"), "T || '-note-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'", "x.code = 'g'"),
    triple_select("gx", "T || '-note-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Note"), "'uri'", "x.code = 'g'"),
    triple_select("gx", "T || '-note-' || CAST(x.sf_ord AS VARCHAR)", q(LABEL), "x.value", "'literal'", "x.code = 'g'"),
    triple_select("k", "T", q(BF + "source"), "T || '-source'", "'bnode'", "t_code IS NOT NULL OR (ind2 = '7' AND code2 IS NOT NULL)"),
    triple_select("k", "T || '-source'", q(TYPE), q(BF + "Source"), "'uri'", "t_code IS NOT NULL OR (ind2 = '7' AND code2 IS NOT NULL)"),
    triple_select("k", "T || '-source'", q(BF + "code"), "coalesce(t_code, code2)", "'literal'",
                  "t_code IS NOT NULL OR (ind2 = '7' AND code2 IS NOT NULL)"),
    triple_select("iv", "T", q(BF + "identifiedBy"), "node", "'bnode'"),
    triple_select("iv", "node", q(TYPE), q(BF + "Identifier"), "'uri'"),
    triple_select("iv", "node", q(RDF + "value"), "val", "CASE WHEN instr(val, '://') > 0 THEN 'uri' ELSE 'literal' END"),
    triple_select("iv", "node", q(BF + "source"), "node || '-source'", "'bnode'", "src <> ''"),
    triple_select("iv", "node || '-source'", q(TYPE), q(BF + "Source"), "'uri'", "src <> ''"),
    triple_select("iv", "node || '-source'", q(LABEL), "src", "'literal'", "src <> ''"),
]


@query("subject_components", f"WITH {_SUBJ_PREP}\n" + finish("R26", _SUBJ_SELS))
def subject_components(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return SU.subjects(spark, nested(fx), ruris(fx))


_KW = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SU.KEYWORD_RESOURCE)
_KW_PREP = f"""{R_CTE},
{nested_cte('f', "tag = '653'").replace('fx_subfields', 'fx_notes')},
k AS (SELECT f.*, r.ruri || '#Work' AS W, {bn('keyword')} AS K,
        rtrim(array_to_string(list_transform(list_filter(sfs, lambda s: s.code = 'a'), lambda s: s.value || '--'), ''), '- ') AS L
      FROM f JOIN r USING (record_id))"""
_KW_SELS = [
    triple_select("k", "W", f"CASE WHEN ind2 = '6' THEN {q(BF + 'genreForm')} ELSE {q(BF + 'subject')} END", "K", "'bnode'"),
    triple_select("k", "K", q(TYPE), f"'{BF}' || coalesce(CASE ind2 {_KW} END, 'Topic')", "'uri'"),
    triple_select("k", "K", q(LABEL), "L"),
]


@query("keywords", f"WITH {_KW_PREP}\n" + finish("R26", _KW_SELS))
def keywords(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return SU.keywords(fx.nested("fx_notes"), ruris(fx))


# ---- X09 entity URIs, X18 sort keys, X20 script language tags ----------------------------
from ..plans.names import _marks, generate_uri  # noqa: E402


@query("entity_uri", f"""WITH {R_CTE},
{nested_cte('f', "tag IN ('100', '600', '700')").replace('fx_subfields', 'fx_all')},
g AS (SELECT f.*, r.ruri, {_MARK} AS m FROM f JOIN r USING (record_id)),
h AS (SELECT *, instr(m, 'T') > 0 AS has_t, instr(m, 'T') AS pos_t,
        CASE WHEN regexp_matches(m, 'Q-*T') THEN length(regexp_extract(m, '^(.*?)Q-*T', 1)) + 1 ELSE 0 END AS agent_t FROM g),
u AS (SELECT *, CASE WHEN has_t THEN agent_t ELSE instr(m, 'Q') END AS apos,
        CASE WHEN has_t THEN CASE WHEN instr(substr(m, pos_t + 1), 'Q') > 0 THEN pos_t + instr(substr(m, pos_t + 1), 'Q') ELSE 0 END
             ELSE instr(m, 'Q') END AS wpos FROM h),
v AS (SELECT *, {uri_sql('CASE WHEN apos > 0 THEN sfs[apos].value END')} AS au,
        {uri_sql('CASE WHEN wpos > 0 THEN sfs[wpos].value END')} AS wu FROM u)
SELECT record_id, ord, tag,
  CASE WHEN coalesce(au, '') <> '' THEN au ELSE ruri || '#Agent' || tag || '-' || CAST(ord AS VARCHAR) END AS agent_uri,
  CASE WHEN coalesce(wu, '') <> '' THEN wu ELSE ruri || '#Work' || tag || '-' || CAST(ord AS VARCHAR) END AS work_uri
FROM v""")
def entity_uri(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    f = C.with_uri(fx.nested("fx_all").where(F.col("tag").isin("100", "600", "700")), ruris(fx))
    f = f.withColumn("m", _marks(F.col("sfs")))
    d = F.concat(F.col("ruri"), F.lit("#Agent"), F.col("tag"), F.lit("-"), F.col("ord").cast("string"))
    dw = F.concat(F.col("ruri"), F.lit("#Work"), F.col("tag"), F.lit("-"), F.col("ord").cast("string"))
    return f.select("record_id", "ord", "tag", generate_uri(F.col("sfs"), "Agent", d, F.col("m")).alias("agent_uri"),
                    generate_uri(F.col("sfs"), "Work", dw, F.col("m")).alias("work_uri"))


@query("title_sort_key", f"""WITH {nested_cte('f', "tag IN ('245', '130', '240')")},
g AS (SELECT record_id, ord, tag, CASE WHEN tag = '130' THEN ind1 ELSE ind2 END AS nfi,
        {_ns("array_to_string(list_transform(list_filter(sfs, lambda s: s.code IN ('a','b','f','g','k','n','p','s')), lambda s: s.value), ' ')")} AS label
      FROM f)
SELECT record_id, ord, tag, label, substr(label, coalesce(TRY_CAST(nfi AS INT), 0) + 1) AS sort_key FROM g""")
def title_sort_key(spark, sf_dir):
    """Non-filing characters from ind2 (ind1 for 130/630/730/740)."""
    f = C.nest_fields(Fixtures(spark, sf_dir).fx_subfields.where(F.col("tag").isin("245", "130", "240")))
    nfi = F.when(F.col("tag").isin("130", "630", "730", "740"), F.col("ind1")).otherwise(F.col("ind2"))
    lbl = C.label(F.col("sfs"), "abfgknps")
    return f.select("record_id", "ord", "tag", lbl.alias("label"), X.sort_key(lbl, nfi).alias("sort_key"))


# --- fixed values: ISO 639-2 to xml:lang language map (a parameter; the map the
# stylesheet names is not part of the reference) --------------------------------


@query("script_lang_tag", f"""WITH
s AS (SELECT record_id, ord, value AS sf6 FROM fx_subfields WHERE code = '6'),
j AS (SELECT s.*, substr(x.c008, 36, 3) AS lang008 FROM s JOIN fx_records x USING (record_id)),
k AS (SELECT j.*, CASE WHEN instr(sf6, '/') > 0 THEN substr(sf6, instr(sf6, '/') + 1) ELSE '' END AS rest FROM j),
c AS (SELECT k.*, CASE WHEN instr(rest, '/') > 0 THEN substr(rest, 1, instr(rest, '/') - 1) ELSE rest END AS sc FROM k),
n AS (SELECT c.*, CASE WHEN sc = '(3' THEN 'arab' WHEN sc = '(B' THEN 'latn' WHEN sc = '$1' AND lang008 = 'kor' THEN 'hang'
        WHEN sc = '$1' AND lang008 = 'chi' THEN 'hani' WHEN sc = '$1' AND lang008 = 'jpn' THEN 'jpan' WHEN sc = '(N' THEN 'cyrl'
        WHEN sc = '(S' THEN 'grek' WHEN sc = '(2' THEN 'hebr' END AS script, lm.xl FROM c
      LEFT JOIN {_vals(LANGUAGE_MAP, 'iso, xl', 'lm')} ON lm.iso = c.lang008)
SELECT record_id, ord, CASE WHEN coalesce(xl, '') <> '' AND coalesce(script, '') <> '' THEN xl || '-' || script END AS xml_lang FROM n""")
def script_lang_tag(spark, sf_dir):
    """Xml:lang of a field from its $6 script code and the 008 language."""
    fx = Fixtures(spark, sf_dir)
    s = fx.fx_subfields.where(F.col("code") == "6").select("record_id", "ord", F.col("value").alias("sf6"))
    j = s.join(fx.fx_records.select("record_id", F.substring("c008", 36, 3).alias("lang008")), "record_id")
    lm = spark.createDataFrame(LANGUAGE_MAP, "iso string, xl string")
    j = j.join(F.broadcast(lm), F.col("lang008") == F.col("iso"), "left")
    script = X.script_name(F.col("sf6"), F.col("lang008"))
    ok = (F.coalesce(F.col("xl"), F.lit("")) != "") & (F.coalesce(script, F.lit("")) != "")
    return j.select("record_id", "ord", F.when(ok, F.concat(F.col("xl"), F.lit("-"), script)).alias("xml_lang"))


# ---- R07 008 work fields and J01 code-list lookups -------------------------------------
from ..plans import fixed as FX  # noqa: E402
from ..plans import record as REC  # noqa: E402


def _cand_sql(reads_by_material=None) -> str:
    rows = []
    for mat, reads in (reads_by_material or FX.MATERIAL_READS).items():
        for lst, pos, width, xkeys in reads:
            for k in range(width):
                rows.append((mat, lst, str(pos + k), "1" if xkeys else "0"))
    return V.values_sql(rows, "material, list, pos, xkeys").replace(" AS v(", " AS mr(")


_MAT_SQL = """CASE WHEN substr(leader, 7, 1) = 'a' AND substr(leader, 8, 1) IN ('a','c','d','m') THEN 'books'
  WHEN substr(leader, 7, 1) = 'm' THEN 'computer' WHEN substr(leader, 7, 1) IN ('e','f') THEN 'maps'
  WHEN substr(leader, 7, 1) IN ('c','d','i','j') THEN 'music'
  WHEN substr(leader, 7, 1) = 'a' AND substr(leader, 8, 1) IN ('b','i','s') THEN 'continuing'
  WHEN substr(leader, 7, 1) IN ('g','k','o','r') THEN 'visual' END"""

_LOOKUP_CTE = f"""{R_CTE},
h AS (SELECT x.record_id, x.c008, r.ruri, {_MAT_SQL} AS material FROM fx_records x JOIN r USING (record_id)),
c AS (SELECT h.record_id, h.ruri, mr.list, CAST(mr.pos AS INT) AS pos, substr(substr(h.c008, 19, 17), CAST(mr.pos AS INT), 1) AS ch, mr.xkeys
      FROM h JOIN {_cand_sql()} ON mr.material = h.material),
k AS (SELECT record_id, ruri, list, pos, ch AS key FROM c UNION ALL SELECT record_id, ruri, list, pos, 'x' || ch FROM c WHERE xkeys = '1'),
hits AS (SELECT k.record_id, k.ruri, k.list, k.pos, v.uri, v.label FROM k
         JOIN {V.values_sql(FX.CODE_LISTS, 'v_list, v_key, uri, label')} ON v.v_list = k.list AND v.v_key = k.key)"""


@query("lookup_audience", f"WITH {_LOOKUP_CTE}\nSELECT record_id, pos, uri, label FROM hits WHERE list = 'audience'")
def lookup_audience(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return FX.lookups(spark, REC.headers_with_uri(fx.fx_records), ("audience",)).select("record_id", "pos", "uri", "label")


@query("lookup_genre", f"""WITH {_LOOKUP_CTE}
SELECT record_id, list, pos, uri, label FROM hits
WHERE list IN ('marcgt', 'litform', 'bioform', 'govdoc', 'conference', 'festschrift', 'computerfile', 'mapform', 'visualtype')""")
def lookup_genre(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    lists = ("marcgt", "litform", "bioform", "govdoc", "conference", "festschrift", "computerfile", "mapform", "visualtype")
    return FX.lookups(spark, REC.headers_with_uri(fx.fx_records), lists).select("record_id", "list", "pos", "uri", "label")


@query("fixed_field_work", f"""WITH {_LOOKUP_CTE},
lg AS (SELECT x.record_id, r.ruri || '#Work' AS W, '{X.LANGUAGES}' || substr(x.c008, 36, 3) AS L FROM fx_records x JOIN r USING (record_id)
       WHERE x.c008 IS NOT NULL AND substr(x.c008, 36, 3) NOT IN ('   ', '|||')),
hh AS (SELECT *, ruri || '#Work' AS W, coalesce(uri, '_:' || record_id || '-008-' || CAST(pos AS VARCHAR) || '-' || list) AS U,
        CASE WHEN uri IS NULL THEN 'bnode' ELSE 'uri' END AS K FROM hits)
""" + finish("R07", [
    triple_select("hh", "W", f"CASE WHEN list = 'audience' THEN {q(BF + 'intendedAudience')} ELSE {q(BF + 'genreForm')} END",
                  "U", "K"),
    triple_select("hh", "U", q(TYPE), f"CASE WHEN list = 'audience' THEN {q(BF + 'IntendedAudience')} ELSE {q(BF + 'GenreForm')} END",
                  "'uri'"),
    triple_select("hh", "U", q(LABEL), "label"),
    triple_select("lg", "W", q(BF + "language"), "L", "'uri'"),
    triple_select("lg", "L", q(TYPE), q(BF + "Language"), "'uri'"),
]))
def fixed_field_work(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return FX.fixed_field_work(spark, REC.headers_with_uri(fx.fx_records))


# ---- R04 / R05 007 ---------------------------------------------------------------------
from ..plans import physical as PH  # noqa: E402


@query("physical_007_work", f"""WITH {R_CTE},
h AS (SELECT x.*, r.ruri, r.ruri || '#Work' AS W, substr(c007, 1, 1) AS cat FROM fx_records x JOIN r USING (record_id) WHERE c007 IS NOT NULL),
t AS (SELECT h.*, wt.wtype FROM h JOIN {V.values_sql(PH.WORK_TYPE_007, 'w_cat, wtype, suppress').replace(' AS v(', ' AS wt(')}
      ON wt.w_cat = h.cat WHERE instr(wt.suppress, substr(h.leader, 7, 1)) = 0),
c AS (SELECT h.*, cc.label, cc.uri, CASE WHEN cc.uri IS NOT NULL THEN '{PH.MCOLOR}' || cc.uri ELSE '_:' || h.record_id || '-5-0-colorContent-1' END AS N
      FROM h JOIN {V.values_sql([(a, str(b), c, d, e) for a, b, c, d, e in PH.COLOR_007], 'c_cat, pos, code, label, uri').replace(' AS v(', ' AS cc(')}
      ON cc.c_cat = h.cat AND substr(h.c007, CAST(cc.pos AS INT), 1) = cc.code WHERE cc.label IS NOT NULL)
""" + finish("R04", [
    triple_select("t", "W", q(TYPE), f"'{BF}' || wtype", "'uri'"),
    triple_select("c", "W", q(BF + "colorContent"), "N", "CASE WHEN uri IS NOT NULL THEN 'uri' ELSE 'bnode' END"),
    triple_select("c", "N", q(TYPE), q(BF + "ColorContent"), "'uri'"),
    triple_select("c", "N", q(LABEL), "label"),
]))
def physical_007_work(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return PH.physical_007_work(spark, REC.headers_with_uri(fx.fx_records))


@query("physical_007_instance", f"""WITH {R_CTE},
h AS (SELECT x.*, r.ruri || '#Instance' AS I, substr(c007, 1, 1) AS cat FROM fx_records x JOIN r USING (record_id) WHERE c007 IS NOT NULL),
e AS (SELECT * FROM h WHERE cat = 'c' AND substr(leader, 7, 1) <> 'm'),
m AS (SELECT h.*, '{PH.MEDIA}' || md.media AS U, md.m_label FROM h
      JOIN {V.values_sql(PH.MEDIA_007, 'm_cat, media, m_label').replace(' AS v(', ' AS md(')} ON md.m_cat = h.cat
      WHERE h.record_id NOT IN (SELECT record_id FROM fx_all WHERE tag = '337')),
c AS (SELECT h.*, '{PH.CARRIERS}' || cr.c_uri AS N, cr.c_label FROM h
      JOIN {V.values_sql(PH.CARRIER_007, 'c_cat, code, c_label, c_uri').replace(' AS v(', ' AS cr(')}
      ON cr.c_cat = h.cat AND cr.code = substr(h.c007, 2, 1)
      WHERE h.record_id NOT IN (SELECT record_id FROM fx_all WHERE tag = '338'))
""" + finish("R05", [
    triple_select("e", "I", q(TYPE), q(BF + "Electronic"), "'uri'"),
    triple_select("m", "I", q(BF + "media"), "U", "'uri'"),
    triple_select("m", "U", q(TYPE), q(BF + "Media"), "'uri'"),
    triple_select("m", "U", q(LABEL), "m_label"),
    triple_select("c", "I", q(BF + "carrier"), "N", "'uri'"),
    triple_select("c", "N", q(TYPE), q(BF + "Carrier"), "'uri'"),
    triple_select("c", "N", q(LABEL), "c_label", "'literal'", "c_label IS NOT NULL"),
]))
def physical_007_instance(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return PH.physical_007_instance(spark, REC.headers_with_uri(fx.fx_records), fx.fx_all)


# ---- R30 series -------------------------------------------------------------------------
from ..plans import series as SE  # noqa: E402

_SER_PREP = f"""{R_CTE},
{nested_cte('f', "tag = '490'")},
w AS (SELECT f.*, len(list_filter(sfs, lambda s: s.code = 'a')) AS n_a,
        len(list_filter(sfs, lambda s: instr(s.value, '=') > 0)) > 0 AS has_eq FROM f),
c AS (SELECT *, n_a > 1 AND has_eq AS parallel,
        coalesce(sum(CASE WHEN n_a > 1 AND has_eq THEN 1 WHEN n_a > 1 THEN n_a WHEN n_a = 1 THEN 1 ELSE 0 END)
          OVER (PARTITION BY record_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS cur FROM w),
a AS (SELECT c.*, generate_subscripts(list_filter(sfs, lambda s: s.code = 'a'), 1) - 1 AS p,
        unnest(list_filter(sfs, lambda s: s.code = 'a')) AS av FROM c),
a2 AS (SELECT *, list_filter(sfs, lambda s: s.code = 'v' AND s.sf_ord > av.sf_ord)[1].value AS nv,
        list_filter(sfs, lambda s: s.code = 'x' AND s.sf_ord > av.sf_ord)[1].value AS nx,
        list_filter(sfs, lambda s: s.code = '3')[1].value AS s3 FROM a WHERE NOT (parallel AND p > 0)),
l AS (SELECT record_id, CAST(cur + p AS INT) AS rank, ord AS ord_490, av.sf_ord AS sf_a, av.value AS label490,
        CASE WHEN parallel THEN {_spaced_sql('av')} ELSE av.value || ' ' || CASE WHEN nv IS NOT NULL THEN nv || ' ' ELSE '' END END AS stmt490,
        nv AS v490, nx AS x490, s3 AS s3_490 FROM a2),
{nested_cte('e', "tag IN ('800', '810', '811', '830')")},
e8 AS (SELECT record_id, CAST(row_number() OVER (PARTITION BY record_id ORDER BY ord) AS INT) AS rank, ord AS ord_8xx,
         tag AS tag8, sfs AS sfs8 FROM e),
j AS (SELECT coalesce(l.record_id, e8.record_id) AS record_id, l.*, e8.ord_8xx, e8.tag8, e8.sfs8 FROM l FULL OUTER JOIN e8
      ON l.record_id = e8.record_id AND l.rank = e8.rank),
j2 AS (SELECT j.*, r.ruri, ord_490 IS NOT NULL AS from490,
        list_filter(sfs8, lambda s: s.code = 'v')[1].value AS v8, list_filter(sfs8, lambda s: s.code = 'x')[1].value AS x8,
        list_filter(sfs8, lambda s: s.code = '3')[1].value AS s38,
        array_to_string(list_transform(sfs8, lambda s: CASE WHEN s.code = 't' THEN 'T' WHEN s.code IN ('0', 'w') AND
          (starts_with(s.value, '(uri)') OR starts_with(s.value, 'http')) THEN 'Q' ELSE '-' END), '') AS m
      FROM j JOIN r ON r.record_id = j.record_id),
k AS (SELECT j2.*,
        CASE WHEN from490 THEN label490 WHEN tag8 IN ('830', '440') THEN {_sp("s.code IN ('a','n','p')", 'sfs8')}
             ELSE {_sp("s.code IN ('t','n','p')", 'sfs8')} END AS label,
        CASE WHEN from490 THEN stmt490 WHEN tag8 IN ('830', '440') THEN {_sp("s.code IN ('a','n','p','v')", 'sfs8')}
             ELSE {_sp("s.code IN ('t','n','p','v')", 'sfs8')} END AS stmt,
        CASE WHEN from490 THEN coalesce(v8, v490) ELSE v8 END AS enum,
        CASE WHEN from490 THEN coalesce(x490, x8) ELSE x8 END AS issn,
        CASE WHEN from490 THEN coalesce(s3_490, s38) ELSE s38 END AS applies,
        CASE WHEN from490 THEN '_:' || record_id || '-' || CAST(ord_490 AS VARCHAR) || '-' || CAST(sf_a AS VARCHAR) || '-series-1'
             ELSE '_:' || record_id || '-' || CAST(ord_8xx AS VARCHAR) || '-0-series-1' END AS S,
        CASE WHEN sfs8 IS NULL THEN NULL ELSE coalesce(nullif(
          CASE WHEN instr(m, 'T') > 0 THEN CASE WHEN instr(substr(m, instr(m, 'T') + 1), 'Q') > 0
                 THEN {uri_sql("sfs8[instr(m, 'T') + instr(substr(m, instr(m, 'T') + 1), 'Q')].value")} END
               WHEN instr(m, 'Q') > 0 THEN {uri_sql("sfs8[instr(m, 'Q')].value")} END, ''),
          ruri || '#Work' || tag8 || '-' || CAST(ord_8xx AS VARCHAR)) END AS SW,
        ruri || '#Instance' AS I FROM j2)"""

_SER_SELS = [
    triple_select("k", "I", q(BF + "hasSeries"), "S", "'bnode'"),
    triple_select("k", "S", q(TYPE), q(BF + "Instance"), "'uri'"),
    triple_select("k", "S", q(LABEL), "rtrim(label, '.:,;/ ')"),
    triple_select("k", "S", q(BF + "seriesStatement"), "rtrim(stmt, '.:,;/ ')"),
    triple_select("k", "S", q(BF + "seriesEnumeration"), "rtrim(enum, '.:,;/ ')", "'literal'", "coalesce(enum, '') <> ''"),
    triple_select("k", "S", q(BF + "identifiedBy"), "S || '-issn'", "'bnode'", "coalesce(issn, '') <> ''"),
    triple_select("k", "S || '-issn'", q(TYPE), q(BF + "Issn"), "'uri'", "coalesce(issn, '') <> ''"),
    triple_select("k", "S || '-issn'", q(RDF + "value"), "rtrim(issn, '.:,;/ ')", "'literal'", "coalesce(issn, '') <> ''"),
    triple_select("k", "S", q(BFLC + "appliesTo"), "S || '-appliesTo'", "'bnode'", "coalesce(applies, '') <> ''"),
    triple_select("k", "S || '-appliesTo'", q(TYPE), q(BFLC + "AppliesTo"), "'uri'", "coalesce(applies, '') <> ''"),
    triple_select("k", "S || '-appliesTo'", q(LABEL), "rtrim(applies, '.:,;/ ')", "'literal'", "coalesce(applies, '') <> ''"),
    triple_select("k", "S", q(BF + "instanceOf"), "SW", "'uri'", "SW IS NOT NULL"),
    triple_select("k", "SW", q(TYPE), q(BF + "Work"), "'uri'", "SW IS NOT NULL"),
    triple_select("k", "SW", q(BF + "identifiedBy"), "SW || '-issn'", "'bnode'", "SW IS NOT NULL AND coalesce(x8, '') <> ''"),
    triple_select("k", "SW || '-issn'", q(TYPE), q(BF + "Issn"), "'uri'", "SW IS NOT NULL AND coalesce(x8, '') <> ''"),
    triple_select("k", "SW || '-issn'", q(RDF + "value"), "rtrim(x8, '.:,;/ ')", "'literal'", "SW IS NOT NULL AND coalesce(x8, '') <> ''"),
]


@query("series_entries", f"WITH {_SER_PREP}\n" + finish("R30", _SER_SELS))
def series_entries(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return SE.series_entries(nested(fx), ruris(fx))


# ---- R29 holdings ----------------------------------------------------------------------------
from ..plans import holdings as HO  # noqa: E402


def _bn2(kind: str, n: str) -> str:
    return f"'_:' || record_id || '-' || CAST(ord AS VARCHAR) || '-' || CAST(sa AS VARCHAR) || '-{kind}-' || CAST({n} AS VARCHAR)"


_HOLD_PREP = f"""{R_CTE},
{nested_cte('f', "tag IN ('850', '852')").replace('fx_subfields', 'fx_all')},
a AS (SELECT f.*, r.ruri || '#Item' || tag || '-' || CAST(ord AS VARCHAR) AS ITEM, r.ruri || '#Instance' AS I,
        rtrim(array_to_string(list_transform(list_filter(sfs, lambda s: s.code IN ('e', 'n')), lambda s: s.value || ', '), ''), '.:,;/ ') AS addr,
        unnest(list_filter(sfs, lambda s: s.code = 'a')) AS av FROM f JOIN r USING (record_id)),
b AS (SELECT a.*, av.sf_ord AS sa, length(av.value) < 10 AS org FROM a),
c AS (SELECT b.*, CASE WHEN org THEN '{HO.ORGANIZATIONS}' || av.value ELSE {_bn2('heldBy', '1')} END AS AG FROM b),
x AS (SELECT c.record_id, c.ord, c.sa, c.tag, c.ITEM, unnest(c.sfs) AS x FROM c)"""

_HOLD_SELS = [
    triple_select("c", "I", q(BF + "hasItem"), "ITEM", "'uri'"),
    triple_select("c", "ITEM", q(TYPE), q(BF + "Item"), "'uri'"),
    triple_select("c", "ITEM", q(BF + "heldBy"), "AG", "CASE WHEN org THEN 'uri' ELSE 'bnode' END"),
    triple_select("c", "AG", q(TYPE), q(BF + "Agent"), "'uri'"),
    triple_select("c", "ITEM", q(BF + "itemOf"), "I", "'uri'"),
    triple_select("c", "AG", q(LABEL), "av.value", "'literal'", "NOT org"),
    triple_select("x", "ITEM", q(BF + "subLocation"), _bn2("subLocation", "x.sf_ord"), "'bnode'", "tag = '852' AND x.code = 'b'"),
    triple_select("x", _bn2("subLocation", "x.sf_ord"), q(TYPE), q(BF + "SubLocation"), "'uri'", "tag = '852' AND x.code = 'b'"),
    triple_select("x", _bn2("subLocation", "x.sf_ord"), q(LABEL), "x.value", "'literal'", "tag = '852' AND x.code = 'b'"),
    triple_select("c", "ITEM", q(BF + "subLocation"), _bn2("address", "1"), "'bnode'", "tag = '852' AND addr <> ''"),
    triple_select("c", _bn2("address", "1"), q(TYPE), q(BF + "SubLocation"), "'uri'", "tag = '852' AND addr <> ''"),
    triple_select("c", _bn2("address", "1"), q(LABEL), "addr", "'literal'", "tag = '852' AND addr <> ''"),
    triple_select("x", "ITEM", q(BF + "electronicLocator"), "x.value", "'uri'", "tag = '852' AND x.code = 'u'"),
    triple_select("x", "ITEM", q(BF + "note"), _bn2("note", "x.sf_ord"), "'bnode'", "tag = '852' AND x.code IN ('x', 'z')"),
    triple_select("x", _bn2("note", "x.sf_ord"), q(TYPE), q(BF + "Note"), "'uri'", "tag = '852' AND x.code IN ('x', 'z')"),
    triple_select("x", _bn2("note", "x.sf_ord"), q(LABEL), "x.value", "'literal'", "tag = '852' AND x.code IN ('x', 'z')"),
]


@query("holdings", f"WITH {_HOLD_PREP}\n" + finish("R29", _HOLD_SELS))
def holdings(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return HO.holdings(fx.nested("fx_all"), ruris(fx))


# ---- R25 reproductions -------------------------------------------------------------------
from ..plans import copies as CP  # noqa: E402

_REPRO_PREP = f"""{R_CTE},
{nested_cte('f', "TRUE").replace('fx_subfields', 'fx_all')},
lb AS (SELECT record_id, ord, tag, sfs,
        array_to_string(list_transform(list_filter(sfs, lambda s: s.code IN ('a','b','f','g','k','n','p','s')), lambda s: s.value || ' '), '') AS l245,
        array_to_string(list_transform(list_filter(sfs, lambda s: s.code IN ('a','d','f','g','k','l','m','n','o','p','r','s')), lambda s: s.value || ' '), '') AS lu
      FROM f WHERE tag IN ('245', '130', '240')),
t245 AS (SELECT record_id, arg_min(l245, ord) AS t FROM lb WHERE tag = '245' GROUP BY record_id),
t130 AS (SELECT record_id, arg_min(lu, ord) AS t FROM lb WHERE tag = '130' GROUP BY record_id),
t240 AS (SELECT record_id, arg_min(lu, ord) AS t FROM lb WHERE tag = '240' GROUP BY record_id),
n0 AS (SELECT record_id, ord, tag, ind1, list_filter(sfs, lambda s: s.code = '6')[1].value AS sf6 FROM f),
nn AS (SELECT *, lead(ord) OVER w AS n_ord, lead(tag) OVER w AS n_tag, lead(ind1) OVER w AS n_ind1, lead(sf6) OVER w AS n_sf6
       FROM n0 WINDOW w AS (PARTITION BY record_id ORDER BY ord)),
ho AS (SELECT record_id, ord, CASE WHEN (n_tag = '535' OR (n_tag = '880' AND starts_with(n_sf6, '535')))
         AND n_ind1 = CASE WHEN tag = '533' THEN '2' ELSE '1' END THEN n_ord END AS holding_ord FROM nn WHERE tag IN ('533', '534')),
c AS (SELECT f.record_id, f.ord, f.tag, f.sfs, r.ruri || '#Work' AS W, r.ruri || '#Instance' AS I,
        r.ruri || '#Instance' || f.tag || '-' || CAST(f.ord AS VARCHAR) AS NI, {bn('reproductionTitle').replace('record_id', 'f.record_id').replace('CAST(ord', 'CAST(f.ord')} AS T,
        ho.holding_ord, r.ruri || '#Item535-' || CAST(ho.holding_ord AS VARCHAR) AS ITEM,
        CASE WHEN f.tag = '533' THEN substr(coalesce(t245.t, ''), 1, greatest(length(coalesce(t245.t, '')) - 1, 0))
             WHEN f.tag = '534' AND len(list_filter(f.sfs, lambda s: s.code = 't')) > 0 THEN list_filter(f.sfs, lambda s: s.code = 't')[1].value
             ELSE substr(coalesce(t130.t, t240.t, t245.t, ''), 1, greatest(length(coalesce(t130.t, t240.t, t245.t, '')) - 1, 0)) END AS title,
        CASE WHEN f.tag = '534' AND len(list_filter(f.sfs, lambda s: s.code = 't')) > 0 THEN '{BF}InstanceTitle' ELSE '{BF}Title' END AS cls
      FROM f JOIN r ON r.record_id = f.record_id LEFT JOIN t245 ON t245.record_id = f.record_id
      LEFT JOIN t130 ON t130.record_id = f.record_id LEFT JOIN t240 ON t240.record_id = f.record_id
      LEFT JOIN ho ON ho.record_id = f.record_id AND ho.ord = f.ord
      WHERE f.tag IN ('530', '533', '534')),
ca AS (SELECT record_id, NI, T, unnest(list_filter(sfs, lambda s: s.code = 'a')) AS x FROM c WHERE tag = '533')"""

_REPRO_SELS = [
    triple_select("c", "W", q(BF + "hasInstance"), "NI", "'uri'"),
    triple_select("c", "NI", q(TYPE), q(BF + "Instance"), "'uri'"),
    triple_select("c", "NI", q(BF + "instanceOf"), "W", "'uri'"),
    triple_select("c", "NI", q(BF + "title"), "T", "'bnode'"),
    triple_select("c", "T", q(TYPE), "cls", "'uri'"),
    triple_select("c", "T", q(LABEL), "title", "'literal'", "title <> ''"),
    triple_select("c", "NI", q(BF + "reproductionOf"), "I", "'uri'", "tag = '533'"),
    triple_select("c", "I", q(BF + "hasReproduction"), "NI", "'uri'", "tag = '533'"),
    triple_select("ca", "NI", q(BF + "carrier"), "T || '-carrier-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'"),
    triple_select("ca", "T || '-carrier-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Carrier"), "'uri'"),
    triple_select("ca", "T || '-carrier-' || CAST(x.sf_ord AS VARCHAR)", q(LABEL), "rtrim(x.value, '.:,;/ ')"),
    triple_select("c", "NI", q(BF + "hasItem"), "ITEM", "'uri'", "holding_ord IS NOT NULL"),
    triple_select("c", "ITEM", q(TYPE), q(BF + "Item"), "'uri'", "holding_ord IS NOT NULL"),
    triple_select("c", "ITEM", q(BF + "itemOf"), "NI", "'uri'", "holding_ord IS NOT NULL"),
]


@query("reproductions", f"WITH {_REPRO_PREP}\n" + finish("R25", _REPRO_SELS))
def reproductions(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return CP.reproductions(fx.nested("fx_all"), ruris(fx))


# ---- R32 alternate script (880 linked to 245) -------------------------------------------
_ALT_PREP = f"""{R_CTE},
{nested_cte('f', "tag IN ('880', '130', '240')")},
u AS (SELECT DISTINCT record_id FROM f WHERE tag IN ('130', '240')),
a AS (SELECT f.* FROM f WHERE tag = '880' AND substr(list_filter(sfs, lambda s: s.code = '6')[1].value, 1, 3) = '245'),
s6 AS (SELECT a.*, list_filter(sfs, lambda s: s.code = '6')[1].value AS sf6, substr(x.c008, 36, 3) AS lang008
       FROM a JOIN fx_records x USING (record_id)),
k6 AS (SELECT s6.*, CASE WHEN instr(sf6, '/') > 0 THEN substr(sf6, instr(sf6, '/') + 1) ELSE '' END AS rest FROM s6),
c6 AS (SELECT k6.*, CASE WHEN instr(rest, '/') > 0 THEN substr(rest, 1, instr(rest, '/') - 1) ELSE rest END AS sc FROM k6),
n6 AS (SELECT c6.*, CASE WHEN sc = '(3' THEN 'arab' WHEN sc = '(B' THEN 'latn' WHEN sc = '$1' AND lang008 = 'kor' THEN 'hang'
        WHEN sc = '$1' AND lang008 = 'chi' THEN 'hani' WHEN sc = '$1' AND lang008 = 'jpn' THEN 'jpan' WHEN sc = '(N' THEN 'cyrl'
        WHEN sc = '(S' THEN 'grek' WHEN sc = '(2' THEN 'hebr' END AS script, lm.xl FROM c6
      LEFT JOIN {_vals(LANGUAGE_MAP, 'iso, xl', 'lm')} ON lm.iso = c6.lang008),
g AS (SELECT n6.*, CASE WHEN coalesce(xl, '') <> '' AND coalesce(script, '') <> '' THEN xl || '-' || script END AS lang,
        r.ruri || '#Work' AS W, r.ruri || '#Instance' AS I, {bn('worktitle')} AS Tw, {bn('instancetitle')} AS Ti,
        u.record_id IS NOT NULL AS has_uniform, {_spaced_sql('abfgknps')} AS L
      FROM n6 JOIN r USING (record_id) LEFT JOIN u USING (record_id)),
k AS (SELECT *, CASE WHEN TRY_CAST(ind2 AS INT) IS NULL THEN ''
        ELSE substr(L, TRY_CAST(ind2 AS INT) + 1, greatest(length(L) - TRY_CAST(ind2 AS INT) - 1, 0)) END AS key FROM g),
t2 AS (SELECT record_id, W AS owner, Tw AS T, L, key, sfs, lang FROM k WHERE NOT has_uniform
       UNION ALL SELECT record_id, I, Ti, L, key, sfs, lang FROM k),
p AS (SELECT record_id, T, lang, unnest(sfs) AS x FROM t2),
c AS (SELECT record_id, I, lang, unnest(sfs) AS x FROM k)"""

_ALT_SELS = [
    triple_select("t2", "owner", q(BF + "title"), "T", "'bnode'"),
    triple_select("t2", "T", q(TYPE), q(BF + "Title"), "'uri'"),
    triple_select("t2", "T", q(LABEL), "substr(L, 1, greatest(length(L) - 1, 0))", "'literal'", "L <> ''", lang="lang"),
    triple_select("t2", "T", q(BFLC + "titleSortKey"), "key", "'literal'", "L <> ''"),
    triple_select("c", "I", q(BF + "responsibilityStatement"), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = 'c'", lang="lang"),
] + [triple_select("p", "T", q(BF + prop), "rtrim(x.value, '.:,;/ ')", "'literal'", f"x.code = '{code}'", lang="lang")
     for code, prop in {"a": "mainTitle", "b": "subtitle", "n": "partNumber", "p": "partName"}.items()]


@query("alternate_script", f"WITH {_ALT_PREP}\n" + finish("R32", _ALT_SELS))
def alternate_script(spark, sf_dir):
    """880 fields go to the rule of their linked tag (here 245) with xml:lang."""
    fx = Fixtures(spark, sf_dir)
    lm = spark.createDataFrame(LANGUAGE_MAP, "iso string, xl string")
    h = fx.fx_records.select("record_id", F.substring("c008", 36, 3).alias("lang008")).join(ruris(fx), "record_id")
    h = h.join(F.broadcast(lm), F.col("lang008") == F.col("iso"), "left")
    f = nested(fx)
    sf6 = C.first_value(F.col("sfs"), "6")
    lang6 = f.where(F.col("tag") == "880").select("record_id", "ord", sf6.alias("sf6"))
    j = lang6.join(h, "record_id")
    script = X.script_name(F.col("sf6"), F.col("lang008"))
    ok = (F.coalesce(F.col("xl"), F.lit("")) != "") & (F.coalesce(script, F.lit("")) != "")
    langs = j.select("record_id", "ord", F.when(ok, F.concat(F.col("xl"), F.lit("-"), script)).alias("lang"))
    fl = f.join(langs, ["record_id", "ord"], "left")
    return TI.title_245(fl, ruris(fx), alternate=True)


# ---- R31 control subfields ------------------------------------------------------------------
from ..plans import control as CS  # noqa: E402

_T7 = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CS.TYPE_7)
_I7 = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CS.ISSUANCE_7)
_CS_PREP = f"""s AS (SELECT record_id, ord, sf_ord, code, value,
    '_:' || record_id || '-' || CAST(ord AS VARCHAR) || '-0-field-1' AS O,
    '_:' || record_id || '-' || CAST(ord AS VARCHAR) || '-0-field-1-' || code || '-' || CAST(sf_ord AS VARCHAR) AS N,
    CASE substr(value, 1, 1) {_T7} END AS t7, CASE substr(value, 2, 1) {_I7} END AS i7,
    {x08_source_sql('value')} AS src, {x08_value_sql('value')} AS val
  FROM fx_allnotes WHERE code IN ('0', 'w', '2', '3', '5', '7', 'u'))"""

_CS_SELS = [
    triple_select("s", "O", q(BF + "identifiedBy"), "N", "'bnode'", "code IN ('0', 'w')"),
    triple_select("s", "N", q(TYPE), q(BF + "Identifier"), "'uri'", "code IN ('0', 'w')"),
    triple_select("s", "N", q(RDF + "value"), "val", "CASE WHEN instr(val, '://') > 0 THEN 'uri' ELSE 'literal' END", "code IN ('0', 'w')"),
    triple_select("s", "N", q(BF + "source"), "N || '-source'", "'bnode'", "code IN ('0', 'w') AND src <> ''"),
    triple_select("s", "N || '-source'", q(TYPE), q(BF + "Source"), "'uri'", "code IN ('0', 'w') AND src <> ''"),
    triple_select("s", "N || '-source'", q(LABEL), "src", "'literal'", "code IN ('0', 'w') AND src <> ''"),
    triple_select("s", "O", q(BF + "source"), "N", "'bnode'", "code = '2'"),
    triple_select("s", "N", q(TYPE), q(BF + "Source"), "'uri'", "code = '2'"),
    triple_select("s", "N", q(LABEL), "value", "'literal'", "code = '2'"),
    triple_select("s", "O", q(BFLC + "appliesTo"), "N", "'bnode'", "code = '3'"),
    triple_select("s", "N", q(TYPE), q(BFLC + "AppliesTo"), "'uri'", "code = '3'"),
    triple_select("s", "N", q(LABEL), "rtrim(value, '.:,;/ ')", "'literal'", "code = '3'"),
    triple_select("s", "O", q(BFLC + "applicableInstitution"), "N", "'bnode'", "code = '5'"),
    triple_select("s", "N", q(TYPE), q(BF + "Agent"), "'uri'", "code = '5'"),
    triple_select("s", "N", q(BF + "code"), "value", "'literal'", "code = '5'"),
    triple_select("s", "O", q(TYPE), f"'{BF}' || t7", "'uri'", "code = '7' AND t7 IS NOT NULL"),
    triple_select("s", "O", q(BF + "issuance"), "N", "'bnode'", "code = '7' AND i7 IS NOT NULL"),
    triple_select("s", "N", q(TYPE), q(BF + "Issuance"), "'uri'", "code = '7' AND i7 IS NOT NULL"),
    triple_select("s", "N", q(BF + "code"), "i7", "'literal'", "code = '7' AND i7 IS NOT NULL"),
    triple_select("s", "O", q(LABEL), "value", "'literal'", "code = 'u'", datatype=q(X.XS + "anyURI")),
]


@query("control_subfields", f"WITH {_CS_PREP}\n" + finish("R31", _CS_SELS))
def control_subfields(spark, sf_dir):
    return CS.control_subfields(Fixtures(spark, sf_dir).fx_allnotes)


# ---- R10 capture -----------------------------------------------------------------------------
from ..plans import capture as CAP  # noqa: E402


def _edtf_sql(s: str) -> str:
    t = f"(translate(substr({s}, 1, 12), '-', 'X') || substr({s}, 13))"
    return (f"(CASE WHEN substr({t}, 7, 2) <> '' THEN substr({t}, 1, 4) || '-' || substr({t}, 5, 2) || '-' || substr({t}, 7, 2) "
            f"ELSE substr({t}, 1, 4) || '-' || substr({t}, 5, 2) END "
            f"|| CASE WHEN substr({t}, 9, 4) <> '' THEN 'T' || substr({t}, 9, 2) || ':' || substr({t}, 11, 2) || ':00' ELSE '' END "
            f"|| CASE WHEN substr({t}, 13, 5) <> '' THEN substr({t}, 13, 3) || ':' || substr({t}, 16, 2) ELSE '' END)")


_CAP_PREP = f"""{R_CTE},
{nested_cte('f', "tag = '033'").replace('fx_subfields', 'fx_all')},
g AS (SELECT f.*, r.ruri || '#Work' AS W, {bn('capture')} AS CP,
        CASE ind1 WHEN '0' THEN {_edtf_sql("coalesce(list_filter(sfs, lambda s: s.code = 'a')[1].value, '')")}
                  WHEN '2' THEN array_to_string(list_transform(list_filter(sfs, lambda s: s.code = 'a'), lambda s: {_edtf_sql('s.value')}), '/')
                  ELSE '' END AS date,
        CASE ind2 WHEN '1' THEN 'broadcast' WHEN '2' THEN 'finding' END AS note
      FROM f JOIN r USING (record_id)),
s AS (SELECT record_id, ord, sf_ord, code, value, lead(code) OVER w AS n_code, lead(value) OVER w AS n_value
      FROM fx_all WHERE tag = '033' WINDOW w AS (PARTITION BY record_id, ord ORDER BY sf_ord)),
p AS (SELECT s.record_id, g.CP, s.sf_ord, {_ns("concat_ws(' ', s.value, CASE WHEN s.n_code = 'c' THEN s.n_value END)")} AS v,
        g.CP || '-place-' || CAST(s.sf_ord AS VARCHAR) AS P FROM s JOIN g ON g.record_id = s.record_id AND g.ord = s.ord WHERE s.code = 'b'),
x AS (SELECT g.record_id, g.CP, g.ind1, unnest(g.sfs) AS x FROM g)"""

_CAP_SELS = [
    triple_select("g", "W", q(BF + "capture"), "CP", "'bnode'"),
    triple_select("g", "CP", q(TYPE), q(BF + "Capture"), "'uri'"),
    triple_select("g", "CP", q(BF + "note"), "CP || '-note'", "'bnode'", "note IS NOT NULL"),
    triple_select("g", "CP || '-note'", q(TYPE), q(BF + "Note"), "'uri'", "note IS NOT NULL"),
    triple_select("g", "CP || '-note'", q(LABEL), "note", "'literal'", "note IS NOT NULL"),
    triple_select("g", "CP", q(BF + "date"), "date", "'literal'", "date <> ''", datatype=q(X.EDTF)),
    triple_select("x", "CP", q(BF + "date"), _edtf_sql("x.value"), "'literal'", "ind1 = '1' AND x.code = 'a'", datatype=q(X.EDTF)),
    triple_select("p", "CP", q(BF + "place"), "P", "'bnode'"),
    triple_select("p", "P", q(TYPE), q(BF + "Place"), "'uri'"),
    triple_select("p", "P", q(RDF + "value"), "v"),
    triple_select("p", "P", q(BF + "source"), "P || '-source'", "'bnode'"),
    triple_select("p", "P || '-source'", q(TYPE), q(BF + "Source"), "'uri'"),
    triple_select("p", "P || '-source'", q(LABEL), f"'{CAP.PLACE_SOURCE}'"),
    triple_select("x", "CP", q(BFLC + "appliesTo"), "CP || '-appliesTo-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'", "x.code = '3'"),
    triple_select("x", "CP || '-appliesTo-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BFLC + "AppliesTo"), "'uri'", "x.code = '3'"),
    triple_select("x", "CP || '-appliesTo-' || CAST(x.sf_ord AS VARCHAR)", q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = '3'"),
]


@query("capture_events", f"WITH {_CAP_PREP}\n" + finish("R10", _CAP_SELS))
def capture_events(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return CAP.capture_events(fx.nested("fx_all"), ruris(fx))


# ---- R12 acquisition ----------------------------------------------------------------------------
from ..plans import acquisition as ACQ  # noqa: E402

_ACQ_PREP = f"""{R_CTE},
{nested_cte('f', "tag = '037'").replace('fx_subfields', 'fx_notes')},
g AS (SELECT f.*, r.ruri || '#Instance' AS I, {bn('acquisitionSource')} AS A,
        CASE ind1 WHEN '2' THEN 'intervening source' WHEN '3' THEN 'current source' END AS note FROM f JOIN r USING (record_id)),
x AS (SELECT record_id, A, unnest(sfs) AS x FROM g)"""


def _an(kind):
    return f"A || '-{kind}-' || CAST(x.sf_ord AS VARCHAR)"


_ACQ_SELS = [
    triple_select("g", "I", q(BF + "acquisitionSource"), "A", "'bnode'"),
    triple_select("g", "A", q(TYPE), q(BF + "AcquisitionSource"), "'uri'"),
    triple_select("g", "A", q(BF + "note"), "A || '-note'", "'bnode'", "note IS NOT NULL"),
    triple_select("g", "A || '-note'", q(TYPE), q(BF + "Note"), "'uri'", "note IS NOT NULL"),
    triple_select("g", "A || '-note'", q(LABEL), "note", "'literal'", "note IS NOT NULL"),
    triple_select("x", "A", q(BFLC + "appliesTo"), _an("appliesTo"), "'bnode'", "x.code = '3'"),
    triple_select("x", _an("appliesTo"), q(TYPE), q(BFLC + "AppliesTo"), "'uri'", "x.code = '3'"),
    triple_select("x", _an("appliesTo"), q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = '3'"),
    triple_select("x", "A", q(BF + "identifiedBy"), _an("stock"), "'bnode'", "x.code = 'a'"),
    triple_select("x", _an("stock"), q(TYPE), q(BF + "StockNumber"), "'uri'", "x.code = 'a'"),
    triple_select("x", _an("stock"), q(RDF + "value"), "x.value", "'literal'", "x.code = 'a'"),
    triple_select("x", "A", q(LABEL), "x.value", "'literal'", "x.code = 'b'"),
    triple_select("x", "A", q(BF + "acquisitionTerms"), "x.value", "'literal'", "x.code = 'c'"),
    triple_select("x", "A", q(BF + "note"), _an("note"), "'bnode'", "x.code IN ('f', 'g', 'n')"),
    triple_select("x", _an("note"), q(TYPE), q(BF + "Note"), "'uri'", "x.code IN ('f', 'g', 'n')"),
    triple_select("x", _an("note"), q(LABEL), "x.value", "'literal'", "x.code IN ('f', 'g', 'n')"),
    triple_select("x", "A", q(BFLC + "applicableInstitution"), _an("institution"), "'bnode'", "x.code = '5'"),
    triple_select("x", _an("institution"), q(TYPE), q(BF + "Agent"), "'uri'", "x.code = '5'"),
    triple_select("x", _an("institution"), q(BF + "code"), "x.value", "'literal'", "x.code = '5'"),
]


@query("acquisition", f"WITH {_ACQ_PREP}\n" + finish("R12", _ACQ_SELS))
def acquisition(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return ACQ.acquisition(fx.nested("fx_notes"), ruris(fx))


# ---- R17 subject names -------------------------------------------------------------------------
_SN_PREP = f"""{R_CTE},
{nested_cte('f', "tag IN ('600', '610', '611')").replace('fx_subfields', 'fx_all')},
th AS (SELECT DISTINCT t_ind2, t_code FROM {_vals(_th_rows(), 't_ind2, t_code, t_scheme', 'tv')}),
ts AS (SELECT t_ind2, t_scheme FROM {_vals(_th_rows(), 't_ind2, t_code, t_scheme', 'tw')} WHERE t_scheme IS NOT NULL),
y AS (SELECT f.*, r.ruri, {_MARK} AS m, th.t_code, substr(f.tag, 2, 2) AS xx,
        list_max(list_transform(list_filter(sfs, lambda s: s.code = 't'), lambda s: s.sf_ord)) AS lt,
        list_min(list_transform(list_filter(sfs, lambda s: s.code = 't'), lambda s: s.sf_ord)) AS ft,
        list_filter(sfs, lambda s: s.code = '2')[1].value AS code2
      FROM f JOIN r USING (record_id) LEFT JOIN th ON th.t_ind2 = f.ind2),
z AS (SELECT y.*,
        CASE WHEN xx = '00' THEN {_sp("s.code IN ('a','b','c','d','j','q')", 'sfs')}
             WHEN xx = '10' THEN {_sp("s.code IN ('a','b','c','d','n','g') AND (lt IS NULL OR s.sf_ord < lt)", 'sfs')}
             WHEN xx = '11' THEN {_sp("s.code IN ('a','c','d','e','n','g','q') AND (lt IS NULL OR s.sf_ord < lt)", 'sfs')} END AS nlab,
        CASE WHEN xx = '00' THEN {_sp("s.code = 't' OR (instr('fgklmnoprs', s.code) > 0 AND ft IS NOT NULL AND s.sf_ord > ft)", 'sfs')}
             WHEN xx = '10' THEN {_sp("s.code = 't' OR (instr('dfgklmnoprs', s.code) > 0 AND ft IS NOT NULL AND s.sf_ord > ft)", 'sfs')}
             WHEN xx = '11' THEN {_sp("s.code = 't' OR (instr('fgklnps', s.code) > 0 AND ft IS NOT NULL AND s.sf_ord > ft)", 'sfs')}
             ELSE '' END AS tlab,
        CASE WHEN len(list_filter(sfs, lambda s: s.code IN ('v','x','y','z'))) > 0 THEN 'ComplexSubject'
             WHEN len(list_filter(sfs, lambda s: s.code = 't')) > 0 THEN 'NameTitle'
             WHEN tag = '600' THEN 'Name' WHEN tag = '610' THEN 'CorporateName' WHEN tag = '611' THEN 'ConferenceName' END AS mads,
        CASE WHEN xx = '00' THEN CASE WHEN ind1 = '3' THEN 'Family' ELSE 'Person' END
             WHEN xx = '10' THEN CASE WHEN ind1 = '1' THEN 'Jurisdiction' ELSE 'Organization' END
             WHEN xx = '11' THEN 'Meeting' END AS cls,
        instr(m, 'T') > 0 AS has_t, instr(m, 'T') AS pos_t,
        CASE WHEN regexp_matches(m, 'Q-*T') THEN length(regexp_extract(m, '^(.*?)Q-*T', 1)) + 1 ELSE 0 END AS agent_t FROM y),
u AS (SELECT z.*, CASE WHEN has_t THEN agent_t ELSE instr(m, 'Q') END AS apos,
        CASE WHEN has_t THEN CASE WHEN instr(substr(m, pos_t + 1), 'Q') > 0 THEN pos_t + instr(substr(m, pos_t + 1), 'Q') ELSE 0 END
             ELSE instr(m, 'Q') END AS wpos,
        rtrim(rtrim({_ns("coalesce(nlab, '') || ' ' || tlab")}, ':,;/ ') || '--' ||
          array_to_string(list_transform(list_filter(sfs, lambda s: s.code IN ('v','x','y','z')), lambda s: s.value || '--'), ''), '- ') AS ml
      FROM z),
k AS (SELECT u.*,
        coalesce(nullif({uri_sql('CASE WHEN apos > 0 THEN sfs[apos].value END')}, ''), ruri || '#Agent' || tag || '-' || CAST(ord AS VARCHAR)) AS A,
        coalesce(nullif({uri_sql('CASE WHEN wpos > 0 THEN sfs[wpos].value END')}, ''), ruri || '#Work' || tag || '-' || CAST(ord AS VARCHAR)) AS WI,
        ruri || '#Work' AS W, {bn('contribution')} AS Cn, {_ns('nlab')} AS nl FROM u),
k2 AS (SELECT k.*, CASE WHEN has_t THEN WI ELSE A END AS S,
        t_code IS NOT NULL OR (ind2 = '7' AND code2 IS NOT NULL) AS has_src FROM k),
sc AS (SELECT k2.record_id, k2.S, ts.t_scheme FROM k2 JOIN ts ON ts.t_ind2 = k2.ind2)"""

_SN_SELS = [
    triple_select("k2", "W", q(BF + "subject"), "S", "'uri'"),
    triple_select("k2", "S", q(TYPE), f"'{X.MADSRDF}' || mads", "'uri'"),
    triple_select("k2", "S", q(X.MADSRDF + "authoritativeLabel"), "ml"),
    triple_select("sc", "S", q(X.MADSRDF + "isMemberofMADSScheme"), "t_scheme", "'uri'"),
    triple_select("k2", "S", q(BF + "source"), "S || '-source'", "'bnode'", "has_src"),
    triple_select("k2", "S || '-source'", q(TYPE), q(BF + "Source"), "'uri'", "has_src"),
    triple_select("k2", "S || '-source'", q(BF + "code"), "coalesce(t_code, code2)", "'literal'", "has_src"),
    triple_select("k2", "WI", q(TYPE), q(BF + "Work"), "'uri'", "has_t"),
    triple_select("k2", "WI", q(BF + "contribution"), "Cn", "'bnode'", "has_t"),
    triple_select("k2", "Cn", q(TYPE), q(BF + "Contribution"), "'uri'", "has_t"),
    triple_select("k2", "Cn", q(BF + "agent"), "A", "'uri'", "has_t"),
    triple_select("k2", "Cn", q(BF + "role"), q(X.RELATORS + "ctb"), "'uri'", "has_t"),
    triple_select("k2", "A", q(TYPE), q(BF + "Agent"), "'uri'"),
    triple_select("k2", "A", q(TYPE), f"'{BF}' || cls", "'uri'", "cls IS NOT NULL"),
    triple_select("k2", "A", q(LABEL), "nl", "'literal'", "coalesce(nl, '') <> ''"),
]


@query("subject_names", f"WITH {_SN_PREP}\n" + finish("R17", _SN_SELS))
def subject_names(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return N.subject_names(spark, ruris(fx), fx.nested("fx_all"))


# ---- R19 uniform titles ---------------------------------------------------------------------------
from ..plans import uniform as UT  # noqa: E402


def _utitle_sels(src: str, owner: str, T: str, L: str, where: str) -> list[str]:
    key = _ns(f"substr({L}, coalesce(TRY_CAST(nfi AS INT), 0) + 1)")
    w = f" AND {where}" if where else ""
    return [
        triple_select(src, owner, q(LABEL), _ns(L), "'literal'", f"{L} <> ''{w}"),
        triple_select(src, owner, q(BF + "title"), T, "'bnode'", where),
        triple_select(src, T, q(TYPE), q(BF + "Title"), "'uri'", where),
        triple_select(src, T, q(LABEL), f"substr({L}, 1, greatest(length({L}) - 1, 0))", "'literal'", f"{L} <> ''{w}"),
        triple_select(src, T, q(BFLC + "titleSortKey"), key, "'literal'", f"{L} <> ''{w}"),
    ]


_UT_PREP = f"""{R_CTE},
{nested_cte('f', "tag IN ('130', '240', '041')").replace('fx_subfields', 'fx_all')},
hh AS (SELECT record_id, count(*) AS n_h, min(h) AS h, min(ind2) AS h_ind2 FROM
        (SELECT record_id, ind2, unnest(list_transform(list_filter(sfs, lambda s: s.code = 'h'), lambda s: s.value)) AS h
         FROM f WHERE tag = '041' AND ind1 = '1') z GROUP BY record_id HAVING count(*) = 1),
g AS (SELECT f.*, r.ruri, {_MARK} AS m, CASE WHEN tag = '130' THEN ind1 ELSE ind2 END AS nfi, hh.h, hh.h_ind2,
        {_spaced_sql('adfgklmnoprs')} AS L, {_spaced_sql('adfgkmnoprs')} AS Lt, r.ruri || '#Work' AS W,
        {bn('uniformtitle').replace('record_id', 'f.record_id').replace('CAST(ord', 'CAST(f.ord')} AS T,
        {bn('translationtitle').replace('record_id', 'f.record_id').replace('CAST(ord', 'CAST(f.ord')} AS TT,
        {bn('language').replace('record_id', 'f.record_id').replace('CAST(ord', 'CAST(f.ord')} AS LG,
        len(list_filter(sfs, lambda s: s.code = 'l')) > 0 AS has_l
      FROM f JOIN r ON r.record_id = f.record_id LEFT JOIN hh ON hh.record_id = f.record_id WHERE f.tag IN ('130', '240')),
k AS (SELECT g.*, CASE WHEN instr(m, 'T') > 0 THEN CASE WHEN instr(substr(m, instr(m, 'T') + 1), 'Q') > 0
          THEN {uri_sql("sfs[instr(m, 'T') + instr(substr(m, instr(m, 'T') + 1), 'Q')].value")} END
        WHEN instr(m, 'Q') > 0 THEN {uri_sql("sfs[instr(m, 'Q')].value")} END AS wu FROM g),
k2 AS (SELECT k.*, coalesce(nullif(wu, ''), ruri || '#Work' || tag || '-' || CAST(ord AS VARCHAR)) AS WT FROM k),
p AS (SELECT record_id, W, WT, T, TT, has_l, LG, unnest(sfs) AS x FROM k2)"""

_UT_SELS = (_utitle_sels("k2", "W", "T", "L", "") + _utitle_sels("k2", "WT", "TT", "Lt", "has_l") + [
    triple_select("p", "T", q(BF + prop), "rtrim(x.value, '.:,;/ ')", "'literal'", f"x.code = '{code}'")
    for code, prop in {"a": "mainTitle", "n": "partNumber", "p": "partName"}.items()] + [
    triple_select("p", "TT", q(BF + prop), "rtrim(x.value, '.:,;/ ')", "'literal'", f"has_l AND x.code = '{code}'")
    for code, prop in {"a": "mainTitle", "n": "partNumber", "p": "partName"}.items()] + [
    triple_select("p", "W", q(BF + "language"), "LG || '-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'", "x.code = 'l'"),
    triple_select("p", "LG || '-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Language"), "'uri'", "x.code = 'l'"),
    triple_select("p", "LG || '-' || CAST(x.sf_ord AS VARCHAR)", q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = 'l'"),
    triple_select("k2", "W", q(BF + "translationOf"), "WT", "'uri'", "has_l"),
    triple_select("k2", "WT", q(TYPE), q(BF + "Work"), "'uri'", "has_l"),
    triple_select("k2", "WT", q(BF + "language"), f"'{X.LANGUAGES}' || h", "'uri'", "has_l AND h IS NOT NULL AND h_ind2 = ' '"),
    triple_select("k2", "WT", q(BF + "language"), "LG || '-translation'", "'bnode'", "has_l AND h IS NOT NULL AND h_ind2 <> ' '"),
    triple_select("k2", "LG || '-translation'", q(TYPE), q(BF + "Language"), "'uri'", "has_l AND h IS NOT NULL AND h_ind2 <> ' '"),
    triple_select("k2", "LG || '-translation'", q(LABEL), "h", "'literal'", "has_l AND h IS NOT NULL AND h_ind2 <> ' '"),
])


@query("uniform_titles", f"WITH {_UT_PREP}\n" + finish("R19", _UT_SELS))
def uniform_titles(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return UT.uniform_titles(fx.nested("fx_all"), ruris(fx))


# ---- R08 008 instance fields ------------------------------------------------------------------
_FI_PREP = f"""{R_CTE},
h0 AS (SELECT x.record_id, x.c008, r.ruri || '#Instance' AS I, substr(c008, 7, 1) AS dt, substr(c008, 8, 4) AS d1,
         substr(c008, 12, 4) AS d2raw, CASE WHEN substr(c008, 18, 1) = ' ' THEN substr(c008, 16, 2) ELSE substr(c008, 16, 3) END AS place
       FROM fx_records x JOIN r USING (record_id) WHERE c008 IS NOT NULL),
h AS (SELECT *, coalesce(translate(CASE
    WHEN dt = 'c' THEN d1 || '/..'
    WHEN dt IN ('d','i','k','m','q','u') OR (dt = '|' AND d1 NOT IN ('    ','||||') AND d2raw NOT IN ('    ','||||')) THEN d1 || '/' || d2raw
    WHEN dt = 'e' THEN CASE WHEN substr(c008, 14, 2) = '  ' THEN d1 || '-' || substr(c008, 12, 2)
                            ELSE d1 || '-' || substr(c008, 12, 2) || '-' || substr(c008, 14, 2) END
    WHEN dt IN ('p','r','s','t') OR (dt = '|' AND d1 NOT IN ('    ','||||')) THEN d1 END, 'uU', 'XX'), '') AS pdate,
    translate(d2raw, 'uU', 'XX') AS d2,
    '_:' || record_id || '-0-0-provision008-1' AS P, '_:' || record_id || '-0-0-production008-1' AS P2,
    '_:' || record_id || '-0-0-note008-1' AS N,
    CASE WHEN dt IN ('c','d','e','m','q','r','s','t','u','|') THEN 'Publication' WHEN dt IN ('i','k') THEN 'Production'
         WHEN dt = 'p' THEN 'Distribution' END AS ptype,
    place <> '' AND place <> '|||' AS has_place, '{X.COUNTRIES}' || place AS PU FROM h0),
d AS (SELECT * FROM h WHERE pdate <> ''), u AS (SELECT * FROM h WHERE pdate = '' AND has_place),
ih AS (SELECT x.record_id, x.c008, r.ruri, {_MAT_SQL} AS material FROM fx_records x JOIN r USING (record_id)),
ic AS (SELECT ih.record_id, ih.ruri, mr.list, CAST(mr.pos AS INT) AS pos, substr(substr(ih.c008, 19, 17), CAST(mr.pos AS INT), 1) AS key
       FROM ih JOIN {_cand_sql(FX.INSTANCE_READS)} ON mr.material = ih.material),
ihits AS (SELECT ic.*, v.uri, v.label, ic.ruri || '#Instance' AS I,
            coalesce(v.uri, '_:' || ic.record_id || '-008i-' || CAST(ic.pos AS VARCHAR) || '-' || ic.list) AS U,
            CASE WHEN v.uri IS NULL THEN 'bnode' ELSE 'uri' END AS K
          FROM ic JOIN {V.values_sql(FX.INSTANCE_LISTS, 'v_list, v_key, uri, label')} ON v.v_list = ic.list AND v.v_key = ic.key)"""

_FI_SELS = [
    triple_select("d", "I", q(BF + "provisionActivity"), "P", "'bnode'"),
    triple_select("d", "P", q(BF + "date"), "pdate", "'literal'", datatype=q(X.EDTF)),
    triple_select("d", "P", q(TYPE), f"'{BF}' || ptype", "'uri'", "ptype IS NOT NULL"),
    triple_select("d", "P", q(BF + "note"), "P || '-note'", "'bnode'", "dt IN ('i', 'k')"),
    triple_select("d", "P || '-note'", q(TYPE), q(BF + "Note"), "'uri'", "dt IN ('i', 'k')"),
    triple_select("d", "P || '-note'", q(LABEL), "CASE WHEN dt = 'i' THEN 'inclusive collection dates' ELSE 'bulk collection dates' END",
                  "'literal'", "dt IN ('i', 'k')"),
    triple_select("d", "P", q(BF + "place"), "PU", "'uri'", "has_place"),
    triple_select("d", "PU", q(TYPE), q(BF + "Place"), "'uri'", "has_place"),
    triple_select("d", "I", q(BF + "note"), "N", "'bnode'", "dt IN ('c', 'd')"),
    triple_select("d", "N", q(TYPE), q(BF + "Note"), "'uri'", "dt IN ('c', 'd')"),
    triple_select("d", "N", q(LABEL), "CASE WHEN dt = 'c' THEN 'Currently published' ELSE 'Ceased publication' END", "'literal'",
                  "dt IN ('c', 'd')"),
    triple_select("d", "I", q(BF + "provisionActivity"), "P2", "'bnode'", "dt = 'p'"),
    triple_select("d", "P2", q(TYPE), q(BF + "Production"), "'uri'", "dt = 'p'"),
    triple_select("d", "P2", q(BF + "date"), "d2", "'literal'", "dt = 'p'", datatype=q(X.EDTF)),
    triple_select("d", "I", q(BF + "copyrightDate"), "d2", "'literal'", "dt = 't'", datatype=q(X.EDTF)),
    triple_select("u", "I", q(BF + "provisionActivity"), "P", "'bnode'"),
    triple_select("u", "P", q(TYPE), q(BF + "Publication"), "'uri'"),
    triple_select("u", "P", q(BF + "place"), "PU", "'uri'"),
    triple_select("u", "PU", q(TYPE), q(BF + "Place"), "'uri'"),
    triple_select("ihits", "I", f"CASE list WHEN 'millus' THEN {q(BF + 'illustrativeContent')} WHEN 'carrier' THEN {q(BF + 'carrier')} "
                  f"ELSE {q(BF + 'supplementaryContent')} END", "U", "K"),
    triple_select("ihits", "U", q(TYPE), f"CASE list WHEN 'millus' THEN {q(BF + 'Illustration')} WHEN 'carrier' THEN {q(BF + 'Carrier')} "
                  f"ELSE {q(BF + 'SupplementaryContent')} END", "'uri'"),
    triple_select("ihits", "U", q(LABEL), "label"),
]


@query("fixed_field_instance", f"WITH {_FI_PREP}\n" + finish("R08", _FI_SELS))
def fixed_field_instance(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return FX.fixed_field_instance(REC.headers_with_uri(fx.fx_records), spark)


# ---- R28 linking entries, R27 hierarchical places ------------------------------------------------
from ..plans import links as LK  # noqa: E402

_LK_TAGS = ", ".join(sorted({f"'{r[0]}'" for r in LK.LINK_PROPERTY}))
_LK_PREP = f"""{R_CTE},
{nested_cte('f', f"tag IN ({_LK_TAGS})").replace('fx_subfields', 'fx_notes')},
g AS (SELECT f.*, coalesce(ex.prop, st.prop) AS lprop, r.ruri || '#Work' AS W, {_MARK} AS m,
        r.ruri || '#Work' || tag || '-' || CAST(ord AS VARCHAR) AS dflt, {bn('link').replace('record_id', 'f.record_id').replace('CAST(ord', 'CAST(f.ord')} AS B
      FROM f LEFT JOIN {_vals([r for r in LK.LINK_PROPERTY if r[1] != '*'], 'l_tag, l_ind2, prop', 'ex')} ON ex.l_tag = f.tag AND ex.l_ind2 = f.ind2
      LEFT JOIN {_vals([r for r in LK.LINK_PROPERTY if r[1] == '*'], 'l_tag, l_ind2, prop', 'st')} ON st.l_tag = f.tag
      JOIN r ON r.record_id = f.record_id),
k AS (SELECT g.*, coalesce(nullif(CASE WHEN instr(m, 'T') > 0 THEN NULL WHEN instr(m, 'Q') > 0 THEN {uri_sql("sfs[instr(m, 'Q')].value")} END, ''), dflt) AS L
      FROM g WHERE lprop IS NOT NULL),
x AS (SELECT record_id, W, L, B, unnest(sfs) AS x FROM k)"""


def _lk(kind):
    return f"B || '-{kind}-' || CAST(x.sf_ord AS VARCHAR)"


_LK_SELS = [
    triple_select("k", "W", f"'{BF}' || lprop", "L", "'uri'"),
    triple_select("k", "L", q(TYPE), q(BF + "Work"), "'uri'"),
    triple_select("x", "L", q(BF + "contribution"), _lk("contribution"), "'bnode'", "x.code = 'a'"),
    triple_select("x", _lk("contribution"), q(TYPE), q(BFLC + "PrimaryContribution"), "'uri'", "x.code = 'a'"),
    triple_select("x", _lk("contribution"), q(BF + "agent"), _lk("agent"), "'bnode'", "x.code = 'a'"),
    triple_select("x", _lk("agent"), q(TYPE), q(BF + "Agent"), "'uri'", "x.code = 'a'"),
    triple_select("x", _lk("agent"), q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = 'a'"),
    triple_select("x", "L", q(BF + "title"), _lk("title"), "'bnode'", "x.code = 't'"),
    triple_select("x", _lk("title"), q(TYPE), q(BF + "Title"), "'uri'", "x.code = 't'"),
    triple_select("x", _lk("title"), q(BF + "mainTitle"), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = 't'"),
    triple_select("x", "L", q(BF + "language"), f"'{X.LANGUAGES}' || x.value", "'uri'", "x.code = 'e'"),
    triple_select("x", f"'{X.LANGUAGES}' || x.value", q(TYPE), q(BF + "Language"), "'uri'", "x.code = 'e'"),
    triple_select("x", "L", q(BF + "note"), _lk("note"), "'bnode'", "x.code = 'v'"),
    triple_select("x", _lk("note"), q(TYPE), q(BF + "Note"), "'uri'", "x.code = 'v'"),
    triple_select("x", _lk("note"), q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = 'v'"),
    triple_select("x", "L", q(BFLC + "relationship"), _lk("relationship"), "'bnode'", "x.code = 'i'"),
    triple_select("x", _lk("relationship"), q(TYPE), q(BFLC + "Relationship"), "'uri'", "x.code = 'i'"),
    triple_select("x", _lk("relationship"), q(BFLC + "relation"), _lk("relation"), "'bnode'", "x.code = 'i'"),
    triple_select("x", _lk("relation"), q(TYPE), q(BFLC + "Relation"), "'uri'", "x.code = 'i'"),
    triple_select("x", _lk("relation"), q(LABEL), "rtrim(x.value, '.:,;/ ')", "'literal'", "x.code = 'i'"),
    triple_select("x", _lk("relationship"), q(BF + "relatedTo"), "W", "'uri'", "x.code = 'i'"),
]


@query("linking_entries", f"WITH {_LK_PREP}\n" + finish("R28", _LK_SELS))
def linking_entries(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return LK.linking_entries(spark, fx.nested("fx_notes"), ruris(fx))


_PC = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LK.PLACE_COMPONENTS)
_HP_PREP = f"""{R_CTE},
{nested_cte('f', "tag = '752'").replace('fx_subfields', 'fx_notes')},
g AS (SELECT f.*, r.ruri || '#Work' AS W, {_MARK} AS m, {bn('place')} AS dflt,
        list_filter(sfs, lambda s: s.code IN ('a','b','c','d','f','g','h')) AS comps FROM f JOIN r USING (record_id)),
k AS (SELECT g.*, coalesce(nullif(CASE WHEN instr(m, 'T') > 0 THEN NULL WHEN instr(m, 'Q') > 0 THEN {uri_sql("sfs[instr(m, 'Q')].value")} END, ''), dflt) AS P,
        len(comps) AS n FROM g),
cx AS (SELECT record_id, P, n, generate_subscripts(comps, 1) AS i, unnest(comps) AS x FROM k),
sx AS (SELECT record_id, P, unnest(list_filter(sfs, lambda s: s.code = '2')) AS x FROM k)"""

_HL = "P || '-list-' || CAST(i AS VARCHAR)"
_HC = "P || '-component-' || CAST(i AS VARCHAR)"
_HP_SELS = [
    triple_select("k", "W", q(BF + "place"), "P", "CASE WHEN starts_with(P, '_:') THEN 'bnode' ELSE 'uri' END"),
    triple_select("k", "P", q(TYPE), q(BF + "Place"), "'uri'"),
    triple_select("k", "P", q(X.MADSRDF + "componentList"), "P || '-list-1'", "'bnode'", "n > 0"),
    triple_select("cx", _HL, q(RDF + "first"), _HC, "'bnode'"),
    triple_select("cx", _HL, q(RDF + "rest"), f"CASE WHEN i < n THEN P || '-list-' || CAST(i + 1 AS VARCHAR) ELSE {q(RDF + 'nil')} END",
                  "CASE WHEN i < n THEN 'bnode' ELSE 'uri' END"),
    triple_select("cx", _HC, q(TYPE), f"'{X.MADSRDF}' || CASE x.code {_PC} END", "'uri'"),
    triple_select("cx", _HC, q(X.MADSRDF + "authoritativeLabel"), "x.value"),
    triple_select("sx", "P", q(BF + "source"), "P || '-source-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'"),
    triple_select("sx", "P || '-source-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Source"), "'uri'"),
    triple_select("sx", "P || '-source-' || CAST(x.sf_ord AS VARCHAR)", q(LABEL), "x.value"),
]


@query("hierarchical_places", f"WITH {_HP_PREP}\n" + finish("R27", _HP_SELS))
def hierarchical_places(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return LK.hierarchical_places(fx.nested("fx_notes"), ruris(fx))


# ---- J01 048 instrument lookup -------------------------------------------------------------------
from ..plans import instruments as INS  # noqa: E402


@query("lookup_instrument", f"""WITH {R_CTE},
s AS (SELECT x.*, substr(value, 1, 2) AS code2, substr(value, 3, 2) AS cnt0 FROM fx_notes x
      WHERE tag = '048' AND ind2 = ' ' AND code IN ('a', 'b')),
j AS (SELECT s.record_id, ic.*, s.cnt0, CASE WHEN TRY_CAST(trim(s.cnt0) AS INT) IS NOT NULL
        THEN CAST(TRY_CAST(trim(s.cnt0) AS INT) AS VARCHAR) ELSE 'NaN' END AS cnt,
        '_:' || s.record_id || '-' || CAST(s.ord AS VARCHAR) || '-' || CAST(s.sf_ord AS VARCHAR) || '-instrument-1' AS N,
        r.ruri || '#Work' AS W
      FROM s JOIN {_vals(INS.INSTRUMENT_CODES, 'i_code, prop, entity, tprop, itype, label', 'ic')} ON ic.i_code = s.code2
      JOIN r ON r.record_id = s.record_id)
""" + finish("R10", [
    triple_select("j", "W", f"'{BF}' || prop", "N", "'bnode'"),
    triple_select("j", "N", q(TYPE), f"'{BF}' || entity", "'uri'"),
    triple_select("j", "N", f"'{BF}' || tprop", "itype"),
    triple_select("j", "N", q(LABEL), "label", "'literal'", "label IS NOT NULL"),
    triple_select("j", "N", q(BF + "count"), "cnt", "'literal'", "cnt0 <> ''"),
]))
def lookup_instrument(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return INS.instruments(spark, fx.fx_notes, ruris(fx))


# ---- R13 classification -----------------------------------------------------------------------------
from ..plans import classification as CL  # noqa: E402

register_extra("fx_class", """
SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM fx_more WHERE tag IN ('050', '051')
UNION ALL SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM fx_notes WHERE tag IN ('060', '082', '084')
""")

_CL_PREP = rf"""{R_CTE},
{nested_cte('f', "tag IN ('050', '082', '084')").replace('fx_subfields', 'fx_class')},
{nested_cte('n', "tag = '060'").replace('fx_subfields', 'fx_class')},
nl AS (SELECT n.*, r.ruri || '#Work' AS W, '_:' || n.record_id || '-' || CAST(n.ord AS VARCHAR) || '-0-classification-1' AS CLN
       FROM n JOIN r ON r.record_id = n.record_id),
nx AS (SELECT record_id, CLN, unnest(sfs) AS x FROM nl),
a AS (SELECT f.*, generate_subscripts(list_filter(sfs, lambda s: s.code = 'a'), 1) - 1 AS p,
        unnest(list_filter(sfs, lambda s: s.code = 'a')) AS av FROM f),
k AS (SELECT a.*, r.ruri || '#Work' AS W,
        '_:' || a.record_id || '-' || CAST(a.ord AS VARCHAR) || '-' || CAST(av.sf_ord AS VARCHAR) || '-classification-1' AS CLN,
        CASE ind1 WHEN '0' THEN 'full' WHEN '1' THEN 'abridged' END AS ed
      FROM a JOIN r ON r.record_id = a.record_id
      WHERE tag <> '050' OR regexp_matches(coalesce(av.value, ''), '^([A-Z]{{1,3}}[0-9]|[A-Z]{{0,3}}\z)')),
x AS (SELECT record_id, tag, p, CLN, unnest(sfs) AS x, generate_subscripts(list_filter(sfs, lambda s: true), 1) AS i FROM k),
xb AS (SELECT record_id, tag, p, CLN, x, row_number() OVER (PARTITION BY record_id, CLN ORDER BY x.sf_ord) AS nb
       FROM x WHERE x.code = 'b')"""

_CL_SELS = [
    triple_select("k", "W", q(BF + "classification"), "CLN", "'bnode'"),
    triple_select("k", "CLN", q(TYPE), f"CASE WHEN tag = '050' THEN {q(BF + 'ClassificationLcc')} WHEN tag = '082' THEN "
                  f"{q(BF + 'ClassificationDdc')} ELSE {q(BF + 'Classification')} END", "'uri'"),
    triple_select("k", "CLN", q(BF + "classificationPortion"), "av.value"),
    triple_select("k", "CLN", q(BF + "source"), f"'{CL.ORGANIZATIONS}dlc'", "'uri'", "ind2 = '0' AND tag IN ('050', '082')"),
    triple_select("k", f"'{CL.ORGANIZATIONS}dlc'", q(TYPE), q(BF + "Source"), "'uri'", "ind2 = '0' AND tag IN ('050', '082')"),
    triple_select("x", "CLN", q(BF + "source"), "CLN || '-source-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'", "tag = '084' AND x.code = '2'"),
    triple_select("x", "CLN || '-source-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Source"), "'uri'", "tag = '084' AND x.code = '2'"),
    triple_select("x", "CLN || '-source-' || CAST(x.sf_ord AS VARCHAR)", q(LABEL), "x.value", "'literal'", "tag = '084' AND x.code = '2'"),
    triple_select("k", "CLN", q(BF + "adminMetadata"), "CLN || '-admin'", "'bnode'",
                  "tag = '084' AND len(list_filter(sfs, lambda s: s.code = 'q')) > 0"),
    triple_select("k", "CLN || '-admin'", q(TYPE), q(BF + "AdminMetadata"), "'uri'",
                  "tag = '084' AND len(list_filter(sfs, lambda s: s.code = 'q')) > 0"),
    triple_select("x", "CLN || '-admin'", q(BF + "assigner"), "CLN || '-assigner-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'",
                  "tag = '084' AND x.code = 'q'"),
    triple_select("x", "CLN || '-assigner-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Agent"), "'uri'", "tag = '084' AND x.code = 'q'"),
    triple_select("x", "CLN || '-assigner-' || CAST(x.sf_ord AS VARCHAR)", q(LABEL), "x.value", "'literal'", "tag = '084' AND x.code = 'q'"),
    triple_select("nl", "W", q(BF + "classification"), "CLN", "'bnode'"),
    triple_select("nl", "CLN", q(TYPE), q(BF + "ClassificationNlm"), "'uri'"),
    triple_select("nx", "CLN", q(BF + "classificationPortion"), "x.value", "'literal'", "x.code = 'a'"),
    triple_select("nx", "CLN", q(BF + "itemPortion"), "x.value", "'literal'", "x.code = 'b'"),
    triple_select("nl", "CLN", q(BF + "source"), "CLN || '-source'", "'bnode'", "ind2 = '0'"),
    triple_select("nl", "CLN || '-source'", q(TYPE), q(BF + "Source"), "'uri'", "ind2 = '0'"),
    triple_select("nl", "CLN || '-source'", q(LABEL), f"'{CL.NLM_SOURCE}'", "'literal'", "ind2 = '0'"),
    triple_select("xb", "CLN", q(BF + "itemPortion"), "x.value", "'literal'", "p = 0 AND (tag <> '050' OR nb = 1)"),
    triple_select("x", "CLN", q(BF + "edition"), "x.value", "'literal'", "tag = '082' AND x.code = '2'"),
    triple_select("k", "CLN", q(BF + "edition"), "ed", "'literal'", "tag = '082' AND ed IS NOT NULL"),
    triple_select("x", "CLN", q(BF + "source"), "CLN || '-source-' || CAST(x.sf_ord AS VARCHAR)", "'bnode'", "tag = '082' AND x.code = 'q'"),
    triple_select("x", "CLN || '-source-' || CAST(x.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Source"), "'uri'", "tag = '082' AND x.code = 'q'"),
    triple_select("x", "CLN || '-source-' || CAST(x.sf_ord AS VARCHAR)", q(LABEL), "x.value", "'literal'", "tag = '082' AND x.code = 'q'"),
]


@query("classification", f"WITH {_CL_PREP}\n" + finish("R13", _CL_SELS))
def classification(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return CL.classification(fx.nested("fx_class"), ruris(fx))


def _mark_sql(a: str, b: str) -> str:
    return _ns(f"CASE WHEN {b} IS NULL THEN {a} WHEN starts_with({b}, '.') THEN {a} || {b} ELSE concat_ws(' ', {a}, {b}) END")


_SI_PREP = rf"""{R_CTE},
{nested_cte('f', "tag IN ('050', '051')").replace('fx_subfields', 'fx_class')},
g AS (SELECT f.*, list_filter(sfs, lambda s: s.code = 'a')[1].value AS a1, list_filter(sfs, lambda s: s.code = 'b')[1].value AS b1,
        list_filter(sfs, lambda s: s.code = 'c')[1].value AS c1 FROM f),
i AS (SELECT g.record_id, g.ord, g.ind2, r.ruri || '#Instance' AS I, r.ruri || '#Item050-' || CAST(g.ord AS VARCHAR) AS ITEM,
        {_mark_sql('a1', 'b1')} AS mark, regexp_matches(coalesce(a1, ''), '^([A-Z]{{1,3}}[0-9]|[A-Z]{{0,3}}\z)') AS lcc
      FROM g JOIN r ON r.record_id = g.record_id WHERE g.tag = '050'),
m AS (SELECT i.record_id, i.ITEM, i.ITEM || '-shelfMark051-' || CAST(g.ord AS VARCHAR) AS S51,
        rtrim({_ns("concat_ws(' ', CASE WHEN starts_with(g.b1, '.') THEN g.a1 || g.b1 ELSE concat_ws(' ', g.a1, g.b1) END, g.c1)")}, '.:,;/ ') AS label
      FROM i JOIN g ON g.record_id = i.record_id AND g.tag = '051')"""

_SI_SELS = [
    triple_select("i", "I", q(BF + "hasItem"), "ITEM", "'uri'"),
    triple_select("i", "ITEM", q(TYPE), q(BF + "Item"), "'uri'"),
    triple_select("i", "ITEM", q(BF + "shelfMark"), "ITEM || '-shelfMark'", "'bnode'"),
    triple_select("i", "ITEM || '-shelfMark'", q(TYPE), f"CASE WHEN lcc THEN {q(BF + 'ShelfMarkLcc')} ELSE {q(BF + 'ShelfMark')} END", "'uri'"),
    triple_select("i", "ITEM || '-shelfMark'", q(LABEL), "mark"),
    triple_select("i", "ITEM", q(BF + "itemOf"), "I", "'uri'"),
    triple_select("i", "ITEM || '-shelfMark'", q(BF + "source"), f"'{CL.ORGANIZATIONS}dlc'", "'uri'", "ind2 = '0'"),
    triple_select("i", f"'{CL.ORGANIZATIONS}dlc'", q(TYPE), q(BF + "Source"), "'uri'", "ind2 = '0'"),
    triple_select("m", "ITEM", q(BF + "shelfMark"), "S51", "'bnode'"),
    triple_select("m", "S51", q(TYPE), q(BF + "ShelfMarkLcc"), "'uri'"),
    triple_select("m", "S51", q(LABEL), "label"),
]


@query("shelf_items", f"WITH {_SI_PREP}\n" + finish("R14", _SI_SELS))
def shelf_items(spark, sf_dir):
    """Items of 050 with their shelf marks, 051 copies as further shelf marks."""
    fx = Fixtures(spark, sf_dir)
    return CL.shelf_items(fx.nested("fx_class"), ruris(fx))


_GD_PREP = f"""{R_CTE},
{nested_cte('f', "tag = '086'").replace('fx_subfields', 'fx_notes')},
g AS (SELECT f.*, r.ruri || '#Instance' AS I, CASE ind1 WHEN '0' THEN 'sudocs' WHEN '1' THEN 'Government of Canada Publications' END AS src,
        unnest(list_filter(sfs, lambda s: s.code IN ('a', 'z'))) AS x FROM f JOIN r ON r.record_id = f.record_id),
k AS (SELECT g.*, '_:' || record_id || '-' || CAST(ord AS VARCHAR) || '-' || CAST(x.sf_ord AS VARCHAR) || '-govdoc-1' AS CLN FROM g),
y AS (SELECT record_id, CLN, unnest(list_filter(sfs, lambda s: s.code = '2')) AS y FROM k WHERE src IS NULL)"""

_GD_SELS = [
    triple_select("k", "I", q(BF + "classification"), "CLN", "'bnode'"),
    triple_select("k", "CLN", q(TYPE), q(BF + "Classification"), "'uri'"),
    triple_select("k", "CLN", q(LABEL), "x.value"),
    triple_select("k", "CLN", q(BF + "status"), "CLN || '-status'", "'bnode'", "x.code = 'z'"),
    triple_select("k", "CLN || '-status'", q(TYPE), q(BF + "Status"), "'uri'", "x.code = 'z'"),
    triple_select("k", "CLN || '-status'", q(LABEL), "'invalid'", "'literal'", "x.code = 'z'"),
    triple_select("k", "CLN", q(BF + "source"), "CLN || '-source'", "'bnode'", "src IS NOT NULL"),
    triple_select("k", "CLN || '-source'", q(TYPE), q(BF + "Source"), "'uri'", "src IS NOT NULL"),
    triple_select("k", "CLN || '-source'", q(LABEL), "src", "'literal'", "src IS NOT NULL"),
    triple_select("y", "CLN", q(BF + "source"), "CLN || '-source-' || CAST(y.sf_ord AS VARCHAR)", "'bnode'"),
    triple_select("y", "CLN || '-source-' || CAST(y.sf_ord AS VARCHAR)", q(TYPE), q(BF + "Source"), "'uri'"),
    triple_select("y", "CLN || '-source-' || CAST(y.sf_ord AS VARCHAR)", q(LABEL), "y.value"),
]


@query("government_documents", f"WITH {_GD_PREP}\n" + finish("R14", _GD_SELS))
def government_documents(spark, sf_dir):
    """086 government document numbers."""
    fx = Fixtures(spark, sf_dir)
    return CL.government_documents(fx.nested("fx_notes"), ruris(fx))
