"""Queries for joins, windows and grouping."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixture_more  # noqa: F401  (registers fx_more / fx_all)
from ..fixtures import Fixtures
from ..functions import text as X
from ..operators import decode as D
from ..operators import windows as W
from ..plans import common as C
from ..session import many_parts
from . import query
from .expressions import _ns, _url_sql
from .rules import R_CTE, nested_cte


def _all(spark, sf_dir):
    return Fixtures(spark, sf_dir).fx_all


def _nested(spark, sf_dir, parts=None):
    return Fixtures(spark, sf_dir).nested("fx_all", parts=parts)


def _label_sql(codes: str, src: str = "fx_all", where: str = "TRUE") -> str:
    cs = ",".join(f"'{c}'" for c in codes)
    return f"""SELECT record_id, ord, {_ns("string_agg(value, ' ' ORDER BY sf_ord)")} AS lbl
  FROM {src} WHERE code IN ({cs}) AND {where} GROUP BY record_id, ord"""


@query("series_match", f"""
WITH s AS (SELECT * FROM fx_all WHERE tag = '490'),
f AS (SELECT record_id, ord, sum(CASE WHEN code = 'a' THEN 1 ELSE 0 END) AS n_a, bool_or(instr(value, '=') > 0) AS has_eq
      FROM s GROUP BY record_id, ord),
w AS (SELECT *, n_a > 1 AND has_eq AS parallel,
        CASE WHEN n_a > 1 AND has_eq THEN 1 WHEN n_a > 1 THEN n_a WHEN n_a = 1 THEN 1 ELSE 0 END AS wt FROM f),
c AS (SELECT *, coalesce(sum(wt) OVER (PARTITION BY record_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS cur FROM w),
a AS (SELECT s.record_id, s.ord, s.sf_ord, s.value, row_number() OVER (PARTITION BY s.record_id, s.ord ORDER BY s.sf_ord) - 1 AS p
      FROM s WHERE code = 'a'),
nv AS (SELECT a.record_id, a.ord, a.sf_ord, arg_min(v.value, v.sf_ord) AS next_v
       FROM a LEFT JOIN s v ON v.record_id = a.record_id AND v.ord = a.ord AND v.code = 'v' AND v.sf_ord > a.sf_ord
       GROUP BY a.record_id, a.ord, a.sf_ord),
lab AS ({_label_sql('av', 's')}),
l AS (SELECT a.record_id, CAST(c.cur + a.p AS INT) AS rank, a.ord AS ord_490, a.sf_ord AS sf_ord_a,
        CASE WHEN c.parallel THEN lab.lbl ELSE {_ns("concat_ws(' ', a.value, nv.next_v)")} END AS statement, nv.next_v AS v490
      FROM a JOIN c USING (record_id, ord) JOIN nv USING (record_id, ord, sf_ord) LEFT JOIN lab USING (record_id, ord)
      WHERE NOT (c.parallel AND a.p > 0)),
e AS (SELECT record_id, ord, min(CASE WHEN code = 'v' THEN sf_ord END) AS vs FROM fx_all WHERE tag IN ('800','810','811','830') GROUP BY record_id, ord),
e8 AS (SELECT e.record_id, CAST(row_number() OVER (PARTITION BY e.record_id ORDER BY e.ord) AS INT) AS rank, e.ord AS ord_8xx,
         x.value AS v8xx FROM e LEFT JOIN fx_all x ON x.record_id = e.record_id AND x.ord = e.ord AND x.sf_ord = e.vs)
SELECT coalesce(l.record_id, e8.record_id) AS record_id, coalesce(l.rank, e8.rank) AS rank, ord_490, sf_ord_a, statement,
  coalesce(v8xx, v490) AS enumeration, ord_8xx
FROM l FULL OUTER JOIN e8 ON l.record_id = e8.record_id AND l.rank = e8.rank""")
def series_match(spark, sf_dir):
    return W.series_match(_all(spark, sf_dir))


@query("series_count", """
WITH f AS (SELECT record_id, ord, sum(CASE WHEN code = 'a' THEN 1 ELSE 0 END) AS n_a, bool_or(instr(value, '=') > 0) AS has_eq
      FROM fx_all WHERE tag = '490' GROUP BY record_id, ord),
g AS (SELECT record_id, CAST(count(*) FILTER (WHERE n_a > 1 AND has_eq) AS BIGINT) AS n_parallel,
        CAST(sum(CASE WHEN n_a > 1 AND NOT has_eq THEN n_a ELSE 0 END) AS BIGINT) AS n_multi_a,
        CAST(count(*) FILTER (WHERE n_a = 1) AS BIGINT) AS n_single FROM f GROUP BY record_id)
SELECT *, n_parallel + n_multi_a + n_single AS count490 FROM g""")
def series_count(spark, sf_dir):
    return W.series_count(_all(spark, sf_dir))


@query("work_title_anti", f"""
WITH r AS MATERIALIZED (SELECT record_id, ord, tag, code, sf_ord, value FROM fx_all WHERE tag IN ('130', '240', '245')),
t AS ({_label_sql('abfgknps', 'r', "tag = '245'")}),
u AS (SELECT DISTINCT record_id FROM r WHERE tag <> '245')
SELECT t.record_id, ord, lbl AS title FROM t LEFT JOIN u ON u.record_id = t.record_id WHERE u.record_id IS NULL""")
def work_title_anti(spark, sf_dir):
    return W.work_title_anti(_all(spark, sf_dir))


def _mark_sql(tag: str) -> str:
    first = ", ".join(f"arg_min(CASE WHEN code = '{c}' THEN value END, CASE WHEN code = '{c}' THEN sf_ord END) AS {c}" for c in "abc")
    return f"SELECT record_id, ord, {first} FROM fx_class WHERE tag = '{tag}' GROUP BY record_id, ord"


def _shelf_sql(a: str, b: str) -> str:
    return f"CASE WHEN {b} IS NULL OR {b} = '' THEN {a} WHEN starts_with({b}, '.') THEN {a} || {b} ELSE {a} || ' ' || {b} END"


@query("shelfmarks", rf"""
WITH m0 AS ({_mark_sql('050')}), m1 AS ({_mark_sql('051')}),
i AS (SELECT record_id, ord AS ord_050, trim(regexp_replace({_shelf_sql('a', 'b')}, '\s+', ' ', 'g')) AS mark_050,
  CASE WHEN regexp_matches(coalesce(a, ''), '^([A-Z]{{1,3}}[0-9]|[A-Z]{{0,3}}\z)') THEN 'ShelfMarkLcc' ELSE 'ShelfMark' END AS class_050 FROM m0),
j AS (SELECT record_id, ord AS ord_051, rtrim(trim(regexp_replace(concat_ws(' ', {_shelf_sql('a', 'b')}, c), '\s+', ' ', 'g')), '.:,;/ ') AS mark_051 FROM m1)
SELECT i.record_id, ord_050, mark_050, class_050, ord_051, mark_051 FROM i LEFT JOIN j USING (record_id)""")
def shelfmarks(spark, sf_dir):
    return W.shelfmarks(Fixtures(spark, sf_dir).fx_class)


@query("translation_language", f"""
WITH u AS (SELECT record_id, ord, value AS l FROM fx_all WHERE tag IN ('130', '240') AND code = 'l'),
h AS (SELECT record_id, min(value) AS h FROM fx_all WHERE tag = '041' AND ind1 = '1' AND code = 'h' GROUP BY record_id HAVING count(*) = 1)
SELECT record_id, ord, rtrim(l, '.:,;/ ') AS part,
  CASE WHEN h IS NOT NULL THEN '{X.LANGUAGES}' || h END AS original_language FROM u LEFT JOIN h USING (record_id)""")
def translation_language(spark, sf_dir):
    return W.translation_language(_all(spark, sf_dir))


@query("next_field_holding", """
WITH f AS (SELECT record_id, ord, tag, ind1, min(CASE WHEN code = '6' THEN value END) AS sf6
           FROM fx_all GROUP BY record_id, ord, tag, ind1),
n AS (SELECT *, lead(ord) OVER w AS n_ord, lead(tag) OVER w AS n_tag, lead(ind1) OVER w AS n_ind1, lead(sf6) OVER w AS n_sf6
      FROM f WINDOW w AS (PARTITION BY record_id ORDER BY ord))
SELECT record_id, ord, tag,
  CASE WHEN (n_tag = '535' OR (n_tag = '880' AND starts_with(n_sf6, '535')))
        AND n_ind1 = CASE WHEN tag = '533' THEN '2' ELSE '1' END THEN n_ord END AS holding_ord
FROM n WHERE tag IN ('533', '534')""")
def next_field_holding(spark, sf_dir):
    return W.next_field_holding(W.field_heads(_all(spark, sf_dir)))


@query("rda_pairs", """
WITH s AS (SELECT *, lag(code) OVER w AS p_code, lag(value) OVER w AS p_value, lead(code) OVER w AS n_code,
             lead(value) OVER w AS n_value FROM fx_all WHERE tag IN ('336', '337', '338')
           WINDOW w AS (PARTITION BY record_id, ord ORDER BY sf_ord)),
t AS (SELECT *, CASE tag WHEN '336' THEN 'http://id.loc.gov/vocabulary/contentTypes/'
        WHEN '337' THEN 'http://id.loc.gov/vocabulary/mediaTypes/' ELSE 'http://id.loc.gov/vocabulary/carriers/' END AS stem FROM s)
SELECT record_id, ord, tag, sf_ord, stem || value AS uri, CASE WHEN p_code = 'a' THEN p_value END AS label,
  CASE WHEN n_code = '0' THEN n_value END AS id0 FROM t WHERE code = 'b'
UNION ALL
SELECT record_id, ord, tag, sf_ord, NULL, value, CASE WHEN n_code = '0' THEN n_value END FROM t WHERE code = 'a' AND n_code <> 'b'""")
def rda_pairs(spark, sf_dir):
    return W.rda_pairs(_all(spark, sf_dir))


@query("following_code", """
WITH s AS (SELECT *, lead(code) OVER w AS n_code, lead(value) OVER w AS n_value FROM fx_all WHERE tag = '033'
           WINDOW w AS (PARTITION BY record_id, ord ORDER BY sf_ord))
SELECT record_id, ord, sf_ord, value AS b, CASE WHEN n_code = 'c' THEN n_value END AS c FROM s WHERE code = 'b'""")
def following_code(spark, sf_dir):
    return W.following_code(_all(spark, sf_dir))


@query("before_after_t", """
WITH s AS (SELECT *, min(CASE WHEN code = 't' THEN sf_ord END) OVER (PARTITION BY record_id, ord) AS t_pos
           FROM fx_all WHERE tag IN ('600', '700'))
SELECT record_id, ord, sf_ord, code, CASE WHEN sf_ord < t_pos THEN 'before' ELSE 'after' END AS side FROM s WHERE t_pos IS NOT NULL""")
def before_after_t(spark, sf_dir):
    return W.before_after_t(_all(spark, sf_dir))


def _thesaurus_values() -> str:
    rows = []
    for ind2, code, schemes in W.THESAURUS:
        for s in schemes or [None]:
            rows.append(f"('{ind2}', '{code}', {repr(s) if s else 'NULL'})")
    return "VALUES " + ", ".join(rows)


@query("subject_schemes", f"""
WITH th(ind2, source, scheme) AS ({_thesaurus_values()}),
f AS (SELECT DISTINCT record_id, ord, tag, ind2 FROM fx_all WHERE tag IN ('600','610','611','630','648','650','651','655'))
SELECT record_id, ord, tag, f.ind2, th.source, th.scheme FROM f LEFT JOIN th ON th.ind2 = f.ind2""")
def subject_schemes(spark, sf_dir):
    return W.subject_schemes(_nested(spark, sf_dir), spark)


@query("borrowed_title", f"""
WITH l245 AS ({_label_sql('abfgknps', 'fx_all', "tag = '245'")}),
l130 AS ({_label_sql('adfgklmnoprs', 'fx_all', "tag = '130'")}),
l240 AS ({_label_sql('adfgklmnoprs', 'fx_all', "tag = '240'")}),
t245 AS (SELECT record_id, arg_min(lbl, ord) AS t FROM l245 GROUP BY record_id),
t130 AS (SELECT record_id, arg_min(lbl, ord) AS t FROM l130 GROUP BY record_id),
t240 AS (SELECT record_id, arg_min(lbl, ord) AS t FROM l240 GROUP BY record_id),
c AS (SELECT DISTINCT record_id, ord, tag FROM fx_all WHERE tag IN ('530', '533', '534', '856'))
SELECT c.record_id, c.ord, c.tag, t245.t AS instance_title, coalesce(t130.t, t240.t, t245.t) AS work_title
FROM c LEFT JOIN t245 USING (record_id) LEFT JOIN t130 USING (record_id) LEFT JOIN t240 USING (record_id)""")
def borrowed_title(spark, sf_dir):
    return W.borrowed_title(_nested(spark, sf_dir))


@query("rda_media_anti", """
WITH r AS (SELECT record_id, substr(c007, 1, 1) AS category FROM fx_records WHERE c007 IS NOT NULL)
SELECT record_id, 'media' AS prop, category FROM r WHERE record_id NOT IN (SELECT record_id FROM fx_all WHERE tag = '337')
UNION ALL
SELECT record_id, 'carrier', category FROM r WHERE record_id NOT IN (SELECT record_id FROM fx_all WHERE tag = '338')""")
def rda_media_anti(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return W.rda_media_anti(fx.fx_records, fx.fx_all)


@query("extra_identifiers", """
WITH s AS (SELECT *, starts_with(value, '(uri)') OR starts_with(value, 'http') AS q FROM fx_all
           WHERE tag IN ('600', '700') AND code IN ('0', 'w')),
r AS (SELECT *, row_number() OVER (PARTITION BY record_id, ord, q ORDER BY sf_ord) AS rn FROM s),
a AS (SELECT *, CASE WHEN instr(value, '(') > 0 THEN substr(value, instr(value, '(') + 1) ELSE '' END AS aft,
        CASE WHEN instr(value, ')') > 0 THEN substr(value, 1, instr(value, ')') - 1) ELSE '' END AS bef,
        CASE WHEN instr(value, ')') > 0 THEN substr(value, instr(value, ')') + 1) ELSE '' END AS aft2 FROM r WHERE NOT q OR rn > 1),
b AS (SELECT *, substr(aft, 1, greatest(length(bef) - 1, 0)) AS source FROM a)
SELECT record_id, ord, sf_ord, source, CASE WHEN source <> '' THEN aft2 ELSE value END AS id_value FROM b""")
def extra_identifiers(spark, sf_dir):
    return W.extra_identifiers(_all(spark, sf_dir))


@query("music_medium_counts", """
WITH s AS (SELECT *, code IN ('a','b','d','p','r','s','t') AS bnd FROM fx_all WHERE tag = '382'),
w AS (SELECT *,
  last_value(CASE WHEN bnd THEN code END IGNORE NULLS) OVER (PARTITION BY record_id, ord ORDER BY sf_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb_code,
  last_value(CASE WHEN bnd THEN sf_ord END IGNORE NULLS) OVER (PARTITION BY record_id, ord ORDER BY sf_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb_sf,
  last_value(CASE WHEN bnd THEN value END IGNORE NULLS) OVER (PARTITION BY record_id, ord ORDER BY sf_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb_value,
  first_value(CASE WHEN bnd THEN sf_ord END IGNORE NULLS) OVER (PARTITION BY record_id, ord ORDER BY sf_ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nb
  FROM s)
SELECT record_id, ord, pb_sf AS medium_sf, pb_value AS medium, value AS count FROM w
WHERE code IN ('n', 'e') AND pb_code IN ('a', 'b', 'd', 'p') AND nb IS NOT NULL""")
def music_medium_counts(spark, sf_dir):
    return W.music_medium_counts(_all(spark, sf_dir))


@query("class_items", r"""
WITH a AS (SELECT record_id, ord, tag, sf_ord, value, row_number() OVER (PARTITION BY record_id, ord ORDER BY sf_ord) AS p
           FROM fx_all WHERE tag IN ('050', '060', '082', '084') AND code = 'a'),
b AS (SELECT record_id, ord, arg_min(value, sf_ord) AS b1 FROM fx_all WHERE tag IN ('050', '060', '082', '084') AND code = 'b'
      GROUP BY record_id, ord)
SELECT a.record_id, a.ord, a.tag, a.value AS class_portion, CASE WHEN p = 1 THEN b.b1 END AS item_portion,
  regexp_matches(coalesce(a.value, ''), '^([A-Z]{1,3}[0-9]|[A-Z]{0,3}\z)') OR a.tag <> '050' AS valid
FROM a LEFT JOIN b USING (record_id, ord)""")
def class_items(spark, sf_dir):
    return W.class_items(_all(spark, sf_dir))


@query("item_grouping", f"""
WITH {R_CTE},
f AS (SELECT record_id, ord, tag, bool_or(code IN ('3', '5')) AS own FROM fx_all WHERE tag IN ('541','561','563','583')
      GROUP BY record_id, ord, tag),
g AS (SELECT *, first_value(tag) OVER w AS f_tag, first_value(ord) OVER w AS f_ord FROM f
      WINDOW w AS (PARTITION BY record_id, own ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT record_id, ord, tag, own AS own_item,
  ruri || '#Item' || CASE WHEN own THEN tag ELSE f_tag END || '-' || CAST(CASE WHEN own THEN ord ELSE f_ord END AS VARCHAR) AS item_uri
FROM g JOIN r USING (record_id)""")
def item_grouping(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return W.item_grouping(fx.nested("fx_all"), C.record_uris(fx.fx_records))


@query("subject_label", """
SELECT record_id, ord, rtrim(string_agg(value || '--', '' ORDER BY sf_ord), '- ') AS label FROM fx_all
WHERE (tag = '650' AND code IN ('a','b','c','d','v','x','y','z')) OR (tag = '651' AND code IN ('a','b','v','x','y','z'))
  OR (tag = '648' AND code IN ('a','v','x','y','z')) OR (tag = '655' AND ind1 = ' ' AND code IN ('a','v','x','y','z'))
GROUP BY record_id, ord""")
def subject_label(spark, sf_dir):
    return W.subject_label(_all(spark, sf_dir))


@query("holding_address", """
SELECT record_id, ord, rtrim(string_agg(value || ', ', '' ORDER BY sf_ord), '.:,;/ ') AS address FROM fx_more
WHERE tag IN ('850', '852') AND code IN ('e', 'n') GROUP BY record_id, ord""")
def holding_address(spark, sf_dir):
    return W.holding_address(Fixtures(spark, sf_dir).fx_more)


@query("tag_ordinal", """
SELECT record_id, ord, tag, CAST(row_number() OVER (PARTITION BY record_id ORDER BY ord) AS INT) AS position
FROM (SELECT DISTINCT record_id, ord, tag FROM fx_all) f""")
def tag_ordinal(spark, sf_dir):
    return W.tag_ordinal(W.places(_all(spark, sf_dir)))


@query("effective_tag", """
SELECT record_id, ord, sf_ord, tag,
  CASE WHEN tag = '880' THEN substr(max(CASE WHEN code = '6' THEN value END) OVER (PARTITION BY record_id, ord), 1, 3) ELSE tag END AS eff_tag
FROM fx_all""")
def effective_tag(spark, sf_dir):
    return D.effective_tag(_all(spark, sf_dir)).select("record_id", "ord", "sf_ord", "tag", "eff_tag")


@query("field_label", f"""
SELECT record_id, ord, tag, {_ns("string_agg(value, ' ' ORDER BY sf_ord)")} AS label FROM fx_all GROUP BY record_id, ord, tag""")
def field_label(spark, sf_dir):
    f = _nested(spark, sf_dir, many_parts(spark))
    return f.select("record_id", "ord", "tag",
                    X.normalize_space(F.array_join(F.transform("sfs", lambda s: s["value"]), " ")).alias("label"))


@query("marc_key", """
SELECT record_id, ord, tag || ind1 || ind2 || string_agg('$' || code || value, '' ORDER BY sf_ord) AS marc_key
FROM fx_all GROUP BY record_id, ord, tag, ind1, ind2""")
def marc_key(spark, sf_dir):
    f = _nested(spark, sf_dir, many_parts(spark))
    return f.select("record_id", "ord", C.marc_key(F.col("tag"), F.col("ind1"), F.col("ind2"), F.col("sfs")).alias("marc_key"))


@query("record_header", """
WITH f AS (SELECT record_id, 1 AS ord, 'LDR' AS tag, leader AS value FROM fx_records
  UNION ALL SELECT record_id, 2, '001', c001 FROM fx_records UNION ALL SELECT record_id, 3, '003', c003 FROM fx_records
  UNION ALL SELECT record_id, 4, '005', c005 FROM fx_records UNION ALL SELECT record_id, 5, '007', c007 FROM fx_records
  UNION ALL SELECT record_id, 6, '008', c008 FROM fx_records)
SELECT record_id, max(CASE WHEN tag = 'LDR' THEN value END) AS leader, max(CASE WHEN tag = '001' THEN value END) AS c001,
  max(CASE WHEN tag = '003' THEN value END) AS c003, max(CASE WHEN tag = '005' THEN value END) AS c005,
  max(CASE WHEN tag = '008' THEN value END) AS c008,
  coalesce(list(value ORDER BY ord) FILTER (WHERE tag = '006'), []) AS c006,
  coalesce(list(value ORDER BY ord) FILTER (WHERE tag = '007'), []) AS c007
FROM f GROUP BY record_id""")
def record_header(spark, sf_dir):
    r = Fixtures(spark, sf_dir).fx_records
    ctl = (r.select("record_id", F.lit(1).alias("ord"), F.lit("LDR").alias("tag"), F.col("leader").alias("value"))
           .unionByName(r.select("record_id", F.lit(2).alias("ord"), F.lit("001").alias("tag"), F.col("c001").alias("value")))
           .unionByName(r.select("record_id", F.lit(3).alias("ord"), F.lit("003").alias("tag"), F.col("c003").alias("value")))
           .unionByName(r.select("record_id", F.lit(4).alias("ord"), F.lit("005").alias("tag"), F.col("c005").alias("value")))
           .unionByName(r.select("record_id", F.lit(5).alias("ord"), F.lit("007").alias("tag"), F.col("c007").alias("value")))
           .unionByName(r.select("record_id", F.lit(6).alias("ord"), F.lit("008").alias("tag"), F.col("c008").alias("value"))))
    return D.record_header(ctl)
