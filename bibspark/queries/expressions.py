"""Queries for the column expressions X01-X28 (each over whole tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures, register_extra
from ..functions import text as X
from . import query


def sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# every line of every document (whole texts)
_LINES = """lines AS (SELECT doc_id, CAST(generate_subscripts(parts, 1) AS INT) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents) d)"""

# normalize-space in DuckDB
def _ns(e: str) -> str:
    return f"trim(regexp_replace({e}, '[ \\t\\r\\n]+', ' ', 'g'))"


def doc_lines(fx: Fixtures):
    d = fx.table("documents")
    return d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "line")) \
        .select("doc_id", (F.col("p") + 1).cast("int").alias("line_no"), "line")


register_extra("fx_dates", """
SELECT k, CASE k % 5 WHEN 0 THEN y || m || d || '1230-0500' WHEN 1 THEN y || m WHEN 2 THEN y
    WHEN 3 THEN y || '--' || d ELSE y || m || d || '0915' END AS s,
  CASE k % 3 WHEN 0 THEN 'c' ELSE 'd' END || y || CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN m WHEN 2 THEN m || d ELSE m || d || '07' END AS b045,
  substr('abcdefghijklmnopqrstuvwxy', CAST(k % 25 AS INT) + 1, 1) || CAST(k % 10 AS STRING)
    || substr('abcdefghijklmnopqrstuvwxy', CAST(CAST(floor(k / 7) AS BIGINT) % 25 AS INT) + 1, 1) || CAST(CAST(floor(k / 3) AS BIGINT) % 10 AS STRING) AS a045,
  substr('engfrespagerita', CAST(k % 4 AS INT) * 3 + 1, CAST(k % 9 AS INT) + 1) AS a041
FROM (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS STRING) AS y,
        lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS m, lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d
      FROM orders) t
""")

register_extra("fx_calls", """
SELECT p_partkey AS k, CASE p_partkey % 4
    WHEN 0 THEN upper(substr(p_name, 1, CAST(p_size % 5 AS INT))) || CAST(p_size AS STRING)
    WHEN 1 THEN upper(substr(p_name, 1, CAST(p_size % 4 AS INT)))
    WHEN 2 THEN p_brand
    ELSE upper(substr(p_type, 1, 3)) || '.' || CAST(p_size AS STRING) END AS s
FROM part
""")


@query("chop_punct", f"WITH {_LINES} SELECT doc_id, line_no, rtrim(line, '.:,;/ ') AS chopped FROM lines")
def chop_punct(spark, sf_dir):
    return doc_lines(Fixtures(spark, sf_dir)).select("doc_id", "line_no", X.chop_punct("line").alias("chopped"))


@query("chop_brackets", f"""WITH {_LINES}
SELECT doc_id, line_no, rtrim(ltrim(line, '['), '.:,;/ ]') AS chopped FROM lines
UNION ALL SELECT -n_nationkey, 0, rtrim(ltrim('[' || n_name || '] :', '['), '.:,;/ ]') FROM nation""")
def chop_brackets(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    lines = doc_lines(fx).select("doc_id", "line_no", X.chop_brackets("line").alias("chopped"))
    nat = fx.table("nation").select((-F.col("n_nationkey")).cast("bigint").alias("doc_id"), F.lit(0).alias("line_no"),
                                    X.chop_brackets(F.concat(F.lit("["), "n_name", F.lit("] :"))).alias("chopped"))
    return lines.unionByName(nat)


@query("chop_parens", f"""WITH {_LINES}
SELECT doc_id, line_no, rtrim(ltrim(line, '('), '.:,;/ )') AS chopped FROM lines
UNION ALL SELECT -n_nationkey, 0, rtrim(ltrim('(' || n_name || ').', '('), '.:,;/ )') FROM nation""")
def chop_parens(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    lines = doc_lines(fx).select("doc_id", "line_no", X.chop_parens("line").alias("chopped"))
    nat = fx.table("nation").select((-F.col("n_nationkey")).cast("bigint").alias("doc_id"), F.lit(0).alias("line_no"),
                                    X.chop_parens(F.concat(F.lit("("), "n_name", F.lit(")."))).alias("chopped"))
    return lines.unionByName(nat)


@query("date_unknown_digits", """
SELECT record_id, translate(substr(c008, 8, 8), 'uU', 'XX') AS dates FROM fx_records""")
def date_unknown_digits(spark, sf_dir):
    r = Fixtures(spark, sf_dir).fx_records
    return r.select("record_id", X.u2x(F.substring("c008", 8, 8)).alias("dates"))


@query("edtf_dates", """
WITH d AS (SELECT k, s, translate(substr(s, 1, 12), '-', 'X') || substr(s, 13) AS t FROM fx_dates)
SELECT k, s, CASE WHEN substr(t, 7, 2) <> '' THEN substr(t, 1, 4) || '-' || substr(t, 5, 2) || '-' || substr(t, 7, 2)
                  ELSE substr(t, 1, 4) || '-' || substr(t, 5, 2) END
  || CASE WHEN substr(t, 9, 4) <> '' THEN 'T' || substr(t, 9, 2) || ':' || substr(t, 11, 2) || ':00' ELSE '' END
  || CASE WHEN substr(t, 13, 5) <> '' THEN substr(t, 13, 3) || ':' || substr(t, 16, 2) ELSE '' END AS edtf
FROM d""")
def edtf_dates(spark, sf_dir):
    d = Fixtures(spark, sf_dir).fx_dates
    return d.select("k", "s", X.edtf_format("s").alias("edtf"))


def _url_sql(e: str) -> str:
    return (f"array_to_string(list_transform(string_split({e}, ''), lambda c: CASE WHEN instr({sql_lit(X.URL_SAFE)}, c) > 0 THEN c "
            f"WHEN ascii(c) BETWEEN 32 AND 126 THEN '%' || upper(hex(ascii(c))) ELSE '%3F' END), '')")


@query("url_encode", f"""WITH {_LINES}
SELECT 'page' AS src, page_id AS id, 0 AS line_no, {_url_sql('url')} AS enc FROM pages
UNION ALL SELECT 'part', p_partkey, 0, {_url_sql('p_name')} FROM part
UNION ALL SELECT 'doc', doc_id, line_no, {_url_sql('line')} FROM lines""")
def url_encode(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    pages = fx.table("pages").select(F.lit("page").alias("src"), F.col("page_id").alias("id"), F.lit(0).alias("line_no"),
                                     X.url_encode("url").alias("enc"))
    parts = fx.table("part").select(F.lit("part").alias("src"), F.col("p_partkey").alias("id"), F.lit(0).alias("line_no"),
                                    X.url_encode("p_name").alias("enc"))
    lines = doc_lines(fx).select(F.lit("doc").alias("src"), F.col("doc_id").alias("id"), "line_no",
                                 X.url_encode("line").alias("enc"))
    return pages.unionByName(parts).unionByName(lines)


@query("lcc_valid", r"""
SELECT k, s, regexp_matches(coalesce(s, ''), '^([A-Z]{1,3}[0-9]|[A-Z]{0,3}\z)') AS valid FROM fx_calls""")
def lcc_valid(spark, sf_dir):
    c = Fixtures(spark, sf_dir).fx_calls
    return c.select("k", "s", X.lcc_valid("s").alias("valid"))


_X08_SQL = """
WITH v AS (SELECT record_id, ord, sf_ord, value AS s FROM fx_subfields WHERE code IN ('0', 'w')
           UNION ALL SELECT 'p' || CAST(p_partkey AS VARCHAR), 0, 0, 'x(' || p_brand || ')' || p_name FROM part),
a AS (SELECT *, CASE WHEN instr(s, '(') > 0 THEN substr(s, instr(s, '(') + 1) ELSE '' END AS aft,
        CASE WHEN instr(s, ')') > 0 THEN substr(s, 1, instr(s, ')') - 1) ELSE '' END AS bef,
        CASE WHEN instr(s, ')') > 0 THEN substr(s, instr(s, ')') + 1) ELSE '' END AS aft2 FROM v),
b AS (SELECT record_id, ord, sf_ord, s, substr(aft, 1, greatest(length(bef) - 1, 0)) AS source, aft2 FROM a)
SELECT record_id, ord, sf_ord, source, CASE WHEN source <> '' THEN aft2 ELSE s END AS id_value,
       instr(CASE WHEN source <> '' THEN aft2 ELSE s END, '://') > 0 AS is_uri FROM b"""


@query("control_number_split", _X08_SQL)
def control_number_split(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    v = fx.fx_subfields.where(F.col("code").isin("0", "w")).select("record_id", "ord", "sf_ord", F.col("value").alias("s"))
    p = fx.table("part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("record_id"),
                                F.lit(0).alias("ord"), F.lit(0).alias("sf_ord"),
                                F.concat(F.lit("x("), "p_brand", F.lit(")"), "p_name").alias("s"))
    u = v.unionByName(p)
    val = X.control_number_value("s")
    return u.select("record_id", "ord", "sf_ord", X.control_number_source("s").alias("source"),
                    val.alias("id_value"), X.is_uri_value(val).alias("is_uri"))


@query("split_roles", f"""
WITH r AS (SELECT record_id, ord, sf_ord, value AS s, string_split(value, ',') AS parts FROM fx_subfields WHERE code = 'e'),
a AS (SELECT *, parts[len(parts)] AS last, string_split(parts[len(parts)], ' and') AS ands FROM r),
b AS (SELECT *, string_split(ands[len(ands)], '&') AS amps FROM a),
c AS (SELECT record_id, ord, sf_ord,
  list_concat(list_filter(list_transform(list_slice(parts, 1, len(parts) - 1), lambda x: {_ns('x')}), lambda x: x <> ''),
    CASE WHEN len(parts) = 1 OR length({_ns('last')}) > 0 THEN
      list_concat(list_filter(list_transform(list_slice(ands, 1, len(ands) - 1), lambda x: {_ns('x')}), lambda x: x <> ''),
                  list_filter(list_transform(list_slice(amps, 1, len(amps) - 1), lambda x: {_ns('x')}), lambda x: x <> ''),
                  [{_ns('amps[len(amps)]')}])
    ELSE [] END) AS roles FROM b)
SELECT record_id, ord, sf_ord, CAST(generate_subscripts(roles, 1) AS INT) AS role_no, unnest(roles) AS role FROM c""")
def split_roles(spark, sf_dir):
    s = Fixtures(spark, sf_dir).fx_subfields.where(F.col("code") == "e")
    return s.select("record_id", "ord", "sf_ord", F.posexplode(X.split_roles("value")).alias("p", "role")) \
        .select("record_id", "ord", "sf_ord", (F.col("p") + 1).cast("int").alias("role_no"), "role")


@query("split_languages", """
WITH c AS (SELECT k, a041, CAST(floor(length(a041) / 3) AS INT) AS n FROM fx_dates)
SELECT k, CAST(i + 1 AS INT) AS pos, substr(a041, 3 * i + 1, 3) AS lang FROM (SELECT k, a041, unnest(range(0, n)) AS i FROM c)""")
def split_languages(spark, sf_dir):
    d = Fixtures(spark, sf_dir).fx_dates
    return d.select("k", F.posexplode(X.split_languages("a041")).alias("p", "lang")) \
        .select("k", (F.col("p") + 1).cast("int").alias("pos"), "lang")


def _period_sql(pos: int) -> str:
    c1 = f"substr(a045, {pos}, 1)"
    two = f"substr(a045, {pos}, 2)"
    return (f"CASE WHEN {c1} IN ('a','b','c','d','e') THEN coalesce(tp2.v, '') "
            f"ELSE coalesce(tp1.v, '') || substr(a045, {pos + 1}, 1) || 'X' END")


def _periods_values() -> str:
    rows = ["('a0', '-XXXX/-3000')"]
    for letter, top in (("b", 29), ("c", 19), ("d", 9)):
        rows += [f"('{letter}{i}', '-{top - i:02d}XX')" for i in range(10)]
    rows += [f"('{chr(ord('e') + i)}', '{i:02d}')" for i in range(21)]
    return "VALUES " + ", ".join(rows)


@query("time_periods", f"""
WITH tp(code, v) AS ({_periods_values()}),
h AS (SELECT k, a045,
  CASE WHEN substr(a045, 1, 1) IN ('a','b','c','d','e') THEN coalesce((SELECT v FROM tp WHERE code = substr(a045, 1, 2)), '')
       ELSE coalesce((SELECT v FROM tp WHERE code = substr(a045, 1, 1)), '') || substr(a045, 2, 1) || 'X' END AS d1,
  CASE WHEN substr(a045, 3, 1) IN ('a','b','c','d','e') THEN coalesce((SELECT v FROM tp WHERE code = substr(a045, 3, 2)), '')
       ELSE coalesce((SELECT v FROM tp WHERE code = substr(a045, 3, 1)), '') || substr(a045, 4, 1) || 'X' END AS d2
  FROM fx_dates)
SELECT k, a045, CASE WHEN d1 = d2 THEN d1 ELSE d1 || '/' || d2 END AS period FROM h""")
def time_periods(spark, sf_dir):
    d = Fixtures(spark, sf_dir).fx_dates
    return d.select("k", "a045", X.time_period("a045").alias("period"))


@query("time_dates", """
WITH d AS (SELECT k, b045, CASE WHEN substr(b045, 1, 1) = 'c' THEN '-' || substr(b045, 2, 4) ELSE substr(b045, 2, 4) END AS y,
  substr(b045, 6, 2) AS mo, substr(b045, 8, 2) AS dd, substr(b045, 10, 2) AS hh FROM fx_dates)
SELECT k, b045, CASE WHEN hh <> '' THEN y || '-' || mo || '-' || dd || 'T' || hh WHEN dd <> '' THEN y || '-' || mo || '-' || dd
  WHEN mo <> '' THEN y || '-' || mo ELSE y END AS edtf FROM d""")
def time_dates(spark, sf_dir):
    d = Fixtures(spark, sf_dir).fx_dates
    return d.select("k", "b045", X.time_date("b045").alias("edtf"))


@query("change_date", """
SELECT record_id, substr(c005, 1, 4) || '-' || substr(c005, 5, 2) || '-' || substr(c005, 7, 2) || 'T' || substr(c005, 9, 2)
  || ':' || substr(c005, 11, 2) || ':' || substr(c005, 13, 2) AS change_date FROM fx_records""")
def change_date(spark, sf_dir):
    r = Fixtures(spark, sf_dir).fx_records
    return r.select("record_id", X.change_date("c005").alias("change_date"))


@query("creation_date", """
SELECT record_id, CASE WHEN TRY_CAST(substr(c008, 1, 2) AS DOUBLE) < 50 THEN '20' ELSE '19' END || substr(c008, 1, 2)
  || '-' || substr(c008, 3, 2) || '-' || substr(c008, 5, 2) AS creation_date FROM fx_records""")
def creation_date(spark, sf_dir):
    r = Fixtures(spark, sf_dir).fx_records
    return r.select("record_id", X.creation_date("c008").alias("creation_date"))


@query("provision_dates", """
WITH r AS (SELECT record_id, c008, substr(c008, 7, 1) AS t, substr(c008, 8, 4) AS d1, substr(c008, 12, 4) AS d2 FROM fx_records),
s AS (SELECT record_id, CASE
  WHEN t = 'c' THEN d1 || '/..'
  WHEN t IN ('d','i','k','m','q','u') OR (t = '|' AND d1 NOT IN ('    ','||||') AND d2 NOT IN ('    ','||||')) THEN d1 || '/' || d2
  WHEN t = 'e' THEN CASE WHEN substr(c008, 14, 2) = '  ' THEN d1 || '-' || substr(c008, 12, 2)
                         ELSE d1 || '-' || substr(c008, 12, 2) || '-' || substr(c008, 14, 2) END
  WHEN t IN ('p','r','s','t') OR (t = '|' AND d1 NOT IN ('    ','||||')) THEN d1 END AS p FROM r)
SELECT record_id, translate(p, 'uU', 'XX') AS provision_date FROM s""")
def provision_dates(spark, sf_dir):
    r = Fixtures(spark, sf_dir).fx_records
    return r.select("record_id", X.provision_date("c008").alias("provision_date"))


@query("pub_place", """
SELECT record_id, CASE WHEN substr(c008, 18, 1) = ' ' THEN substr(c008, 16, 2) ELSE substr(c008, 16, 3) END AS place
FROM fx_records""")
def pub_place(spark, sf_dir):
    r = Fixtures(spark, sf_dir).fx_records
    return r.select("record_id", X.pub_place("c008").alias("place"))


@query("issue_range", """
WITH r AS (SELECT record_id, substr(c008, 8, 4) || CASE WHEN k % 3 = 0 THEN '' ELSE '-' || substr(c008, 12, 4) END AS s FROM fx_records)
SELECT record_id, s, CASE WHEN instr(s, '-') > 0 THEN substr(s, 1, instr(s, '-') - 1) ELSE s END AS first_issue,
  CASE WHEN instr(s, '-') > 0 THEN substr(s, instr(s, '-') + 1) ELSE '' END AS last_issue FROM r""")
def issue_range(spark, sf_dir):
    r = Fixtures(spark, sf_dir).fx_records
    s = F.concat(F.substring("c008", 8, 4),
                 F.when(F.col("k") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("-"), F.substring("c008", 12, 4))))
    r = r.select("record_id", s.alias("s"))
    return r.select("record_id", "s", X.issue_first("s").alias("first_issue"), X.issue_last("s").alias("last_issue"))


def _naco_sql(e: str) -> str:
    src, dst = X.naco_translate_args()
    c = f"translate({e}, {sql_lit(src)}, {sql_lit(dst)})"
    for a, b in X.NACO_MULTI:
        c = f"replace({c}, {sql_lit(a)}, {sql_lit(b)})"
    return _ns(f"translate({c}, {sql_lit(X.NACO_UPPER)}, {sql_lit(X.NACO_LOWER)})")


@query("naco_key", f"""WITH {_LINES}
SELECT 'doc' AS src, doc_id AS id, line_no, {_naco_sql('line')} AS naco FROM lines
UNION ALL SELECT 'cust', c_custkey, 0, {_naco_sql('c_name')} FROM customer
UNION ALL SELECT 'part', p_partkey, 0, {_naco_sql('p_name')} FROM part""")
def naco_key(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    lines = doc_lines(fx).select(F.lit("doc").alias("src"), F.col("doc_id").alias("id"), "line_no",
                                 X.naco_key("line").alias("naco"))
    cust = fx.table("customer").select(F.lit("cust").alias("src"), F.col("c_custkey").alias("id"),
                                       F.lit(0).alias("line_no"), X.naco_key("c_name").alias("naco"))
    part = fx.table("part").select(F.lit("part").alias("src"), F.col("p_partkey").alias("id"),
                                   F.lit(0).alias("line_no"), X.naco_key("p_name").alias("naco"))
    return lines.unionByName(cust).unionByName(part)


@query("log_keys", """
SELECT event_id, list_filter(string_split(line, '^'), lambda x: regexp_matches(x, '^(IQ|NQ)'))[1] AS data_code FROM fx_log""")
def log_keys(spark, sf_dir):
    lg = Fixtures(spark, sf_dir).fx_log
    return lg.select("event_id", X.log_data_code("line").alias("data_code"))
