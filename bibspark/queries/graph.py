"""Queries for record-level rules (R01-R03) and graph jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures, register_extra
from ..functions import text as X
from ..functions import vocab as V
from ..plans import common as C
from ..plans import graph as G
from ..plans import record as REC
from . import query
from .rules import R_CTE, finish, q, triple_select

BF, BFLC, RDF, RDFS = X.BF, X.BFLC, X.RDF, X.RDFS
TYPE, LABEL, VALUE = RDF + "type", RDFS + "label", RDF + "value"


def _bn(rule: str, ord_: str = "0") -> str:
    return f"'_:' || record_id || '-{ord_}-0-{rule}-1'"


_H = f"""{R_CTE},
h AS (SELECT x.*, r.ruri, r.ruri || '#Work' AS W, r.ruri || '#Instance' AS I, {_bn('admin')} AS A
      FROM fx_records x JOIN r USING (record_id))"""

_FRAME_SELECTS = [
    triple_select("h", "W", q(TYPE), q(BF + "Work"), "'uri'"),
    triple_select("h", "W", q(BF + "adminMetadata"), "A", "'bnode'"),
    triple_select("h", "A", q(TYPE), q(BF + "AdminMetadata"), "'uri'"),
    triple_select("h", "A", q(BF + "generationProcess"), _bn("generation"), "'bnode'"),
    triple_select("h", _bn("generation"), q(TYPE), q(BF + "GenerationProcess"), "'uri'"),
    triple_select("h", _bn("generation"), q(LABEL), q(V.GENERATION_LABEL)),
    triple_select("h", "W", q(BF + "hasInstance"), "I", "'uri'"),
    triple_select("h", "I", q(TYPE), q(BF + "Instance"), "'uri'"),
    triple_select("h", "I", q(BF + "instanceOf"), "W", "'uri'"),
]


def _vals(rows, cols):
    return V.values_sql(rows, cols)


_LEADER_CTE = f"""{_H},
l AS (SELECT h.*, st.status, en.enc, cv.conv, wt.wtype, it.itype, iss.iss FROM h
  LEFT JOIN {_vals(V.LEADER_STATUS, 'k, status').replace(' AS v(', ' AS st(')} ON st.k = substr(h.leader, 6, 1)
  LEFT JOIN {_vals(V.LEADER_ENCODING, 'k, enc').replace(' AS v(', ' AS en(')} ON en.k = substr(h.leader, 18, 1)
  LEFT JOIN {_vals(V.LEADER_CONVENTIONS, 'k, conv').replace(' AS v(', ' AS cv(')} ON cv.k = substr(h.leader, 19, 1)
  LEFT JOIN {_vals(V.LEADER_WORK_TYPE, 'k, wtype').replace(' AS v(', ' AS wt(')} ON wt.k = substr(h.leader, 7, 1)
  LEFT JOIN {_vals(V.LEADER_INSTANCE_TYPE, 'k, itype').replace(' AS v(', ' AS it(')} ON it.k = substr(h.leader, 7, 1)
  LEFT JOIN {_vals(V.LEADER_ISSUANCE, 'k, iss').replace(' AS v(', ' AS iss(')} ON iss.k = substr(h.leader, 8, 1))"""

_LEADER_SELECTS = [
    triple_select("l", "A", q(BF + "status"), _bn("status"), "'bnode'", "status IS NOT NULL"),
    triple_select("l", _bn("status"), q(TYPE), q(BF + "Status"), "'uri'", "status IS NOT NULL"),
    triple_select("l", _bn("status"), q(BF + "code"), "status", "'literal'", "status IS NOT NULL"),
    triple_select("l", "A", q(BFLC + "encodingLevel"), _bn("encodingLevel"), "'bnode'"),
    triple_select("l", _bn("encodingLevel"), q(TYPE), q(BFLC + "EncodingLevel"), "'uri'"),
    triple_select("l", _bn("encodingLevel"), q(BF + "code"), f"coalesce(enc, '{V.LEADER_ENCODING_DEFAULT}')"),
    triple_select("l", "A", q(BF + "descriptionConventions"), _bn("descriptionConventions"), "'bnode'"),
    triple_select("l", _bn("descriptionConventions"), q(TYPE), q(BF + "DescriptionConventions"), "'uri'"),
    triple_select("l", _bn("descriptionConventions"), q(BF + "code"), f"coalesce(conv, '{V.LEADER_CONVENTIONS_DEFAULT}')"),
    triple_select("l", "W", q(TYPE), f"'{BF}' || wtype", "'uri'", "wtype IS NOT NULL"),
    triple_select("l", "I", q(TYPE), f"'{BF}' || itype", "'uri'", "itype IS NOT NULL"),
    triple_select("l", "I", q(TYPE), q(BF + "Collection"), "'uri'", "substr(leader, 8, 1) IN ('c', 'd')"),
    triple_select("l", "I", q(BF + "issuance"), f"'{V.ISSUANCE_STEM}' || iss", "'uri'", "iss IS NOT NULL"),
    triple_select("l", f"'{V.ISSUANCE_STEM}' || iss", q(TYPE), q(BF + "Issuance"), "'uri'", "iss IS NOT NULL"),
    triple_select("l", "I", q(TYPE), q(BF + "Archival"), "'uri'", "substr(leader, 9, 1) = 'a'"),
]

_ADMIN_SELECTS = [
    triple_select("h", "A", q(BF + "identifiedBy"), _bn("local", "2"), "'bnode'", "c001 IS NOT NULL"),
    triple_select("h", _bn("local", "2"), q(TYPE), q(BF + "Local"), "'uri'", "c001 IS NOT NULL"),
    triple_select("h", _bn("local", "2"), q(VALUE), "c001", "'literal'", "c001 IS NOT NULL"),
    triple_select("h", "A", q(BF + "source"), _bn("source", "3"), "'bnode'", "c003 IS NOT NULL"),
    triple_select("h", _bn("source", "3"), q(TYPE), q(BF + "Source"), "'uri'", "c003 IS NOT NULL"),
    triple_select("h", _bn("source", "3"), q(BF + "code"), "c003", "'literal'", "c003 IS NOT NULL"),
    triple_select("h", "A", q(BF + "changeDate"),
                  "substr(c005, 1, 4) || '-' || substr(c005, 5, 2) || '-' || substr(c005, 7, 2) || 'T' || substr(c005, 9, 2)"
                  " || ':' || substr(c005, 11, 2) || ':' || substr(c005, 13, 2)", "'literal'", "c005 IS NOT NULL",
                  datatype=q(X.XS + "dateTime")),
]


def _headers(spark, sf_dir):
    return REC.headers_with_uri(Fixtures(spark, sf_dir).fx_records)


@query("leader_types", f"WITH {_LEADER_CTE}\n" + finish("R02", _LEADER_SELECTS))
def leader_types(spark, sf_dir):
    return REC.leader_types(spark, _headers(spark, sf_dir))


@query("admin_metadata", f"WITH {_H}\n" + finish("R03", _ADMIN_SELECTS))
def admin_metadata(spark, sf_dir):
    return REC.admin_control(_headers(spark, sf_dir))


@query("record_frame", f"WITH {_H}\n" + finish("R01", _FRAME_SELECTS))
def record_frame(spark, sf_dir):
    return REC.record_frame(_headers(spark, sf_dir))


# ---- graph jobs on fx_triples -------------------------------------------------

@query("entities_of_type", """
SELECT DISTINCT v, obj AS cls, CASE WHEN kind = 'bnode' THEN '' ELSE subj END AS uri FROM fx_triples
WHERE pred = 'rdf:type' AND obj IN ('bf:Work', 'bf:Instance') AND kind <> 'bnode'""")
def entities_of_type(spark, sf_dir):
    t = Fixtures(spark, sf_dir).fx_triples
    return G.entities_of_type(t, ["bf:Work", "bf:Instance"], by=["v"])


@query("delete_pattern", """
WITH f AS MATERIALIZED (SELECT subj, pred, obj, kind, v FROM fx_triples),
e AS (SELECT DISTINCT subj AS e FROM f WHERE pred = 'rdf:type' AND obj IN ('bf:Work', 'bf:Instance') AND kind <> 'bnode'),
s AS MATERIALIZED (SELECT subj, pred, obj, kind FROM f WHERE v = 1),
i AS (SELECT DISTINCT obj AS e FROM s), o AS (SELECT DISTINCT subj AS e FROM s),
m AS MATERIALIZED (SELECT e.e FROM e JOIN i ON i.e = e.e JOIN o ON o.e = e.e)
SELECT m.e, 'in' AS side, subj, pred, obj, kind FROM s JOIN m ON s.obj = m.e
UNION ALL SELECT m.e, 'out', subj, pred, obj, kind FROM s JOIN m ON s.subj = m.e""")
def delete_pattern(spark, sf_dir):
    t = Fixtures(spark, sf_dir).fx_triples
    ents = G.entities_of_type(t, ["bf:Work", "bf:Instance"])
    return G.delete_pattern(t.where(F.col("v") == 1), ents)


@query("triples_insert", """
SELECT subj, pred, obj, kind FROM fx_triples WHERE v = 1
UNION ALL
SELECT DISTINCT subj, pred, obj, kind FROM fx_triples n WHERE v = 2
  AND NOT EXISTS (SELECT 1 FROM fx_triples o WHERE o.v = 1 AND o.subj = n.subj AND o.pred = n.pred AND o.obj = n.obj AND o.kind = n.kind)""")
def triples_insert(spark, sf_dir):
    t = Fixtures(spark, sf_dir).fx_triples
    return G.insert_triples(t.where(F.col("v") == 1), t.where(F.col("v") == 2))


_REC_SQL = "CASE WHEN starts_with(subj, '_:b') THEN substr(subj, 4) ELSE regexp_extract(subj, '^http://e/([^#]*)#', 1) END"


@query("triples_upsert", f"""
WITH t AS (SELECT *, {_REC_SQL} AS rec FROM fx_triples),
m AS (SELECT rec, max(v) AS latest FROM t GROUP BY rec)
SELECT DISTINCT t.rec, subj, pred, obj, kind FROM t JOIN m ON t.rec = m.rec AND t.v = m.latest""")
def triples_upsert(spark, sf_dir):
    return G.upsert_by_record(Fixtures(spark, sf_dir).fx_triples)


def _expand_sql(c: str) -> str:
    out = c
    for p, ns in G.PREFIXES.items():
        out = f"CASE WHEN starts_with({c}, '{p}:') THEN '{ns}' || substr({c}, {len(p) + 2}) ELSE {out} END"
    return out


def _esc_sql(c: str) -> str:
    return f"replace(replace(replace(replace({c}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r')"


@query("ntriples_lines", f"""
SELECT concat_ws(' ', CASE WHEN starts_with(subj, '_:') THEN subj ELSE '<' || {_expand_sql('subj')} || '>' END,
  '<' || {_expand_sql('pred')} || '>',
  CASE WHEN kind = 'literal' THEN '"' || {_esc_sql('obj')} || '"' ELSE '<' || {_expand_sql('obj')} || '>' END, '.') AS line
FROM fx_triples""")
def ntriples_lines(spark, sf_dir):
    return G.ntriples(Fixtures(spark, sf_dir).fx_triples)


register_extra("fx_rdfxml", """
SELECT s_suppkey AS k,
  '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:bf="http://id.loc.gov/ontologies/bibframe/">'
  || '<bf:Work rdf:about="http://e/s' || CAST(s_suppkey AS STRING) || '#Work"><bf:title>' || s_name || '</bf:title>'
  || '<bf:hasInstance rdf:resource="http://e/s' || CAST(s_suppkey AS STRING) || '#Instance"/></bf:Work>'
  || '<bf:Instance rdf:about="http://e/s' || CAST(s_suppkey AS STRING) || '#Instance">'
  || '<bf:instanceOf rdf:resource="http://e/s' || CAST(s_suppkey AS STRING) || '#Work"/></bf:Instance></rdf:RDF>' AS xml
FROM supplier
""")


@query("rdfxml_nodes", """
SELECT s_suppkey AS k, 'http://e/s' || CAST(s_suppkey AS VARCHAR) || '#Work' AS subj, 'rdf:type' AS pred, 'bf:Work' AS obj, 'uri' AS kind FROM supplier
UNION ALL SELECT s_suppkey, 'http://e/s' || CAST(s_suppkey AS VARCHAR) || '#Work', 'bf:title', s_name, 'literal' FROM supplier
UNION ALL SELECT s_suppkey, 'http://e/s' || CAST(s_suppkey AS VARCHAR) || '#Work', 'bf:hasInstance', 'http://e/s' || CAST(s_suppkey AS VARCHAR) || '#Instance', 'uri' FROM supplier
UNION ALL SELECT s_suppkey, 'http://e/s' || CAST(s_suppkey AS VARCHAR) || '#Instance', 'rdf:type', 'bf:Instance', 'uri' FROM supplier
UNION ALL SELECT s_suppkey, 'http://e/s' || CAST(s_suppkey AS VARCHAR) || '#Instance', 'bf:instanceOf', 'http://e/s' || CAST(s_suppkey AS VARCHAR) || '#Work', 'uri' FROM supplier""")
def rdfxml_nodes(spark, sf_dir):
    return G.rdfxml_nodes(Fixtures(spark, sf_dir).fx_rdfxml, "xml", keep=["k"])
