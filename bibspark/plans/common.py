"""Shared pieces of the rule jobs: record URIs, nested fields, triple rows.

A rule job is a table function ``(records, fields) -> triples`` over all
records at once.  Fields carry their subfields as an ordered array
(``sfs``), so most rules are per-row higher-order expressions that emit an
array of triples, flattened with ``inline``: no per-rule shuffle.  Only
rules that read other fields of the record join or window on
``record_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

BASE_URI = "http://example.org/"

TRIPLE_FIELDS = ["subj", "pred", "obj", "obj_kind", "lang", "datatype"]


def nest_fields(subfields: DataFrame, parts: int | None = None) -> DataFrame:
    """Flat subfields -> one row per field with ``sfs`` ordered by sf_ord.

    One aggregate keyed by (record_id, ord); a field is bounded (< 10 kB),
    so no group can grow with the data.  Decoding frames yields this shape
    directly (see :func:`nested_from_fields`), without the shuffle.

    The subfields are dealt by record first: what then joins or windows by record shuffles no field
    again, and subfields are sorted in the parts of a shuffle, which follow the rows.  Aggregated where
    they are made, a task would sort all that its file's lines unfold to, and spill.  They are sorted once:
    the aggregate (see ``session.compiled``) and a join by record take that order.  ``parts``: of the shuffle, where
    the session's number would leave a task more than it can sort in memory, as for whole catalogues.
    """
    keys = ("record_id", "ord", "tag", "ind1", "ind2")
    dealt = subfields.repartition(parts, "record_id") if parts else subfields.repartition("record_id")
    return (dealt.sortWithinPartitions(*keys).groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("sf_ord", "code", "value"))).alias("sfs")))  # array_sort interprets its comparator


def nested_from_fields(fields: DataFrame) -> DataFrame:
    """Decoded data fields (value with 0x1F delimiters) -> nested ``sfs``; narrow."""
    parts = F.split(F.col("value"), "\x1f", -1)
    parts = F.slice(parts, F.lit(2), F.size(parts))  # all after the indicators
    sfs = F.transform(parts, lambda p, i: F.struct((i + 1).cast("int").alias("sf_ord"),
                                                   F.substring(p, 1, 1).alias("code"),
                                                   F.substr(p, F.lit(2)).alias("value")))
    return fields.where(F.col("tag") >= "010").select("record_id", "ord", "tag", "ind1", "ind2", sfs.alias("sfs"))


def with_eff_tag(fields: DataFrame) -> DataFrame:
    """F07 on nested fields: an 880 uses the first 3 chars of its $6."""
    sf6 = first_value(F.col("sfs"), "6")
    return fields.withColumn("eff_tag", F.when(F.col("tag") == "880", F.substring(sf6, 1, 3)).otherwise(F.col("tag")))


def effective(fields: DataFrame, *tags: str) -> DataFrame:
    """The fields of these effective tags.  They can only be fields of the tags themselves or 880s;
    said of ``tag`` too, the filter reaches below the nesting and other fields are never nested."""
    return fields.where(F.col("tag").isin(*tags, "880") & F.col("eff_tag").isin(*tags))


def sf_values(sfs: Column, codes: str) -> Column:
    """Values of the given codes, in document order."""
    return F.transform(F.filter(sfs, lambda s: s["code"].isin(*list(codes))), lambda s: s["value"])


def sf_of(sfs: Column, codes: str) -> Column:
    return F.filter(sfs, lambda s: s["code"].isin(*list(codes)))


def first_value(sfs: Column, code: str) -> Column:
    return F.try_element_at(sf_values(sfs, code), F.lit(1))


def has_code(sfs: Column, code: str) -> Column:
    return F.exists(sfs, lambda s: s["code"] == code)


def label(sfs: Column, codes: str) -> Column:
    """F08 concat-nodes-space: chosen codes in order, space-joined, normalised."""
    return X.normalize_space(F.array_join(sf_values(sfs, codes), " "))


def marc_key(tag: Column, ind1: Column, ind2: Column, sfs: Column, codes: str | None = None) -> Column:
    """F09 marcKey: tag + ind1 + ind2 + '$' code text ... in document order."""
    chosen = sfs if codes is None else sf_of(sfs, codes)
    body = F.array_join(F.transform(chosen, lambda s: F.concat(F.lit("$"), s["code"], s["value"])), "")
    return F.concat(tag, ind1, ind2, body)


def record_uris(records: DataFrame, id_col: str = "c001", base: str = BASE_URI) -> DataFrame:
    """F05 on the header table: base URI + url-encoded control number, or a generated id without one."""
    return with_record_uri(records, id_col, base).select("record_id", "ruri")


def with_record_uri(records: DataFrame, id_col: str = "c001", base: str = BASE_URI) -> DataFrame:
    """The header table with each record's URI: a projection, no join."""
    own = F.nullif(X.url_encode(id_col), F.lit(""))
    return records.withColumn("ruri", F.concat(F.lit(base), F.coalesce(own, generated_id(F.col("record_id")))))


def generated_id(record_id: Column) -> Column:
    """The id of a record whose id field does not give one."""
    return F.concat(F.lit("r"), F.substring(F.sha2(record_id, 256), 1, 16))


def with_uri(fields: DataFrame, uris: DataFrame) -> DataFrame:
    """Attach the record URI unless the fields already carry it (nested once per
    session with the URI, or decoded from frames with it): no join per rule then."""
    if "ruri" in fields.columns:
        return fields
    return fields.join(uris.select("record_id", "ruri"), "record_id")


def mint_record_id(fields: DataFrame, idfield: str = "001", base: str = BASE_URI) -> DataFrame:
    """F05 recordid: the id field must occur exactly once, else a generated id.

    ``fields`` is the flat fields table (control fields carry ``value``)
    or the flat subfields table for a data-field id (``245a``).  One hash
    aggregate per record.
    """
    tag = idfield[:3]
    if tag < "010":
        cand = fields.where(F.col("tag") == tag).select("record_id", F.col("value").alias("v"))
    else:
        code = idfield[3:4] or "a"
        cand = fields.where((F.col("tag") == tag) & (F.col("code") == code)) \
            .select("record_id", X.normalize_space("value").alias("v"))
    ids = cand.groupBy("record_id").agg(F.count("*").alias("n"), F.first("v").alias("v"))
    allr = fields.select("record_id").distinct()
    j = allr.join(ids, "record_id", "left")
    minted = F.when((F.col("n") == 1) & (X.url_encode("v") != ""), F.concat(F.lit(base), X.url_encode("v")))
    gen = F.concat(F.lit(base), generated_id(F.col("record_id")))
    return j.select("record_id", F.coalesce(minted, gen).alias("ruri"), minted.isNull().alias("generated"))


def bnode(record_id: Column, ord_: Column, sf_ord, rule: str, n) -> Column:
    """Deterministic blank node: _:<record_id>-<ord>-<sf_ord>-<rule>-<n>."""
    def s(x):
        return x.cast("string") if isinstance(x, Column) else F.lit(str(x))
    return F.concat(F.lit("_:"), record_id, F.lit("-"), s(ord_), F.lit("-"), s(sf_ord), F.lit("-"),
                    F.lit(rule), F.lit("-"), s(n))


def t(subj: Column, pred, obj, kind="literal", lang: Column | None = None, datatype: str | None = None) -> Column:
    """One triple as a struct; pred/obj/kind may be literals or columns."""
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)
    return F.struct(subj.alias("subj"), lit(pred).alias("pred"), lit(obj).cast("string").alias("obj"),
                    lit(kind).alias("obj_kind"),
                    (lang if lang is not None else F.lit(None)).cast("string").alias("lang"),
                    F.lit(datatype).cast("string").alias("datatype"))


def ts(*triples: Column) -> Column:
    return F.array(*triples)


def when_ts(cond: Column, arr: Column) -> Column:
    return F.when(cond, arr).otherwise(F.array().cast(arr_type()))


def arr_type() -> str:
    return ("array<struct<subj:string,pred:string,obj:string,obj_kind:string,"
            "lang:string,datatype:string>>")


def emit(df: DataFrame, triples: Column, rule: str, keep: tuple[str, ...] = ("record_id",)) -> DataFrame:
    """Flatten an array-of-triples column; drop triples without an object."""
    return (df.select(*keep, F.inline(triples))
            .where(F.col("obj").isNotNull() & F.col("subj").isNotNull())
            .withColumn("rule", F.lit(rule)))


def bf(name: str) -> str:
    return X.BF + name


def bflc(name: str) -> str:
    return X.BFLC + name


RDF_TYPE = X.RDF + "type"
RDFS_LABEL = X.RDFS + "label"
RDF_VALUE = X.RDF + "value"
