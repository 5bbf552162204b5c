"""MARCXML source (S03) and its field shaping.

``spark.read.format("xml")`` with ``rowTag=record`` reads files; for XML
held in a column ``from_xml`` applies the same explicit schema.  The
schema is explicit because inference would turn tag ``001`` into the
number 1, and surrounding spaces are kept so a blank indicator stays ' '.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MARCXML_RECORD

XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "ignoreNamespace": "true"}


def read_marcxml(spark: SparkSession, path: str) -> DataFrame:
    """S03 on files: one row per <record> element, explicit schema."""
    r = spark.read.format("xml").option("rowTag", "record").schema(MARCXML_RECORD)
    for k, v in XML_OPTIONS.items():
        r = r.option(k, v)
    return r.load(path).withColumn("source", F.col("_metadata.file_path"))


def parse_marcxml(df: DataFrame, col: str, keep: list[str] | None = None) -> DataFrame:
    """S03 on a string column holding one <record> document per row."""
    keep = keep or []
    return df.select(*keep, F.from_xml(F.col(col), MARCXML_RECORD, XML_OPTIONS).alias("r")).select(*keep, "r.*")


def bibliographic(records: DataFrame) -> DataFrame:
    """records typed 'Bibliographic' or untyped."""
    return records.where(F.col("_type").isNull() | (F.col("_type") == "Bibliographic"))


def xml_fields(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """F02 (field level): ord 1 is the leader, then control fields, then data fields.

    The reader keeps each element list in order but not the interleaving
    of control and data fields; MARC puts control fields first.
    """
    keep = keep or []
    nc = F.coalesce(F.size("controlfield"), F.lit(0))
    ctl = records.select(*keep, F.posexplode("controlfield").alias("p", "c")).select(
        *keep, (F.col("p") + 2).cast("int").alias("ord"), F.col("c._tag").alias("tag"),
        F.lit(None).cast("string").alias("ind1"), F.lit(None).cast("string").alias("ind2"),
        F.col("c._VALUE").alias("value"))
    dat = records.select(*keep, nc.alias("nc"), F.posexplode("datafield").alias("p", "d")).select(
        *keep, (F.col("p") + F.col("nc") + 2).cast("int").alias("ord"), F.col("d._tag").alias("tag"),
        F.col("d._ind1").alias("ind1"), F.col("d._ind2").alias("ind2"), F.col("d.subfield").alias("value"))
    return ctl, dat


def xml_subfields(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """data fields -> subfields (ord, tag, ind1, ind2, sf_ord, code, value)."""
    keep = keep or []
    _, dat = xml_fields(records, keep)
    return dat.select(*keep, "ord", "tag", "ind1", "ind2", F.posexplode("value").alias("p", "s")).select(
        *keep, "ord", "tag", "ind1", "ind2", (F.col("p") + 1).cast("int").alias("sf_ord"),
        F.col("s._code").alias("code"), F.col("s._VALUE").alias("value"))
