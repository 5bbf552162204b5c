"""Code lists of the conversion rules as small DataFrames (broadcast in joins).

Each list has a fixed, small size (tens of rows) independent of the data,
so broadcasting it is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: leader code lists ---------------------------------------
LEADER_STATUS = [("a", "c"), ("c", "c"), ("n", "n"), ("p", "p")]
LEADER_ENCODING = [(" ", "f"), ("1", "1"), ("2", "7"), ("3", "3"), ("4", "4"), ("5", "5"), ("7", "7"), ("8", "8")]
LEADER_ENCODING_DEFAULT = "u"
LEADER_CONVENTIONS = [("a", "aacr"), ("c", "isbd"), ("i", "isbd"), ("p", "aacr"), ("r", "aacr")]
LEADER_CONVENTIONS_DEFAULT = "unknown"
LEADER_WORK_TYPE = [("a", "Text"), ("c", "NotatedMusic"), ("d", "NotatedMusic"), ("e", "Cartography"),
                    ("f", "Cartography"), ("g", "MovingImage"), ("i", "Audio"), ("j", "Audio"),
                    ("k", "StillImage"), ("o", "MixedMaterial"), ("p", "MixedMaterial"), ("r", "Object"),
                    ("t", "Text")]
LEADER_INSTANCE_TYPE = [("d", "Manuscript"), ("f", "Manuscript"), ("m", "Electronic"), ("t", "Manuscript")]
LEADER_ISSUANCE = [("a", "mono"), ("b", "serl"), ("i", "intg"), ("m", "mono"), ("s", "serl")]
ISSUANCE_STEM = "http://id.loc.gov/vocabulary/issuance/"
GENERATION_LABEL = "DLC marc2bibframe2 v1.3.0-SNAPSHOT"
# ---------------------------------------------------------------------------


def code_list(spark: SparkSession, rows: list[tuple], cols: str) -> DataFrame:
    return spark.createDataFrame(rows, cols)


def lookup(df: DataFrame, key_expr, vocab: DataFrame, vocab_key: str, how: str = "inner") -> DataFrame:
    """J01 code-list lookup: equi-join to a broadcast code list (a miss emits nothing)."""
    return df.withColumn("_code", key_expr).join(F.broadcast(vocab), F.col("_code") == vocab[vocab_key], how) \
        .drop("_code")


def values_sql(rows: list[tuple], cols: str) -> str:
    """The same code list as a DuckDB VALUES table expression."""
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({cols})"
