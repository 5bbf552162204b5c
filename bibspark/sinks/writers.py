"""Sinks (K01-K08): Kafka payloads, per-record rows, copies, packed files.

One file per record (the splitter of the reference) is a small-files
anti-pattern on a cluster; records become rows of a table written with
``overwrite`` (the reference empties the target folder first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PACKED_FILES = 4000  # the spike's MAX_ALLOWED_FILES


def kafka_payload(df: DataFrame, topic: str, value: str, key: str | None = None) -> DataFrame:
    """K01-K03 payload shape: (topic, key, value) as the Kafka writer expects."""
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), k.alias("key"), F.col(value).cast("binary").alias("value"))


def write_kafka(payload: DataFrame, servers: str) -> None:
    """K02/K03 batch write (topic column routes rows); no broker in tests."""
    payload.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def records_by_control_number(fields: DataFrame) -> DataFrame:
    """One row per record named '<001>.mrc' with its frame, which the decoded fields carry
    (``decode_fields(..., keep=["frame"])``); duplicates kept, no join."""
    return fields.where(F.col("tag") == "001").select(F.concat(F.col("value"), F.lit(".mrc")).alias("name"), "frame")


def write_table(df: DataFrame, path: str, partition_hash: str | None = None, n: int | None = None) -> None:
    """Overwrite a table in the shared folder (spread by a hash of ``partition_hash``)."""
    if partition_hash:
        df = df.repartition(n or df.sparkSession.sparkContext.defaultParallelism, partition_hash)
    df.write.mode("overwrite").parquet(path)


def manifest(df: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    return df.select(name, F.length(content).cast("int").alias("n_bytes"), F.md5(content).alias("md5"))


def pack_files(files: DataFrame, name: str = "name", limit: int = MAX_PACKED_FILES) -> DataFrame:
    """The first ``limit`` (name, bytes) pairs by name (top-k, bounded)."""
    return files.orderBy(name).limit(limit)
