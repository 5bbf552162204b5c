"""A training-corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

quality     documents whose quality score is under the classifier's threshold go
toxicity    documents whose toxicity score reaches the threshold go
dedup       of each group of near duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays
mix         documents are taken as often as the weighted mix of sources reads them (0, 1 or 2 times)
encode      BPE ids of every whole text, and digests of the ids and of the text they decode to

Both classifiers learn from the labels of documents that their stage gets.  Rows that share neither
doc_id nor text are told apart in dedup by a 64-bit hash of both, so a text that is like no other stays
whatever its doc_id; rows that repeat both count there as one document.  A row without a doc_id is a
duplicate like others, and stays only where its group has no doc_id.  Null and empty texts get the
classifiers' base scores, are no duplicates, are never taken by the mix more often than others (they have no
words) and have no ids.  An empty table gives an empty result.

Every stage sets Arrow batches of 1,000 rows where the session has the default (``small_batches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bibspark.llm import bpe, quality, toxicity
from bibspark.llm.mixing import mixed
from bibspark.llm.ngram_join import ngram_components
from bibspark.llm.queries import BPE_FILE, tokenizer_file
from bibspark.llm.shared import keep, small_batches, table


def _labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    score = quality.scorer(docs, _labels(spark, sf_dir, "quality"))
    return docs.where(score("text") >= quality.THRESHOLD)


def decent_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    score = toxicity.scorer(docs, _labels(spark, sf_dir, "toxic"))
    return docs.where(score("text") < toxicity.THRESHOLD)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("own"), "text")
    groups = keep(ngram_components(rows.select(F.col("key").alias("doc_id"), "text"), k=5, percent=80), "groups")
    named = rows.select("key", "own").distinct().join(groups.select(F.col("doc_id").alias("key"), "component_id").distinct(), "key")
    first = F.min(F.struct(F.col("own").isNull().alias("none"), F.col("own"), F.col("key")))
    kept = named.groupBy("component_id").agg(first.alias("first")).select(F.col("first.key").alias("kept"))
    own = docs.select(key.alias("key"), F.struct("*").alias("row"))
    own = own.join(kept, F.col("key") == F.col("kept"), "left_semi")
    place = F.row_number().over(W.partitionBy("key").orderBy("row"))
    return own.withColumn("place", place).where("place = 1").select("row.*")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    taken = mixed(docs).where("times > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(True), F.col("times")))).select("row.*")


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.digests(bpe.encoded(docs, tokenizer_file(BPE_FILE)))


STAGES = [
    ("quality", good_documents),
    ("toxicity", decent_documents),
    ("dedup", distinct_documents),
    ("mix", mixed_documents),
    ("encode", encoded_documents),
]

#: The classifiers and the tokenizer are no SQL; the tests hold the stages to brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
