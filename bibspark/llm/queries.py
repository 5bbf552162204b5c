"""Queries of the dealt operators: thin (spark, sf_dir) callables over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, quality, quality_rules, toxicity
from .alignment import aligned
from .ann import nearest_neighbours
from .chat import digests, examples
from .counts import token_counts
from .licenses import license_hits
from .mixing import mixed
from .ngram_join import ngram_components
from .oracles import ORACLES as ORACLES
from .quality import in_fold
from .shared import table
from .spelling import spelling_variants
from .vector_dedup import near_duplicates

BPE_FILE, BYTE_FILE, PIECE_FILE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer file, which the driver reads and broadcasts."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), k=4, percent=85)


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "<|im_end|><|im_start|>assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return digests(examples(rows.union(more)))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encoded(table(spark, sf_dir, "documents"), tokenizer_file(BPE_FILE)))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_FILE))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_hits(table(spark, sf_dir, "documents"))


def _judged(spark: SparkSession, sf_dir: str, module, label: str, folds: int, fold: int) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold(F.col("doc_id"), folds, fold)
    score = module.scorer(docs, labels.where(~held_out).select("doc_id", F.col(label).alias("label")))
    return (docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= module.THRESHOLD).cast("int")))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, quality, "quality", 5, 0)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, toxicity, "toxic", 4, 2)


@query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9)


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality_rules.judged(table(spark, sf_dir, "documents"), labels).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_FILE), tokenizer_file(PIECE_FILE))
