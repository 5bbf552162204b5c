"""Counters and timing summaries (E01, A08, M01, M02) as jobs over an events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.ordered import exact_quantiles

QUANTILES = (0.5, 0.75, 0.95, 0.99)


def observe_stages(df: DataFrame, stage: str = "stage") -> tuple[DataFrame, Observation]:
    """Counters that ride along an action (no second pass, no accumulator double counts)."""
    obs = Observation("stage_counts")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                     F.count_if(F.col(stage) == "error").alias("errors"))
    return out, obs


def stage_counts(df: DataFrame, stage: str = "stage") -> DataFrame:
    """Records per stage (map-side partial counts, one small shuffle)."""
    return df.groupBy(stage).agg(F.count("*").cast("bigint").alias("n"))


def timing_summary(df: DataFrame, group: str, value: str, qs=QUANTILES) -> DataFrame:
    """Count, min, max, mean and exact percentiles per group."""
    base = df.groupBy(group).agg(F.count(value).cast("bigint").alias("n"), F.min(value).alias("min"),
                                 F.max(value).alias("max"), F.round(F.avg(value), 6).alias("mean"))
    qv = exact_quantiles(df, group, value, list(qs))
    piv = qv.groupBy(group).agg(*[F.round(F.max(F.when(F.col("q") == q, F.col("quantile"))), 6)
                                  .alias(f"p{int(q * 100)}") for q in qs])
    return base.join(piv, group, "left")


def elapsed_per_run(df: DataFrame, run: str, ts: str) -> DataFrame:
    """Total elapsed seconds per run (max - min timestamp)."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.groupBy(run).agg(F.count("*").cast("bigint").alias("n"),
                               F.round((F.max(micros) - F.min(micros)) / 1e6, 3).alias("elapsed_sec"))
