"""Order-dependent grouping without a single-task window.

``row_index`` numbers rows in a total order the way a distributed sort
does: range-partition on the order (a hot key is split across partitions
by the secondary sort columns), number rows inside each partition, then
add the prefix sum of the preceding partitions' counts.  The only global
step is a per-partition count table (one row per partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def row_index(df: DataFrame, order: list[str], partitions: int | None = None, name: str = "idx") -> DataFrame:
    """0-based position of each row in the total order ``order`` (ties must not exist).

    Range-partition and sort inside partitions (a distributed sort), tag rows
    with ``monotonically_increasing_id`` (partition id in the high bits, row
    in the low 33 bits), then checkpoint once into the shared folder: the
    per-partition counts and the row tags must come from one
    materialisation (range bounds are sampled per exchange), and the
    checkpoint also cuts the lineage for executor loss.
    """
    spark = df.sparkSession
    shared_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id())).checkpoint(eager=True)
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", 33)) \
        .withColumn("_li", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = tagged.groupBy("_pid").agg(F.count("*").alias("_n"))
    # one row per partition: a bounded table, so a global window is fine here
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return tagged.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + F.col("_li")) \
        .drop("_pid", "_li", "_off", "_mid")


def chunk_ids(df: DataFrame, order: list[str], size: int, name: str = "chunk") -> DataFrame:
    """Consecutive chunks of ``size`` rows in order: floor(index / size)."""
    return row_index(df, order).withColumn(name, F.floor(F.col("idx") / size).cast("bigint"))


def group_chunks(df: DataFrame, group: list[str], order: list[str], size: int, name: str = "chunk") -> DataFrame:
    """Chunks of ``size`` rows inside each group, numbered in order.

    Index within the group = global index - first global index of the group
    (a per-group min, a small aggregate).
    """
    idx = row_index(df, group + order)
    start = idx.groupBy(*group).agg(F.min("idx").alias("_start"))
    return idx.join(start, group).withColumn(name, F.floor((F.col("idx") - F.col("_start")) / size).cast("bigint")) \
        .drop("_start")


def exact_quantiles(df: DataFrame, group: str, value: str, qs: list[float],
                    max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Exact continuous quantiles (linear interpolation) per group, without
    gathering a group's values in one task.

    Rows are ranked inside their group through :func:`row_index`; only the
    two ranks around each wanted position are kept (a semi-join with a
    target table of groups x quantiles x 2 rows), then interpolated.
    """
    v = df.select(group, value).where(F.col(value).isNotNull())
    ranked = row_index(v.withColumn("_tie", F.monotonically_increasing_id()), [group, value, "_tie"])
    bounds = ranked.groupBy(group).agg(F.min("idx").alias("_start"), F.count("*").alias("_n"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    targets = bounds.select(group, "_start", "_n", F.explode(qarr).alias("q")).select(
        group, "q", "_start", (F.col("q") * (F.col("_n") - 1)).alias("_pos"))
    targets = targets.select("*", F.floor("_pos").cast("bigint").alias("_lo"), F.ceil("_pos").cast("bigint").alias("_hi"))
    wanted = targets.select(group, (F.col("_start") + F.col("_lo")).alias("idx")).unionByName(
        targets.select(group, (F.col("_start") + F.col("_hi")).alias("idx"))).distinct()
    n_wanted = wanted.limit(max_broadcast_rows + 1).count()
    w = F.broadcast(wanted) if n_wanted <= max_broadcast_rows else wanted
    picked = ranked.join(w, [group, "idx"], "left_semi").select(group, "idx", value)
    lo = picked.select(group, F.col("idx").alias("_ilo"), F.col(value).alias("_vlo"))
    hi = picked.select(group, F.col("idx").alias("_ihi"), F.col(value).alias("_vhi"))
    t = targets.withColumn("_ilo", F.col("_start") + F.col("_lo")).withColumn("_ihi", F.col("_start") + F.col("_hi"))
    t = t.join(lo, [group, "_ilo"]).join(hi, [group, "_ihi"])
    res = F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return t.select(group, "q", res.alias("quantile"))
