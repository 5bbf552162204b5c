"""Mixing sources to target weights by weighted fair queueing (dealt operator 8).

Sources in code-point order (null last) have the weights of a repeating pattern and share
a budget of ``share`` times all words; no source gets more than ``most`` times its own
words, what is over goes to the others by weight until none is above.  Documents of a
source stand in a fixed pseudo-random order, read ``most`` times over.  Each reading of a
document has a virtual finish time: the words of its source up to and including it,
divided by the source's target.  All readings are sorted by that time over the whole
table and taken up to the budget.

Both running totals (within a source, then over all) are distributed sorts with one
offset for each partition; a hot source is cut by the random key.  What is taken of a
source is a prefix of its order, so a table of one cut for each source marks the
documents.

Defined cases: a null text has size 0 and is taken in full length 0; rows with the same
source, doc_id and text stand at one place in the order and are taken together; sources of
size 0 have target 0; null ids and sources are values like others; an empty table gives no rows;
other columns ride along in ``row``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import row_index
from .shared import keep, running_total

WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"


def n_words(text: Column) -> Column:
    """Runs of characters other than space and 0x09-0x0D; null has none."""
    blank = F.regexp_replace(text, r"^[\x20\x09-\x0D]+$", "")
    return F.coalesce(F.length(F.regexp_replace(blank, WORD, "x")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> tuple[DataFrame, float]:
    """(source, source_size) to the same with weight and target, and the budget."""
    ranked = keep(row_index(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"]), "sources")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", pick.alias("weight"), (F.col("source_size") * most).alias("cap"))
    total = ranked.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    budget = min(float(total * share), float(total * most))
    held, rest, weight = -1, budget, 1
    full = F.lit(False)
    while True:  # more sources are full with each round, until none is above
        got = ranked.agg(F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)).alias("cap"),
                         F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight")).first()
        rest, weight = budget - got["cap"], got["weight"]
        if got["n"] == held or not weight:
            break
        held = got["n"]
        full = F.col("cap") <= F.lit(rest) * F.col("weight") / F.lit(weight)
    open_share = F.lit(rest) * F.col("weight") / F.lit(float(weight or 1))
    return ranked.withColumn("target", F.when(full, F.col("cap").cast("double")).otherwise(open_share)), budget


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 0) -> DataFrame:
    """Each row of ``docs`` (doc_id, source, text) as ``row`` with size, source_size, target and
    ``times``, how often the mix reads it."""
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"),
                       n_words(F.col("text")).alias("size"), place.alias("place"))
    queue = keep(rows.groupBy("source", "place").agg(F.sum("size").alias("words")), "queue")
    sources, budget = source_targets(queue.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    sources = keep(sources, "targets")
    queue = queue.withColumn("last", F.col("source").isNull())
    before = sources.select("source", F.col("source").isNull().alias("last"), "source_size")
    before = running_total(before, ["last", "source"], "source_size", "reach", 1 if queue.isEmpty() else None)
    before = before.select("source", "source_size", (F.col("reach") - F.col("source_size")).alias("offset"))
    queue = running_total(queue, ["last", "source", "place"], "words", "upto")
    queue = queue.join(before, queue["source"].eqNullSafe(before["source"])).drop(before["source"]) \
        .withColumn("upto", F.col("upto") - F.col("offset"))
    goal = sources.select(F.col("source").alias("s"), "target")
    reads = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    finish = (F.col("upto") + F.col("turn") * F.col("source_size")) / F.col("target")
    times = (queue.join(goal, F.col("source").eqNullSafe(F.col("s"))).withColumn("turn", reads)
             .select("source", "last", "turn", "place", "words", F.when(F.col("target") > 0, finish).otherwise(F.lit(0.0)).alias("finish")))
    line = running_total(times, ["finish", "last", "source", "turn", "place"], "words", "total")
    cuts = (line.where(F.col("total") <= F.lit(budget)).groupBy(F.col("source").alias("s"))
            .agg(F.max(F.struct("turn", "place")).alias("cut")))
    known = sources.select(F.col("source").alias("s"), "source_size", "target")
    known = known.join(cuts.withColumnRenamed("s", "c"), F.col("s").eqNullSafe(F.col("c")), "left").drop("c")
    taken = reduce(lambda a, b: a + b, [F.coalesce((F.struct(F.lit(t).alias("turn"), "place") <= F.col("cut")).cast("int"), F.lit(0)) for t in range(most)])
    return rows.join(known, F.col("source").eqNullSafe(F.col("s"))).select("row", "size", "source_size", "target", taken.alias("times"))
