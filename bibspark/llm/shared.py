"""Tables written to the folder that driver and executors share, and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shared_dir

#: Edges that one task contracts at a time.
PIECE = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder (spark.checkpoint.dir)."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Arrow batches of ``rows`` rows from here on, where the session has Spark's 10,000: whole texts make those
    tens of megabytes, held by the executor and by its Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) == 10_000:
        spark.conf.set(name, rows)


def give_back() -> None:
    """Hand what a finished task has freed back to the machine: workers live on for the next stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(run):
    """A batch function that gives its memory back when it ends."""
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later jobs need none of its
    lineage, and a lost executor costs at most the tasks that ran on it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_rows(df: DataFrame, most: int) -> list:
    """The rows of a table whose size has a stated bound; more is an error, never a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows where at most {most} are possible")
    return rows


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest (node, smallest node of its component) of the edges: union-find on arrays."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if np.array_equal(low, high):
            break
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        keep_edge = root[a] != root[b]
        a, b = a[keep_edge], b[keep_edge]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contract(most: int, by_node: bool):
    """Edges of a partition replaced by a star forest; ``moved`` marks those that were not there before.

    A partition of more than ``most`` edges is contracted piece by piece.  With ``by_node`` the
    edges come sorted by u and pieces end between nodes: no node then has edges of two pieces,
    and a piece that is a star forest comes out as it went in, with nothing moved.
    """
    def out(before: list[np.ndarray]) -> pa.RecordBatch:
        u, v = forest(*before)
        order = np.lexsort((before[1], before[0]))
        old = np.rec.fromarrays([before[0][order], before[1][order]])
        at = np.minimum(np.searchsorted(old, np.rec.fromarrays([u, v])), len(old) - 1)
        same = (old.f0[at] == u) & (old.f1[at] == v) & (len(old) == len(u))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(~same)], ["u", "v", "moved"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size <= most:
                continue
            u, v = (np.concatenate(x) for x in zip(*held, strict=True))
            if by_node:  # the last node may go on in the next batch
                cut = int(np.searchsorted(u, u[-1]))
                if cut:
                    yield out([u[:cut], v[:cut]])
                held = [(u[cut:], v[cut:])]
            else:
                u, v = forest(u, v)
                if 2 * len(u) > most:
                    yield out([u, v])
                    u, v = u[:0], v[:0]
                held = [(u, v)]
            size = len(held[0][0])
        if size:
            yield out([np.concatenate(x) for x in zip(*held, strict=True)])

    return run


def components(edges: DataFrame, u: str, v: str, most: int = PIECE) -> DataFrame:
    """(node, component): the smallest node that each node of an edge reaches.  Nodes are longs.

    Edges point from a node to a smaller one.  A round brings all edges of a node together (a
    node has at most one edge from each piece of a partition of the round before, so there is no
    hot one), replaces each partition's edges by a star forest (in pieces of about ``most`` edges), and then
    lets every edge jump to where its end points (a join that Spark can split when many edges
    end at one node).  It ends when a round changes nothing.  Every round is written to the shared folder.
    """
    flagged = "u long, v long, moved boolean"
    e = edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).where("u <> v")
    e = e.mapInArrow(_contract(most, by_node=False), flagged).select("u", "v")
    while True:
        c = e.repartition("u").sortWithinPartitions("u").mapInArrow(_contract(most, by_node=True), flagged)
        up = c.select(F.col("u").alias("p"), F.col("v").alias("g"))
        e = keep(c.join(up, F.col("v") == F.col("p"), "left")
                 .select("u", F.coalesce("g", "v").alias("v"), (F.col("moved") | F.col("g").isNotNull()).alias("moved")), "edges")
        if e.where("moved").isEmpty():
            break
        e = e.select("u", "v")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _local_totals(value: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, so_far = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = so_far + np.cumsum(batch.column(value).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            so_far = int(own[-1]) if len(own) else so_far
            cols = [*batch.columns, pa.array(np.full(len(own), here, np.int32)), pa.array(own, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, "_part", "_own"])

    return run


def running_total(df: DataFrame, order: list[str], value: str, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` (a long) over all rows up to and including each, in the
    total order ``order``: a distributed sort, sums inside its partitions, written once, then
    each partition's offset (one row for each partition)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, _part int, _own long"
    local = keep(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .mapInArrow(_local_totals(df.columns.index(value)), schema), "sorted")
    sums = local.groupBy("_part").agg(F.max("_own").alias("_sum"))
    offsets = sums.select("_part", (F.sum("_sum").over(W.orderBy("_part")) - F.col("_sum")).alias("_off"))
    return local.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_own") + F.col("_off")).drop("_part", "_own", "_off")
