"""Embedding near-dedup by sorted projection passes (dealt operator 3).

Equal vectors are one class from the start.  Each pass gives a vector, less the mean
direction of all, 64 random hyperplane signs as one key; all vectors are sorted by pass and key
(a distributed sort) and each is compared, by exact cosine in double precision, to the
``window`` before it, also over the edges of partitions.  Verified pairs of all passes are
united into components.

Windows bound what is compared, so a link is found with a probability only.  The passes and
the window grow with the table so that, for vectors spread evenly around their mean, a pair just
at the threshold that no other vector joins is missed with at most 1 - ``recall``: its two
signs differ with angle / pi, and a pass finds it at least when its keys agree in the first
log2(n / window) signs.  Denser clusters than that share longer keys and can lose more.
So that no link among near copies is lost to windows, every component is then compared in full, in
blocks of at most about ``block`` vectors and pairs of such blocks, each task counting the links of its two
blocks.  No pair is emitted, only counts.  The work in a component grows with the square of
its distinct vectors, spread over its pairs of blocks.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components link with nothing and are returned with 0 links and their own id as
component; repeated rows are copies like others; rows without a vec_id take part, and have the smallest id
of their component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_rows, components, forest, keep

PASSES = 16  # at least; passes_for() has the number for a table
RECALL = 0.999
WINDOW = 64  # at least
MOST_WINDOW = 4096
ROW = 512  # comparisons that cost about as much as the sort of a row in a pass
BLOCK = 1024
SLICE = 1 << 24  # bytes of signs, and of copies, that a task makes at a time


def usable(vector: str = "embedding"):
    """Whether a vector is there, not zero, and has only finite components."""
    v = F.col(vector)
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long vectors as a matrix of doubles."""
    if not len(column):
        return np.zeros((0, 0))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)  # first, so that no square overflows
    x = x / largest
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    return a @ b.T >= least


def passes_for(n: int, least: float, spread: float, window: int = WINDOW, recall: float = RECALL) -> tuple[int, int]:
    """(passes, window) that find a lone pair of cosine ``least`` among ``n`` vectors with probability
    ``recall``, for the least work; ``window`` is the smallest to take, ``spread`` the mean square length that
    unit vectors keep when their mean is taken away."""
    if spread <= 1 - least:
        return 1, window  # even the mean pair of vectors is a link, and their neighbours in any order are
    agree = 1 - np.arccos(1 - (1 - least) / spread) / np.pi  # of a sign of the pair, after centring
    best = None
    while True:
        found = min(1.0, (n / window) ** np.log2(agree)) if n > window + 1 else 1.0
        passes = 1 if found == 1 else int(np.ceil(np.log1p(-recall) / np.log1p(-found)))
        cost = passes * (window + ROW)
        if best is None or cost < best[0]:
            best = cost, passes, window
        if found == 1 or window * 2 > min(MOST_WINDOW, n // 64):  # small beside a partition
            return best[1:]
        window *= 2


def _sums(dim: int):
    """The sum of a partition's unit vectors, and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dim), 0
        for batch in batches:
            if batch.num_rows:
                total += unit(matrix(batch.column(0))).sum(axis=0)
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total), pa.array(np.full(dim, n))], ["at", "total", "n"])

    return run


def _keyed(dim: int, passes: int, seed: int, mean: np.ndarray, most: int = SLICE):
    """Rows (node, embedding) to one row a pass with its key, in slices whose signs and copies take about ``most`` bytes
    each, however many passes there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).standard_normal((dim, passes * 64))
        weight = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        step = max(1, most // (8 * passes * max(64, dim)))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                n = part.num_rows
                signs = ((unit(matrix(part.column(1))) - mean) @ planes > 0).reshape(n, passes, 64)
                keys = np.empty((n, passes), np.uint64)
                for row in range(n):  # a row's signs as 64-bit words: all at once they would be eight times their size
                    keys[row] = signs[row].astype(np.uint64) @ weight
                keys ^= np.uint64(1) << np.uint64(63)  # in the order of signed longs
                at = pa.array(np.repeat(np.arange(n), passes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(passes, dtype=np.int32), n)), pa.array(keys.reshape(-1).view(np.int64)),
                     part.column(0).take(at), part.column(1).take(at)], ["pass", "key", "node", "embedding"])

    return run


def _near(x: np.ndarray, old: int, run_of: np.ndarray, node: np.ndarray, window: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of the vectors from ``old`` on to the ``window`` before them in the same run, as a forest."""
    us, vs = [], []
    for s in range(old, len(x), 256):  # a band of the window at a time
        e, b = min(s + 256, len(x)), max(0, s - window)
        i, j = np.nonzero(linked(x[s:e], x[b:e], least))
        i, j = i + s, j + b
        near = (j < i) & (i - j <= window) & (run_of[i] == run_of[j])
        us.append(node[i[near]])
        vs.append(node[j[near]])
    return forest(np.concatenate(us), np.concatenate(vs))


_LINE = {"u": pa.int64(), "v": pa.int64(), "part": pa.int32(), "place": pa.int64(), "pass": pa.int32(), "node": pa.int64(),
         "embedding": pa.list_(pa.float64())}


def _line_batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns and not isinstance(columns[k], pa.Array)
                                       else columns.get(k, pa.nulls(n, t)) for k, t in _LINE.items()], list(_LINE))


def _window_links(window: int, least: float):
    """Links (u, v) of each vector to the ``window`` before it in its partition, as a forest of each
    batch; and the partition's first and last ``window`` rows with their places in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, so_far = TaskContext.get().partitionId(), 0
        node, run_of, x = np.zeros(0, np.int64), np.zeros(0, np.int32), None
        last: list[pa.RecordBatch] = []

        def rows(part: pa.RecordBatch, place: int) -> pa.RecordBatch:
            n = part.num_rows
            return _line_batch(n, part=np.full(n, here, np.int32), place=np.arange(place, place + n), embedding=part.column(2).cast(_LINE["embedding"]),
                               **{"pass": part.column(0), "node": part.column(1)})

        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                own = unit(matrix(part.column(2)))
                x = own if x is None else np.vstack([x[-window:], own])
                old = len(x) - len(own)
                node = np.concatenate([node[len(node) - old :], part.column(1).to_numpy()])
                run_of = np.concatenate([run_of[len(run_of) - old :], part.column(0).to_numpy()])
                u, v = _near(x, old, run_of, node, window, least)
                if len(u):
                    yield _line_batch(len(u), u=u, v=v)
                first = min(max(window - so_far, 0), part.num_rows)
                if first:
                    yield rows(part.slice(0, first), so_far)
                rest = part.slice(first)
                so_far += part.num_rows
                last.append(rest.slice(max(0, rest.num_rows - window)))
                while sum(b.num_rows for b in last[1:]) >= window:
                    last.pop(0)
        place = so_far - sum(b.num_rows for b in last)
        for part in last:
            if part.num_rows:
                yield rows(part, place)
            place += part.num_rows

    return run


def _to_edges(before: dict[int, int], edges: np.ndarray, window: int):
    """Rows at the ends of partitions to (edge, place, pass, node, embedding), once for each partition
    edge they lie within ``window`` of; places now count from the first partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(1).to_numpy() + np.array([before[p] for p in batch.column(0).to_pylist()], np.int64)
            lo, hi = np.searchsorted(edges, place - window, side="right"), np.searchsorted(edges, place + window, side="right")
            at = np.repeat(np.arange(len(place)), hi - lo)
            edge = lo[at] + np.arange(len(at)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(edges[edge], pa.int64()), pa.array(place[at], pa.int64()), *(batch.column(i).take(take) for i in (2, 3, 4))],
                                             ["edge", "place", "pass", "node", "embedding"])

    return run


def _edge_links(window: int, least: float):
    """Links over the edges of partitions, of rows sorted by (edge, place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            u, v = _near(unit(matrix(t.column("embedding"))), 0, t.column("pass").to_numpy(), t.column("node").to_numpy(), window, least)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            edge = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(edge)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if held and edge[lo] != now:
                    yield links(held)
                    held = []
                now = edge[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield links(held)

    return run


def window_links(line: DataFrame, window: int, least: float) -> DataFrame:
    """(u, v): links of the rows (pass, node, embedding) of ``line``, a distributed sort, to the ``window`` before them."""
    done = keep(line.mapInArrow(_window_links(window, least), "u long, v long, part int, place long, pass int, node long, embedding array<double>"), "line")
    ends = done.where("part IS NOT NULL")
    # one row for each partition
    sizes = dict(ends.groupBy("part").agg((F.max("place") + 1).alias("n")).orderBy("part").collect())
    after = np.cumsum([0, *sizes.values()])
    found = done.where("u IS NOT NULL").select("u", "v")
    if len(sizes) < 2:
        return found
    before = dict(zip(sizes, after[:-1].tolist(), strict=True))
    # a row further than a window from the ends of its partition has no part in a link over them
    at_edge = ends.select("part", "place", "pass", "node", "embedding").mapInArrow(
        _to_edges(before, after[1:-1], window), "edge long, place long, pass int, node long, embedding array<double>")
    return found.union(at_edge.repartition("edge").sortWithinPartitions("edge", "place").mapInArrow(_edge_links(window, least), "u long, v long"))


def _block_counts(least: float, step: int = 512):
    """Rows sorted by (component, i, j, side) to (node, copies linked): each pair of blocks compared once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            x, node, copies = unit(matrix(t.column("embedding"))), t.column("node").to_numpy(), t.column("copies").to_numpy()
            side = t.column("side").to_numpy()
            n = np.zeros(len(node), np.int64)
            a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(b) and t.column("i")[0].as_py() == t.column("j")[0].as_py():
                for lo in range(0, len(a), step):
                    hit = linked(x[a[lo : lo + step]], x, least)
                    hit[np.arange(len(hit)), np.arange(lo, lo + len(hit))] = False
                    n[lo : lo + step] = hit @ copies
            else:
                for lo in range(0, len(a), step):
                    hit = linked(x[a[lo : lo + step]], x[b], least)
                    n[a[lo : lo + step]] = hit @ copies[b]
                    n[b] += copies[a[lo : lo + step]] @ hit
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(n)], ["node", "links"])

        held: list[pa.RecordBatch] = []
        now = None
        out: list[pa.RecordBatch] = []
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in range(3)]
            new = np.ones(batch.num_rows, dtype=bool)
            for k in keys:
                new[1:] &= k[1:] == k[:-1]
            new = ~new
            if batch.num_rows:
                new[0] = True
            starts = np.append(np.flatnonzero(new), batch.num_rows)
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                key = tuple(int(k[lo]) for k in keys)
                if key != now and held:
                    out.append(counts(held))
                    held = []
                now = key
                held.append(batch.slice(lo, hi - lo))
                if len(out) >= 256:
                    yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                    out = []
        if held:
            out.append(counts(held))
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.9, passes: int = PASSES, window: int = WINDOW, block: int = BLOCK, seed: int = 7,
                    recall: float = RECALL) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id and kept; by ``passes``
    passes, or as many more (and a larger ``window``) as ``recall`` needs."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("ok", usable())
    sizes = rows.where("ok").groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = sizes["dim"] if sizes else 1
    rows = rows.withColumn("ok", F.col("ok") & (F.size("embedding") == dim))
    # a class of equal vectors goes by a 63-bit hash of them; its smallest id names it later
    node = F.shiftrightunsigned(F.xxhash64("embedding"), 1)
    rows = keep(rows.select("vec_id", F.when(F.col("ok"), node).alias("node"), F.when(F.col("ok"), F.col("embedding")).alias("embedding")), "vectors")
    classes = keep(rows.where("node IS NOT NULL").groupBy("node")
                   .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")), "classes")
    # a row for each component of the sum
    sums = bounded_rows(classes.select("embedding").mapInArrow(_sums(dim), "at int, total double, n long")
                        .groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).orderBy("at"), dim)
    n = sums[0]["n"] if sums else 0
    mean = np.array([r["total"] for r in sums]) / max(n, 1) if sums else np.zeros(dim)
    enough, window = passes_for(n, least, 1 - float(mean @ mean), window, recall)
    passes = max(passes, enough)
    keyed = classes.select("node", "embedding").mapInArrow(_keyed(dim, passes, seed, mean), "pass int, key long, node long, embedding array<double>")
    line = keyed.repartitionByRange(F.col("pass"), F.col("key"), F.col("node")).sortWithinPartitions("pass", "key", "node").select("pass", "node", "embedding")
    found = window_links(line, window, least)
    comp = keep(components(found, "u", "v"), "components")

    # every component in full: vectors dealt to blocks, blocks to pairs of blocks
    sizes = comp.groupBy("component").agg(F.count("*").alias("n"))
    members = (classes.join(comp, "node").join(sizes.select("component", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "component")
               .withColumn("mine", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")))
    pairs = (members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     (F.col("mine") > F.col("other")).cast("int").alias("side"), "node", "copies", "embedding"))
    counted = (pairs.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "side")
               .mapInArrow(_block_counts(least), "node long, links long").groupBy("node").agg(F.sum("links").alias("links")))
    known = (classes.select("node", "rep", "copies").join(comp, "node", "left").join(counted, "node", "left")
             .select("node", "rep", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    known = keep(known, "classes")
    smallest = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = known.join(smallest, "component").select("node", "n_links", "component_id")
    out = rows.select("vec_id", "node").join(known, "node", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
