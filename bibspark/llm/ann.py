"""Approximate nearest neighbours by an inverted multi-index (dealt operator 4).

Vectors are cut into two halves; k-means on a bounded sample (``sample`` rows, by a fixed
hash of the id) gives ``centres`` centroids for each half, and a vector's cell is its pair
of nearest centroids.  Every vector is indexed.  A query goes through the cells by the sum
of its two squared distances, kept in a heap, until it has passed at least ``share`` of
all vectors (and ``least`` of them); the vectors of those cells are ranked by their exact distance in
double precision.  How far to go depends on the data: vectors in clusters need a small
share, directions without any structure need a large one for the same recall.

Cells are cut into chunks of about ``chunk`` vectors by a hash of the id, so equal vectors,
however many, do not meet in one task; each chunk gives each query its nearest k, and these
are merged.  Distances that could tie within rounding are worked out one by one.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id; a query's own id, however often it
comes, is no neighbour of it; repeated rows of other ids come as often as they are there; an empty
table, and one without queries, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import bounded_rows, keep
from .vector_dedup import matrix, usable

SAMPLE = 10_000
CENTRES = 32
SHARE = 0.6
LEAST = 2_000
CHUNK = 4_096


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most k centroids by Lloyd's rounds from spread-out first ones."""
    centres = x[:1]
    near = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k and near.max() > 0:  # the farthest row of a fixed stride of rows
        centres = np.vstack([centres, x[int(near.argmax())]])
        near = np.minimum(near, ((x - centres[-1]) ** 2).sum(1))
    for _ in range(rounds):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)).clip(0)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return distances(x, centres).argmin(axis=1)


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells by the sum of the halves' distances until they hold ``enough`` vectors; cells are
    numbered i * len(second) + j, and only those with vectors are returned."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
    cells, held = [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(b) + int(b[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (first[a[p]] + second[b[q]], p, q))
    return cells


def _cells(one: np.ndarray, two: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            half = x.shape[1] // 2
            cell = nearest(x[:, :half], one) * len(two) + nearest(x[:, half:], two)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["vec_id", "embedding", "cell"])

    return run


def _visits(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, enough: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            half = x.shape[1] // 2
            d1, d2 = distances(x[:, :half], one), distances(x[:, half:], two)
            for i in range(len(x)):
                cells = traverse(d1[i], d2[i], sizes, enough)
                at = pa.array(np.full(len(cells), i))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(cells, pa.int32())],
                                                 ["vec_id", "embedding", "cell"])

    return run


def top(q: np.ndarray, own: int, x: np.ndarray, ids: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the k nearest of x to q, ties to the smaller id; rough: squared distances within rounding."""
    rough = np.where(ids == own, np.inf, rough)
    if len(rough) > k:
        edge = np.partition(rough, k - 1)[k - 1]
        slack = 1e-9 * (edge + float(q @ q) + 1e-300)
        at = np.flatnonzero(rough <= edge + slack)
    else:
        at = np.arange(len(rough))
    at = at[ids[at] != own]
    exact = np.sqrt(((x[at] - q) ** 2).sum(axis=1))
    order = np.lexsort((ids[at], exact))[:k]
    return ids[at][order], exact[order]


def _search(k: int):
    """Rows sorted by (cell, chunk, side): a chunk's vectors (side 0), then the queries that visit it (side 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, parts, x, norm = None, [], [], None, None

        def close() -> None:
            nonlocal ids, x, norm
            if x is None:
                ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
                x = np.vstack(parts) if parts else np.zeros((0, 0))
                norm = (x * x).sum(1)

        for batch in batches:
            cell, chunk, side, vec = (batch.column(i).to_numpy() for i in range(4))
            if not len(cell):
                continue
            emb = matrix(batch.column(4))
            new = np.append(np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (chunk[1:] != chunk[:-1]) | (side[1:] != side[:-1])])), len(cell))
            for lo, hi in zip(new[:-1].tolist(), new[1:].tolist(), strict=True):
                if (cell[lo], chunk[lo]) != now:
                    now, ids, parts, x, norm = (cell[lo], chunk[lo]), [], [], None, None
                if side[lo] == 0:
                    ids.append(vec[lo:hi])
                    parts.append(emb[lo:hi])
                    continue
                close()
                if not len(ids):
                    continue
                for s in range(lo, hi, 64):
                    q, who = emb[s : min(s + 64, hi)], vec[s : min(s + 64, hi)]
                    rough = ((q * q).sum(1)[:, None] - 2 * q @ x.T + norm).clip(0)
                    got = [top(q[i], int(who[i]), x, ids, rough[i], k) for i in range(len(q))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(who, [len(g) for g, _ in got])), pa.array(np.concatenate([g for g, _ in got])),
                         pa.array(np.concatenate([d for _, d in got]))], ["query_id", "vec_id", "score"])

    return run


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 10, sample: int = SAMPLE, centres: int = CENTRES,
                       share: float = SHARE, least: int = LEAST, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest found for every row
    of ``vectors`` (vec_id, embedding) for which the column ``is_query`` holds."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")).where(usable() & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim, n = (sizes["dim"], sizes["n"]) if sizes else (1, 0)
    rows = rows.where(F.size("embedding") == dim)
    fitted = bounded_rows(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding"), sample)
    x = np.array([r["embedding"] for r in fitted], dtype=np.float64).reshape(-1, dim)
    half = dim // 2
    one, two = (kmeans(x[:, :half], centres), kmeans(x[:, half:], centres)) if len(x) else (np.zeros((1, half)), np.zeros((1, dim - half)))

    index = keep(rows.select("vec_id", "embedding").mapInArrow(_cells(one, two), "vec_id long, embedding array<double>, cell int"), "index")
    held = np.zeros(len(one) * len(two), np.int64)
    counted = index.groupBy("cell").agg(F.count("*").alias("n"))
    for r in bounded_rows(counted, len(held)):
        held[r["cell"]] = r["n"]
    chunks = F.element_at(F.array(*[F.lit(int(max(1, -(-c // chunk)))) for c in held]), F.col("cell") + 1)  # a number for each cell
    enough = max(int(np.ceil(share * n)), least)
    asked = rows.where("asks").select("vec_id", "embedding").dropDuplicates(["vec_id", "embedding"])
    visits = asked.mapInArrow(_visits(one, two, held, enough), "vec_id long, embedding array<double>, cell int")
    sides = (index.select("cell", F.pmod(F.xxhash64("vec_id"), chunks).cast("int").alias("chunk"), F.lit(0).alias("side"), "vec_id", "embedding")
             .union(visits.select("cell", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(1).alias("side"), "vec_id", "embedding")))
    near = sides.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "side").mapInArrow(_search(k), "query_id long, vec_id long, score double")
    place = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
