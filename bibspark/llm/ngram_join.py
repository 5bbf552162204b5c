"""N-gram Jaccard join by vertical partitioning (dealt operator 1).

A document's set holds the hashes of its distinct k-word shingles.  All shingles have
one global order: by how often their bucket of a fixed-size count table is hit over the
whole corpus, then by hash, so rare shingles come first.  Pivots cut that order into
fragments; a set is cut into segments along them, overlaps are counted segment by
segment, and a pair's overlap is the sum over its segments.

Which pairs are counted: sets of a size that can reach the threshold and that share one
of their first shingles in the global order (the prefix filter, exact for any order).
Equal sets are one class from the start.  A posting list is never expanded into all its
pairs: first each set meets its neighbour and the first set of the list, the links found
so are joined into components, and then only pairs whose components still differ are
counted.  A pair inside a component cannot change it, so the components are those of the
full join, and no cap or sample is involved.

Classes and shingles are 64-bit hashes; among n documents two different sets share a
class with a chance of about n^2 / 2^65.

Defined cases: null, empty or blank text has an empty set, no links, and itself as its
component; a text of fewer than k words has its whole sequence as its one shingle;
repeated rows are returned as often as they come; rows without a doc_id take part and
have the smallest doc_id of their component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import bounded_rows, components, giving_back, keep
from .words import distinct_shingles, mix

BUCKETS = 1 << 20  # of the count table: 4 MB whatever the corpus
SLICE = 1 << 16
FRAGMENTS = 8
WANTED = 1 << 24  # bits of the map of documents whose segments are wanted: 2 MB whatever their number


def _class(sets: np.ndarray) -> int:
    """A 63-bit class of a sorted set; equal sets have equal classes."""
    with np.errstate(over="ignore"):
        x = mix(np.add.reduce(mix(sets)) + np.uint64(len(sets))) ^ np.bitwise_xor.reduce(mix(sets ^ np.uint64(0x5851F42D4C957F2D)))
    return int(mix(np.array([x], np.uint64))[0] >> np.uint64(1))


def _summaries(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.uint32)
        for batch in batches:
            ids, sizes, classes = batch.column(0), [], []
            for _, own in distinct_shingles(batch.column(1), k):
                sizes.append(len(own))
                classes.append(_class(own) if len(own) else None)
                np.add.at(counts, (own >> np.uint64(44)).astype(np.int64), 1)
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], ["doc_id", "n", "cls", "slice", "counts"])
        if counts.any():
            parts = range(0, BUCKETS, SLICE)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64()), pa.nulls(len(parts), pa.int64()),
                 pa.array([p // SLICE for p in parts], pa.int32()),
                 pa.array([counts[p : p + SLICE].tobytes() for p in parts], pa.binary())],
                ["doc_id", "n", "cls", "slice", "counts"])

    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, c in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = np.frombuffer(c.as_buffer(), np.uint32)
            total[s] = np.minimum(total[s].astype(np.uint64) + own, 0xFFFFFFFF).astype(np.uint32) if s in total else own.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())],
                                         ["slice", "counts"])


def _least(n, percent: int):
    """The smallest overlap that a set of size n can have with a linked one."""
    return (percent * n + 99) // 100


def _prefixes(k: int, percent: int, counts):
    """Postings (shingle, class, size, position) of each set's prefix, and of what follows it as far as a
    shingle in a linked set's prefix can stand, once per class and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = counts.value, set()
        for batch in batches:
            out = []
            for _, own in distinct_shingles(batch.column(0), k):
                n = len(own)
                if not n or (c := _class(own)) in seen:
                    continue
                if len(seen) < 1_000_000:  # a repeat that is sent twice is harmless
                    seen.add(c)
                # a shingle in a set's prefix that a linked set also has stands within this many of the other's first
                m = min(n, n * (100 - percent) * (100 + percent) // (100 * percent) + 2)
                rank = often[(own >> np.uint64(44)).astype(np.int64)]
                if m < n:
                    cut = np.partition(rank, m - 1)[m - 1]
                    near = np.flatnonzero(rank <= cut)
                else:
                    near = np.arange(n)
                first = near[np.lexsort((own[near], rank[near]))][:m]
                out.append((own[first], c, n, m))
            if out:
                sizes = np.array([m for *_, m in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([o[0] for o in out]).view(np.int64)),
                     pa.array(np.repeat(np.array([o[1] for o in out], np.int64), sizes)),
                     pa.array(np.repeat(np.array([o[2] for o in out], np.int32), sizes)),
                     pa.array(np.concatenate([np.arange(m, dtype=np.int32) for m in sizes]))], ["tok", "cls", "n", "pos"])

    return run


def _bit(doc_id):
    """A document's place in the bitmap of wanted documents."""
    return F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(-1))), F.lit(WANTED)).cast("int")


def _bitmap(ids: DataFrame) -> np.ndarray:
    """The bitmap of these doc_ids: WANTED bits, whatever their number."""
    words = ids.select(_bit(F.col("doc_id")).alias("bit")).groupBy((F.col("bit") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("bits"))
    got = words.toArrow()  # at most WANTED / 64 rows of two numbers
    out = np.zeros(WANTED // 64, np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint8)


def _segments(k: int, counts, pivots, wanted):
    """(class, fragment, segment) of each wanted text: its set cut along the pivots of the global order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, cut, seen = counts.value, pivots, set()
        for batch in batches:
            cls, frag, seg = [], [], []
            bit = batch.column(0).to_numpy()
            chosen = (wanted.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
            for _, own in distinct_shingles(batch.column(1).filter(pa.array(chosen.astype(bool))), k):
                if not len(own) or (c := _class(own)) in seen:
                    continue
                if len(seen) < 1_000_000:  # a repeat that is sent twice is harmless
                    seen.add(c)
                part = np.searchsorted(cut, _place(often, own), side="right")
                for f in np.unique(part):
                    cls.append(c)
                    frag.append(int(f))
                    seg.append(own[part == f].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(frag, pa.int32()), pa.array(seg, pa.list_(pa.int64()))],
                                             ["cls", "frag", "seg"])

    return run


def _place(often: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Places in the global order: by the count of the shingle's bucket, then by bucket, the hash's first bits."""
    bucket = shingles >> np.uint64(44)
    return often[bucket.astype(np.int64)].astype(np.uint64) << np.uint64(20) | bucket


def _pivots(often: np.ndarray, fragments: int) -> np.ndarray:
    """Places at which the global order is cut, so that fragments hold about equally many shingles."""
    place = np.sort(_place(often, np.flatnonzero(often).astype(np.uint64) << np.uint64(44)))
    if not len(place):
        return place
    reach = np.cumsum(place >> np.uint64(20))
    at = [int(np.searchsorted(reach, reach[-1] * f // fragments)) for f in range(1, fragments)]
    return np.unique(place[at])


def _linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int, percent: int, counts, pivots) -> DataFrame:
    """Those of the pairs (a, b, na, nb) that reach the threshold: overlaps counted by fragment, then summed."""
    nodes = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    ids = reps.join(nodes, "cls", "left_semi").select(F.col("rep").alias("doc_id"))
    # texts stay where they are: a document that the map names by chance only adds segments that no pair asks for
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))
    segs = docs.select(_bit(F.col("doc_id")).alias("bit"), "text").mapInArrow(
        giving_back(_segments(k, counts, pivots, wanted)), "cls long, frag int, seg array<long>")
    # copies have one class: one row of each class and fragment meets the pairs, however many documents have it
    segs = keep(segs.repartition("cls").dropDuplicates(["cls", "frag"]), "segments")
    wanted.destroy()
    left = segs.select(F.col("cls").alias("a"), "frag", F.col("seg").alias("sa"))
    right = segs.select(F.col("cls").alias("b"), "frag", F.col("seg").alias("sb"))
    partial = (pairs.join(left, "a").join(right, ["b", "frag"])
               .select("a", "b", "na", "nb", "frag", F.size(F.array_intersect("sa", "sb")).alias("part")))
    return (partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("common"))
            .where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("common"))))


def _possible(a: str, b: str, percent: int):
    """Whether two rows (structs of n, pos, free) of a list can be a link: by size, because the overlap is at most
    one plus what follows the shared shingle on either side, and at most what is not in one set alone."""
    row = lambda x, f: F.col(f"{x}.{f}").cast("long")
    most = F.least(row(a, "n") - row(a, "pos"), row(b, "n") - row(b, "pos"), row(a, "free"), row(b, "free"))
    a, b = row(a, "n"), row(b, "n")
    return ((F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b))
            & (F.lit(100 + percent) * most >= F.lit(percent) * (a + b)))


def ngram_components(docs: DataFrame, k: int = 4, percent: int = 85, fragments: int = FRAGMENTS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles and component_id, the smallest doc_id
    that links of Jaccard similarity >= percent / 100 between k-word shingle sets reach."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = keep(docs.mapInArrow(giving_back(_summaries(k)), "doc_id long, n long, cls long, slice int, counts binary"), "sets")
    sets = first.where("slice IS NULL").select("doc_id", "n", "cls")
    parts = first.where("slice IS NOT NULL").select("slice", "counts")
    summed = parts.mapInArrow(_add_counts, parts.schema).repartition(BUCKETS // SLICE, "slice").mapInArrow(_add_counts, parts.schema)
    often = np.zeros(BUCKETS, np.uint32)
    for r in bounded_rows(summed, BUCKETS // SLICE):
        often[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(bytes(r["counts"]), np.uint32)
    counts, pivots = spark.sparkContext.broadcast(often), _pivots(often, fragments)

    reps = keep(sets.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep")), "classes")
    found = docs.select("text").mapInArrow(giving_back(_prefixes(k, percent, counts)), "tok long, cls long, n int, pos int")
    lists = W.partitionBy("tok").orderBy("n", "cls")
    # equal neighbours on a list are one class; lists of one class link nothing and go
    shared = keep(found.withColumn("prev", F.lag("cls").over(lists)).withColumn("next", F.lead("cls").over(lists))
                  .where("(prev IS NULL AND next IS NOT NULL) OR prev <> cls").drop("prev", "next"), "postings")
    # of a set and a linked one all can be shared but those shingles of its prefix that no other class has as far down as
    # the postings reach
    least = F.ceil(F.col("n").cast("long") * percent / 100).cast("int")
    shared = shared.where(F.col("pos") <= F.col("n") - least)
    support = shared.groupBy("cls").agg(F.count("*").alias("met"))
    free = least - 1 + F.col("met")
    shared = keep(shared.join(support, "cls").select("tok", F.struct("cls", "n", "pos", free.alias("free")).alias("row")), "postings")
    # first pairs: neighbours by size, and all with the set that has least of its own
    near = W.partitionBy("tok").orderBy("row.n", "row.cls")
    hub = F.max(F.struct(F.col("row.free") - F.col("row.n"), F.col("row.cls"), F.col("row.n"), F.col("row.pos"), F.col("row.free"))).over(W.partitionBy("tok"))
    first_pairs = (shared.withColumn("prev", F.lag("row").over(near)).withColumn("hub", hub)
                   .select("row", F.explode(F.array("prev", F.struct("hub.cls", "hub.n", "hub.pos", "hub.free"))).alias("other"))
                   .where("other IS NOT NULL AND other.cls <> row.cls"))
    pairs = keep(_ordered(first_pairs, percent), "pairs")
    links = keep(_linked(pairs, docs, reps, k, percent, counts, pivots).select("a", "b"), "links")
    comp = keep(components(links, "a", "b"), "components")

    # what is left: sets on one list whose components differ
    rows = shared.join(comp.withColumnRenamed("node", "cls"), F.col("row.cls") == F.col("cls"), "left").select(
        "tok", "row", F.coalesce("component", "row.cls").alias("comp"))
    mixed = rows.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("tok")
    rows = keep(rows.join(mixed, "tok", "left_semi"), "mixed")
    # first which kinds of rows (size, most that can be shared) can meet at all, then which components have such
    # rows, and only then which rows: nothing is paired that the bounds rule out or that is joined already
    kind, cap = ["tok", "n", "cap"], F.least(F.col("row.n") - F.col("row.pos"), F.col("row.free"))
    rows = rows.select("tok", F.col("row.n").alias("n"), cap.alias("cap"), "comp", F.col("row.cls").alias("cls"))
    holders = rows.select(*kind, "comp").distinct()
    kinds = holders.select(*kind).distinct()

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*[F.col(c).alias(c if c == "tok" else c + mark) for c in df.columns])

    na, nb = F.col("n1").cast("long"), F.col("n2").cast("long")
    can = ((F.lit(100) * F.least(na, nb) >= F.lit(percent) * F.greatest(na, nb))
           & (F.lit(100 + percent) * F.least("cap1", "cap2").cast("long") >= F.lit(percent) * (na + nb)))
    met = (side(kinds, "1").join(side(kinds, "2"), "tok").where(can & (F.struct("n1", "cap1") <= F.struct("n2", "cap2")))
           .join(side(holders, "1"), ["tok", "n1", "cap1"]).join(side(holders, "2"), ["tok", "n2", "cap2"]).where("comp1 <> comp2")
           .join(side(rows, "1"), ["tok", "n1", "cap1", "comp1"]).join(side(rows, "2"), ["tok", "n2", "cap2", "comp2"]))
    rest = met.select(F.least("cls1", "cls2").alias("a"), F.greatest("cls1", "cls2").alias("b"),
                      F.when(F.col("cls1") < F.col("cls2"), na).otherwise(nb).alias("na"), F.when(F.col("cls1") < F.col("cls2"), nb).otherwise(na).alias("nb"))
    rest = keep(rest.distinct().join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    more = _linked(rest, docs, reps, k, percent, counts, pivots).select("a", "b")
    for end in ("a", "b"):  # links between components found so far
        more = more.join(comp.select(F.col("node").alias(end), F.col("component").alias(f"{end}c")), end, "left").withColumn(end, F.coalesce(f"{end}c", end)).drop(f"{end}c")
    joined = components(more, "a", "b").select(F.col("node").alias("comp"), F.col("component").alias("joined"))
    comp = reps.join(comp.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", F.coalesce("component", "cls").alias("comp"))
    comp = keep(comp.join(joined, "comp", "left").select("cls", "rep", F.coalesce("joined", "comp").alias("comp")), "components")
    least = comp.groupBy("comp").agg(F.min("rep").alias("component_id"))
    known = comp.join(least, "comp").select("cls", "component_id")
    return (sets.join(known, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def _ordered(found: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs a < b of possible links, from rows (row, other)."""
    a_first = F.col("row.cls") < F.col("other.cls")
    pick = lambda f, x, y: F.when(a_first, F.col(f"{x}.{f}")).otherwise(F.col(f"{y}.{f}"))
    return (found.where(_possible("row", "other", percent) & (F.col("row.cls") != F.col("other.cls")))
            .select(pick("cls", "row", "other").alias("a"), pick("cls", "other", "row").alias("b"),
                    pick("n", "row", "other").cast("long").alias("na"), pick("n", "other", "row").cast("long").alias("nb"))
            .distinct())
