"""Quality classifier by nearest-neighbour voting on latent-semantic vectors (dealt operator 2).

A text's features are hashed counts of its words, of word shapes (runs of capitals,
small letters and digits as one sign each, other characters as they are), of pairs of
adjacent shapes, and of immediate and later repeats of words.  Document frequencies of the features
come from all documents.  A bounded sample of labelled texts (``sample`` rows of each
label, by a fixed hash of the id) gives a truncated singular value decomposition; its
vectors, at most twice ``sample`` of ``rank`` numbers, are broadcast.  Every document is
projected, compared to all of them by exact cosine products, block by block, and its
``neighbours`` nearest vote with their similarity (to the power ``power``) times how many labelled rows each
sampled row of its label stands for.

Defined cases: null, empty and blank texts have no features and get the labelled rows'
share of label 1, as does every text when only one label (or none: 1) is known; null or
unknown labels and labels of unknown ids teach nothing; an id with several labels teaches
each; repeated rows are scored as often as they come; ties of similarity go by the sample's order;
an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_rows, give_back
from .words import chunks, hash_spans, mix, spans

FEATURES = 1 << 13
SAMPLE = 1500  # labelled rows of each label
RANK = 48
NEIGHBOURS = 15
POWER = 16
THRESHOLD = 0.3

_KIND = np.arange(256, dtype=np.uint8)
_KIND[65:91] = ord("A")
_KIND[97:123] = ord("a")
_KIND[48:58] = ord("0")
_KIND[128:] = ord("a")


def _shapes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's shape: its characters' kinds, runs of a kind as one."""
    kind = _KIND[raw]
    new = np.ones(len(raw), dtype=bool)
    new[1:] = kind[1:] != kind[:-1]
    new[starts] = True
    before = np.concatenate([[0], np.cumsum(new)])
    # a capital A would be lower-cased by the hash: shift the kinds out of its way
    return hash_spans((kind[new] ^ 0x80).astype(np.uint8), before[starts], before[ends])


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, distinct features, counts) of each text."""
    for row, raw, at in chunks(column):
        starts, ends, first = spans(raw, at)
        word, shape = hash_spans(raw, starts, ends), _shapes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            pair = mix(shape[:-1] * np.uint64(0xD6E8FEB86659FD93) + shape[1:])
        for i in range(len(at) - 1):
            lo, hi = first[i], first[i + 1]
            own = word[lo:hi]
            n = len(own)
            if not n:
                yield row + i, np.zeros(0, np.int64), np.zeros(0)
                continue
            repeats = int((own[1:] == own[:-1]).sum())
            kinds = len(np.unique(own))
            ids = np.concatenate([own & np.uint64(FEATURES // 2 - 1), (shape[lo:hi] & np.uint64(FEATURES // 4 - 1)) + np.uint64(FEATURES // 2),
                                  (pair[lo : hi - 1] & np.uint64(FEATURES // 4 - 1)) + np.uint64(FEATURES * 3 // 4)]).astype(np.int64)
            f, c = np.unique(ids, return_counts=True)
            # two of the pair features tell how much of the text repeats
            extra = np.array([FEATURES * 3 // 4 + 1, FEATURES * 3 // 4 + 2])
            f, c = np.concatenate([f, extra]), np.concatenate([c, [repeats, n - kinds if n >= 20 else 0]]).astype(np.float64)
            yield row + i, f, c / n


@dataclass
class Model:
    """What is broadcast: feature weights, the projection, and the labelled vectors."""

    idf: np.ndarray
    axes: np.ndarray  # FEATURES x RANK
    vectors: np.ndarray  # labelled rows, unit length
    votes: np.ndarray  # what each stands for
    good: np.ndarray  # its label is 1
    share: float  # of label 1 among labelled rows

    def scores(self, column: pa.Array, neighbours: int = NEIGHBOURS, power: int = POWER, block: int = 256) -> np.ndarray:
        out = np.full(len(column), self.share)
        if not len(self.vectors):
            return out
        rows, vectors = [], []

        def vote() -> None:
            z = np.array(vectors)
            norm = np.linalg.norm(z, axis=1)
            cos = (z / np.where(norm > 0, norm, 1)[:, None]) @ self.vectors.T
            k = min(neighbours, cos.shape[1])
            top = np.sort(np.argpartition(-cos, k - 1, axis=1)[:, :k], axis=1)
            weight = np.take_along_axis(cos, top, 1).clip(0) ** power * self.votes[top]
            total = weight.sum(1)
            out[rows] = np.where(total > 0, (weight * self.good[top]).sum(1) / np.where(total > 0, total, 1), self.share)

        for row, f, c in features(column):
            if len(f):
                rows.append(row)
                vectors.append(weigh(f, c, self.idf) @ self.axes[f])
                if len(rows) == block:
                    vote()
                    rows, vectors = [], []
        if rows:
            vote()
        return out.clip(0, 1)


def weigh(f: np.ndarray, c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.sqrt(c) * idf[f]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(FEATURES + 1, np.int64)  # the last counts the texts
    for batch in batches:
        for _, f, _ in features(batch.column(0)):
            n[f[: len(f) - 2]] += 1
            n[FEATURES] += 1
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["feature", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        f, c = [], []
        for _, own, counts in features(batch.column(2)):
            f.append(own.astype(np.uint16).tobytes())
            c.append(counts.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(f, pa.binary()), pa.array(c, pa.binary())],
                                         ["doc_id", "label", "f", "c"])


def in_fold(doc_id, folds: int, fold: int):
    """Whether crc32 of the id as text leaves this remainder."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label, text) of at most ``sample`` labelled ids of each label 0 and 1, by a fixed
    hash of the id, and how many ids of the table have each label.  labels: (doc_id, label)."""
    known = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).distinct()
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    counts = {r["label"]: r["n"] for r in bounded_rows(known.groupBy("label").agg(F.count("*").alias("n")), 2)}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("label = 0").orderBy(*order).limit(sample).union(known.where("label = 1").orderBy(*order).limit(sample))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most 2 * sample rows of two numbers
    return text.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text"), counts


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rank: int = RANK) -> Model:
    """The model of documents (doc_id, text) and labels (doc_id, label)."""
    counted = docs.select("text").mapInArrow(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df = np.zeros(FEATURES + 1)
    for r in bounded_rows(counted, FEATURES + 1):
        df[r["feature"]] = r["n"]
    idf = np.log((df[FEATURES] + 1) / (df[:FEATURES] + 1)) + 0.2
    idf[: FEATURES // 2] *= 0.5  # words tell less than shapes

    texts, counts = labelled_sample(docs, labels, sample)
    rows = texts.mapInArrow(_sampled, "doc_id long, label int, f binary, c binary").dropDuplicates(["doc_id", "label"])
    rows = sorted((r for r in bounded_rows(rows, 2 * sample) if len(r["f"])), key=lambda r: (r["doc_id"], r["label"]))
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 1.0
    label = np.array([r["label"] for r in rows], dtype=int)
    if len(set(label.tolist())) < 2:
        return Model(idf, np.zeros((FEATURES, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0), share)
    x = np.zeros((len(rows), FEATURES), np.float32)
    for i, r in enumerate(rows):
        f, c = np.frombuffer(bytes(r["f"]), np.uint16), np.frombuffer(bytes(r["c"]), np.float32)
        np.add.at(x[i], f, weigh(f, c, idf))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    # truncated singular value decomposition by subspace iteration from fixed random directions
    y = x @ np.random.default_rng(1).standard_normal((FEATURES, rank + 16)).astype(np.float32)
    for _ in range(3):
        y, _ = np.linalg.qr(x @ (x.T @ y))
    _, size, vt = np.linalg.svd(y.T @ x, full_matrices=False)
    axes = vt[: min(rank, int((size > 1e-6 * size[0]).sum()))].T.astype(np.float64)
    vectors = x @ axes
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    seen = {v: int((label == v).sum()) for v in (0, 1)}
    votes = np.array([counts[v] / seen[v] for v in label.tolist()])
    return Model(idf, axes, vectors / np.where(norm > 0, norm, 1), votes, (label == 1).astype(float), share)


def scorer(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """A column function text -> score (0 to 1, higher: label 1 likelier), fitted here."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = model.value
        for t in texts:
            yield pa.array(own.scores(t), pa.float64())
        give_back()

    return score
