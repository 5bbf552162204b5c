"""Cross-tokenizer alignment by pointer jumping (dealt operator 13).

Two tokenizers cut the same bytes.  Every token points to the farthest-right token that overlaps
it (itself, if none ends later; of two that end together, the one of tokenizer A), and successors
are doubled, ``to = to[to]``, as arrays over a block of texts until nothing moves: every token
then points to the last token of its component, which labels its group.  A group ends where
tokens of both sides end together; those two are linked.

Corpus-wide, links are counted by pair of ids, after each text has counted its own, and a pair is best
if no other pair of its B id comes more often.  Texts get their pairs' counts by a join that Spark
plans by size; the tokens themselves are not shuffled.

Tokenizer A reads a space and the text by byte-level BPE (the file's vocabulary as ranks, by the
tiktoken library, which cuts as the tokenizers library does), B the text by sentencepiece, which adds
the space.  Special tokens are plain text to both.

Defined cases: null and empty texts, and texts whose tokens of A or B do not join to the space and the
text (an U+2581 or what B normalises away, say), have no tokens and zeros; repeated rows are returned
as often as they come; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_chars, spread
from .shared import keep
from .words import chunks

BLOCK = 1 << 18  # bytes of text that are worked on together, or one longer text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: that of the byte-level pre-tokenizer
_B_BITS = 20  # of a packed pair of ids


class Reader:
    """A tokenizer: ``encode`` of texts to ids, and every id's bytes."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode = encode
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.low = np.cumsum(self.size) - self.size
        self.said = np.frombuffer(b"".join(pieces), np.uint8)


def byte_reader(content: str) -> Reader:
    """Byte-level BPE of a tokenizers file, without its added tokens."""
    import tiktoken

    spec = json.loads(content)
    model, cut = spec["model"], spec["pre_tokenizer"]
    if (model["type"], cut["type"], cut["add_prefix_space"], spec["normalizer"]) != ("BPE", "ByteLevel", False, None):
        raise ValueError("not a byte-level BPE file")
    added = {t["content"] for t in spec["added_tokens"]}
    byte = {c: i for i, c in enumerate(byte_chars())}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(made):
        raise ValueError("ids must come in the order of the merges")
    encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    return Reader(lambda texts: [encoding.encode_ordinary(" " + t) for t in texts], pieces)


def piece_reader(content: bytes) -> Reader:
    """A sentencepiece model; it writes a space as U+2581 and adds one before the text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(names)]
    return Reader(lambda texts: model.encode(texts, num_threads=1), pieces)


@lru_cache(maxsize=1)
def _readers(a: str, b: bytes) -> tuple[Reader, Reader]:
    """Both tokenizers, built once a worker."""
    return byte_reader(a), piece_reader(b)


class Groups(NamedTuple):
    """The groups of a block: of each token its group's number, and the last token of A and of B in each."""

    of_a: np.ndarray
    of_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray


def grouped(a_ends: np.ndarray, b_ends: np.ndarray) -> Groups:
    """The groups of tokens that end at these ascending offsets, the last of both at the same."""
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)  # the B token that holds A's last byte ends last of those that overlap it
    over_b = np.searchsorted(a_ends, b_ends)
    to = np.concatenate([np.where(b_ends[over_a] > a_ends, n + over_a, np.arange(n)), over_b]) if n else np.zeros(0, np.int64)
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    last_a = np.unique(to)
    group = np.searchsorted(last_a, to)
    return Groups(group[:n], group[n:], last_a, np.searchsorted(b_ends, a_ends[last_a]))


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids one after another, and how many each text has."""
    size = np.array([len(x) for x in ids], np.int64)
    return np.fromiter((i for x in ids for i in x), np.int64, int(size.sum())), size


def _joined(reader: Reader, ids: np.ndarray, size: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which texts their tokens join to."""
    said, ends = spread(reader.said, reader.low[ids], reader.size[ids])
    bounds = np.concatenate([[0], np.concatenate([[0], ends])[np.cumsum(size)]]).tolist()
    said = said.tobytes()
    return np.array([said[lo:hi] == b" " + t for lo, hi, t in zip(bounds[:-1], bounds[1:], texts, strict=True)], bool)


@lru_cache(maxsize=1)
def _digits() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The decimal numbers below 2^16, each with room for a separator."""
    said = [b"%d," % i for i in range(1 << 16)]
    size = np.array([len(x) for x in said], np.int64)
    return np.frombuffer(b"".join(said), np.uint8), np.cumsum(size) - size, size


def written(a: np.ndarray, b: np.ndarray, groups: Groups, digits) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text, ``a1,a2|b1;``, one after another, and where each ends."""
    n_a, n_b = np.bincount(groups.of_a), np.bincount(groups.of_b)
    before_a, before_b = np.cumsum(n_a), np.cumsum(n_b)
    ids = np.empty(len(a) + len(b), np.int64)
    place_a = np.arange(len(a)) + (before_b - n_b)[groups.of_a]
    place_b = np.arange(len(b)) + before_a[groups.of_b]
    ids[place_a], ids[place_b] = a, b
    said, low, size = digits
    out, ends = spread(said, low[ids], size[ids])
    last = place_b[groups.last_b]
    out[ends[place_a[groups.last_a]] - 1] = ord("|")
    out[ends[last] - 1] = ord(";")
    return out, ends[last]


def _aligned(a_file, b_file):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _readers(a_file.value, b_file.value)
        digits = _digits()
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, raw, at in chunks(batch.column(1), BLOCK):
                n = len(at) - 1
                yield _block(batch.column(0).slice(row, n), np.arange(row_id, row_id + n), raw, at, one, two, digits)
                row_id += n

    return run


def _block(doc_ids: pa.Array, row_ids: np.ndarray, raw: np.ndarray, at: np.ndarray, one: Reader, two: Reader, digits) -> pa.RecordBatch:
    n, block = len(doc_ids), raw.tobytes()
    here = [i for i in range(n) if at[i + 1] > at[i]]
    texts = [block[at[i] : at[i + 1]] for i in here]
    said = [t.decode() for t in texts]
    a, size_a = _flat(one.encode(said))
    b, size_b = _flat(two.encode(said))
    good = _joined(one, a, size_a, texts) & _joined(two, b, size_b, texts)
    a, b = a[np.repeat(good, size_a)], b[np.repeat(good, size_b)]
    rows = np.array(here, np.int64)[good]
    size_a, size_b = size_a[good], size_b[good]
    groups = grouped(np.cumsum(one.size[a]), np.cumsum(two.size[b]))
    first_a = np.cumsum(size_a) - size_a
    n_groups = np.diff(np.append(groups.of_a[first_a], len(groups.last_a))) if len(rows) else np.zeros(0, np.int64)
    text, ends = written(a, b, groups, digits)
    ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_groups)])].tolist()
    text = text.tobytes()
    digest = [""] * n
    for i, lo, hi in zip(rows.tolist(), ends[:-1], ends[1:], strict=True):
        digest[i] = hashlib.sha256(text[lo : hi - 1]).hexdigest()
    # a text's distinct pairs, and how often it links each
    pair = a[groups.last_a] << _B_BITS | b[groups.last_b]
    owner = np.repeat(rows, n_groups)
    order = np.lexsort((pair, owner))
    pair, owner = pair[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])])) if len(pair) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(pair)))
    bounds = pa.array(np.searchsorted(owner[new], np.arange(n + 1)).astype(np.int32))

    def per_row(values: np.ndarray) -> pa.Array:
        out = np.zeros(n, np.int64)
        out[rows] = values
        return pa.array(out)

    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(row_ids), per_row(size_a), per_row(size_b), per_row(n_groups), pa.array(digest),
         pa.ListArray.from_arrays(bounds, pa.array(pair[new])), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int64)))],
        ["doc_id", "row_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:  # two files of fixed size
        a_file, b_file = context.broadcast(f.read()), context.broadcast(g.read())
    texts = keep(docs.mapInArrow(_aligned(a_file, b_file), "doc_id long, row_id long, n_a long, n_b long, n_groups long, "
                                 "groups_sha256 string, pairs array<long>, times array<long>"), "aligned")
    a_file.destroy()
    b_file.destroy()
    held = texts.select("row_id", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row_id", "x.pairs", "x.times")
    counts = keep(held.groupBy("pairs").agg(F.sum("times").alias("n")), "pairs")
    b_id = F.col("pairs").bitwiseAND((1 << _B_BITS) - 1)
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))  # one row a B id: as many as its vocabulary at most
    counts = counts.join(F.broadcast(most), b_id == F.col("b")).select(F.col("pairs").alias("pair"), "n", (F.col("n") == F.col("most")).alias("best"))
    sums = (held.join(counts, F.col("pairs") == F.col("pair")).groupBy(F.col("row_id").alias("of"))
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    out = texts.drop("pairs", "times").join(sums, F.col("row_id") == F.col("of"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
