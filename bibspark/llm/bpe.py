"""BPE encoding and decoding over a minimal acyclic transducer lexicon (dealt operator 5).

The corpus' frequent words (counted over all documents) are encoded once, compiled into a
shared-suffix transducer (``lexicon.py``), written to the shared folder and handed to the
executors as a file, which they memory-map.  A word that is not in it is merged exactly:
the adjacent pair of lowest rank, leftmost first.  The ids are those of the tokenizers
library for the same file: special strings are cut out of the raw text, the rest is
brought to NFC, white space separates, letters are lower-cased one by one, the file's
pattern cuts words, and bytes are merged with the word-end mark.  Without a decoder in
the file, decoding joins the tokens with spaces.

A block of texts is cut at white space, its distinct runs into words, and each distinct word
is worked out once per block, all as arrays.  Ids are kept as little-endian unsigned 32-bit integers.

Defined cases: a null text is empty, an empty text has no ids and decodes to ""; repeated
rows are returned as often as they come; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import heapq
import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lexicon import Lexicon, compile_lexicon
from .shared import bounded_rows, fresh_path, give_back, keep
from .words import chunks, hash_spans, hash_word, mix, spans, text_buffers

FREQUENT = 65_536  # words in the lexicon at most
LONG = 48  # bytes of a word that is merged on its own
_NONE = 1 << 40  # the rank of what is no pair
MEMO = 150_000  # words that a task counts before it puts them out
OUT_BYTES = 1 << 18  # of texts that are worked on and put out together

_DIGIT = 2
_KIND = np.zeros(256, np.uint8)  # of an ASCII character: letter, digit or neither
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = _DIGIT
_ODD = np.zeros(256, bool)  # characters whose run the pattern cuts
_ODD[128:] = True
_ODD[[ord("'"), ord("|")]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)]


def lower(text: str) -> str:
    """Lower case letter by letter; str.lower alone looks at a capital sigma's place in the word."""
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


def spread(block: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of a block one after another, and where each ends there."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return block[np.repeat(low - (ends - size), size) + np.arange(total)], ends


class Cut(NamedTuple):
    """A block of texts in words: the distinct words (spans of ``block``, by hash), the distinct runs between
    white space (``n_words`` places in ``which`` from ``run_low``), and the texts (runs by ``place``, bounded by ``first``)."""

    block: np.ndarray
    low: np.ndarray
    size: np.ndarray
    hash: np.ndarray
    which: np.ndarray
    run_low: np.ndarray
    n_words: np.ndarray
    place: np.ndarray
    first: np.ndarray


class Bpe:
    """The model of a tokenizer file: byte-level BPE with a word-end suffix, lower case."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if (model["type"], kinds, split["type"], spec["decoder"]) != ("BPE", ["NFC", "Replace", "Lowercase"], "Split", None):
            raise ValueError("not a word-end byte-level BPE file")
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair if isinstance(pair, list) else pair.split(" ")): i for i, pair in enumerate(model["merges"])}
        self.suffix: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.chars = byte_chars()
        self.cut = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        single = {c for c in self.chars} | {c + self.suffix for c in self.chars}
        if not single <= self.ids.keys() or max(self.ids.values()) >= 1 << 16:
            raise ValueError("every byte must be a token, and ids fit 16 bits")
        self.inner = np.array([self.ids[c] for c in self.chars], np.int64)
        self.ending = np.array([self.ids[c + self.suffix] for c in self.chars], np.int64)
        table = sorted((self.ids[a] << 16 | self.ids[b], r, self.ids[a + b]) for (a, b), r in self.ranks.items())
        self.pairs, self.pair_ranks, self.merged = (np.array(x, np.int64) for x in zip(*table, strict=True))
        names = {**{i: t for t, i in self.ids.items()}, **{i: t for t, i in self.special.items()}}
        said = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]  # every id has a token in such a file
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.said_size = np.array([len(x) for x in said], np.int64)
        self.said_low = np.cumsum(self.said_size) - self.said_size
        self.special_hash = np.array([hash_word(t.encode()) for t in self.special], np.uint64)
        self.special_ids = np.array(list(self.special.values()), np.int64)

    def words(self, run: str) -> list[str]:
        """The words of a run without white space, normalised; special strings as they are."""
        if run.isascii() and "<|" not in run:
            return [run.lower()] if run.isalpha() else self.cut.findall(run.lower())
        if "<|" not in run:
            return self.cut.findall(lower(unicodedata.normalize("NFC", run)))
        out: list[str] = []
        for part in self.marks.split(run) if self.marks else [run]:
            if part in self.special:
                out.append(part)
            else:
                out += self.cut.findall(lower(unicodedata.normalize("NFC", part)))
        return out

    def merge(self, word: str) -> list[int]:
        """The ids of one word by exact merging: lowest rank first, leftmost of equal rank."""
        parts = [self.chars[b] for b in word.encode("utf-8", "surrogatepass")]
        parts[-1] += self.suffix
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        queue = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = a + b, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if y < n and (r := self.ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(queue, (r, x, parts[x], parts[y]))
        return [self.ids[p] for p, here in zip(parts, alive, strict=True) if here and p in self.ids]

    def looked_up(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of the pair that begins at each of these places, and what it merges to."""
        at_next = np.minimum(at + 1, len(ids) - 1)
        key = ids[at] << 16 | ids[at_next]
        i = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        pair = (self.pairs[i] == key) & (word[at_next] == word[at]) & (at_next > at)
        return np.where(pair, self.pair_ranks[i], _NONE), self.merged[i]

    def merge_all(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many words (spans of bytes) at once: each step merges the pair of lowest rank,
        leftmost, in every word.  The ids of all words in their order, and how many each has."""
        long = np.flatnonzero(size > LONG)
        parts = []  # finished words: (their number, their ids)
        for i in long.tolist():
            own = self.merge(raw[start[i] : start[i] + size[i]].tobytes().decode("utf-8", "surrogatepass"))
            parts.append((np.full(len(own), i), np.array(own, np.int64)))
        live = np.flatnonzero((size > 0) & (size <= LONG))
        block, ends = spread(raw, start[live], size[live])
        ids, word = self.inner[block], np.repeat(live, size[live])
        ids[ends - 1] = self.ending[block[ends - 1]]
        rank, new = self.looked_up(ids, word, np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(ids))))
            done = best == _NONE
            if done.any():
                parts.append((word[done], ids[done]))
            hit = np.flatnonzero((rank == best) & ~done)
            hit = hit[np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])] if len(hit) else hit
            ids[hit] = new[hit]
            beside = np.zeros(len(ids), bool)
            beside[hit] = beside[hit - 1] = True
            stay = ~done
            stay[hit + 1] = False
            ids, word, rank, new, beside = ids[stay], word[stay], rank[stay], new[stay], beside[stay]
            at = np.flatnonzero(beside)
            if len(at):
                rank[at], new[at] = self.looked_up(ids, word, at)
        if not parts:
            return np.zeros(0, np.int64), np.zeros(len(size), np.int64)
        word, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        return ids[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(size))

    def cut_runs(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words of runs without white space: a block of bytes, each word's start and size in it, and
        how many words each run has.  A word of plain ASCII is a stretch of letters, one digit, or a stretch of
        anything else; the pattern cuts runs with other characters, an apostrophe or a special string.
        Special strings come as words with their own spelling."""
        n_odd = np.concatenate([[0], np.cumsum(_ODD[raw])])
        odd = n_odd[ends] > n_odd[starts]
        plain = np.flatnonzero(~odd)
        block, bounds = spread(raw, starts[plain], (ends - starts)[plain])
        kind, run = _KIND[block], np.repeat(plain, (ends - starts)[plain])
        begins = np.ones(len(block), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | (run[1:] != run[:-1])
        low = np.flatnonzero(begins)
        size = np.diff(np.append(low, len(block)))
        odd = np.flatnonzero(odd)
        pieces, counts, text = [], [], raw.tobytes()
        for lo, hi in zip(starts[odd].tolist(), ends[odd].tolist(), strict=True):
            words = self.words(text[lo:hi].decode("utf-8", "replace"))
            counts.append(len(words))
            pieces += words
        pieces = [w.encode("utf-8", "surrogatepass") for w in pieces]
        more = np.array([len(w) for w in pieces], np.int64)
        run = np.concatenate([run[low], np.repeat(odd, np.array(counts, np.int64))])
        low = np.concatenate([low, len(block) + np.cumsum(more) - more])
        size = np.concatenate([size, more])
        order = np.argsort(run, kind="stable")
        block = np.concatenate([_LOWER[block], np.frombuffer(b"".join(pieces), np.uint8)])
        return block, low[order], size[order], np.bincount(run, minlength=len(starts))

    def words_of(self, raw: np.ndarray, at: np.ndarray) -> Cut:
        """The distinct words of a block of texts, and where they stand."""
        starts, ends, first = spans(raw, at)
        if len(starts):
            h = hash_spans(raw, starts, ends)
            mark = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
            if len(mark):  # special strings keep their case: such a run is only like itself
                alone = np.unique(np.searchsorted(starts, mark, side="right") - 1)
                h[alone] = mix(alone.astype(np.uint64) + np.uint64(1 << 40))
            _, one, place = np.unique(h, return_index=True, return_inverse=True)
        else:
            one = place = np.zeros(0, np.int64)
        block, low, size, n_words = self.cut_runs(raw, starts[one], ends[one])
        h, word, which = np.unique(hash_spans(block, low, low + size), return_index=True, return_inverse=True)
        return Cut(block, low[word], size[word], h, which, np.cumsum(n_words) - n_words, n_words, place, first)

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts that bounded stretches of ids decode to, in one block, and their bounds there."""
        said, ends = spread(self.said, self.said_low[ids], self.said_size[ids])
        bounds = np.concatenate([[0], ends])[bounds]
        full = np.diff(bounds) > 0  # the space after a text's last token goes
        stay = np.ones(len(said), bool)
        stay[bounds[1:][full] - 1] = False
        return said[stay], bounds - np.concatenate([[0], np.cumsum(full)])


@lru_cache(maxsize=1)
def _bpe(content: str) -> Bpe:
    """The model, built once a worker."""
    return Bpe(content)


def _column(data: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def without_gc(run):
    """A batch function that runs with the cycle collector off: its memo has no cycles, and walking it costs more than it frees."""
    def quiet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()
            give_back()

    return quiet


def frequent_words(docs: DataFrame, model, most: int = FREQUENT) -> dict[bytes, list[int]]:
    """The most frequent words of all texts, at most ``most``, and their ids: all words whose count
    reaches the least eighth of a power of two that so few reach."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = _bpe(model.value), Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return batch

        for batch in batches:
            for _, raw, at in chunks(batch.column(0), OUT_BYTES):
                cut = bpe.words_of(raw, at)
                uses = np.repeat(np.bincount(cut.place, minlength=len(cut.n_words)), cut.n_words)
                n = np.bincount(cut.which, weights=uses, minlength=len(cut.low)).astype(np.int64)
                n[np.isin(cut.hash, bpe.special_hash)] = 0
                block = cut.block.tobytes()
                for low, size, own in zip(cut.low.tolist(), cut.size.tolist(), n.tolist(), strict=True):
                    if own:
                        seen[block[low : low + size]] += own
                if len(seen) > MEMO:
                    yield out()
        yield out()

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(model.value)
        for batch in batches:
            raw, at = text_buffers(batch.column(0))
            flat, size = bpe.merge_all(raw, at[:-1], np.diff(at))
            own = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), own], ["word", "ids"])

    counted = docs.select("text").mapInArrow(without_gc(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = keep(counted.withColumn("step", F.floor(F.log2("n") * 8).cast("int")), "counts")
    steps = sorted(((r["step"], r["n"]) for r in bounded_rows(counted.groupBy("step").agg(F.count("*").alias("n")), 1024)), reverse=True)
    reach, held = 1 << 20, 0
    for step, n in steps:
        held += n
        if held > most:
            break
        reach = step
    chosen = counted.where(F.col("step") >= reach).select("word").mapInArrow(ids, "word string, ids array<int>")
    return {r["word"].encode("utf-8", "surrogatepass"): r["ids"] for r in bounded_rows(chosen, most)}


def put_file(spark: SparkSession, content: bytes, name: str) -> str:
    """Write a small file to the shared folder and register it with Spark; its name there."""
    path = fresh_path(spark, name)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encoded(docs: DataFrame, tokenizer: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, the ids of the whole text (binary) and the text they decode to."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    model = spark.sparkContext.broadcast(content)
    name = put_file(spark, compile_lexicon(frequent_words(docs, model, frequent)), "lexicon")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lexicon = _bpe(model.value), Lexicon(SparkFiles.get(name))

        def ids_of(cut: Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Each distinct word's ids: a block of ids, where each word's begin and how many they are."""
            rank = lexicon.span_ranks(cut.block, cut.low, cut.size)
            known, size = lexicon.flat_tokens(rank)
            special = np.flatnonzero(np.isin(cut.hash, bpe.special_hash))
            rest = np.flatnonzero(rank < 0)
            merged, own = bpe.merge_all(cut.block, cut.low[rest], cut.size[rest])
            low = np.cumsum(size) - size
            size[rest], low[rest] = own, len(known) + np.cumsum(own) - own
            own = [bpe.special_ids[np.flatnonzero(bpe.special_hash == h)[:1]] for h in cut.hash[special]]
            size[special], low[special] = 1, len(known) + len(merged) + np.arange(len(special))
            return np.concatenate([known, merged, *own]), low, size

        for batch in batches:
            for row, raw, at in chunks(batch.column(1), OUT_BYTES):
                cut = bpe.words_of(raw, at)
                ids, low, size = ids_of(cut)
                ids, ends = spread(ids, low[cut.which], size[cut.which])  # of the distinct runs
                ends = np.concatenate([[0], ends])
                low, high = ends[cut.run_low], ends[cut.run_low + cut.n_words]
                ids, ends = spread(ids, low[cut.place], (high - low)[cut.place])  # of the texts
                bounds = np.concatenate([[0], ends])[cut.first]
                said, said_bounds = bpe.decoded(ids, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(at) - 1), _column(ids.astype("<u4"), 4 * bounds, pa.binary()),
                     _column(said, said_bounds, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.mapInArrow(without_gc(run), "doc_id long, ids binary, decoded string")


def digests(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
