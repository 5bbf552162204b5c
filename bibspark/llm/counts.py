"""Token counts by count-only Viterbi (dealt operator 10).

The vocabulary is read as a unigram model: pieces with their stored scores.  An
Aho-Corasick automaton lists every piece that ends at each character; the dynamic
programme keeps for each position only the best score and how many pieces it takes.
Ties and unknown characters go by the rules of the tokenizer libraries' unigram models:
of equal scores the piece that begins first stays; a character that is no piece costs
the least score of the vocabulary less 10 and falls back to its UTF-8 bytes, one piece each.

A text is ``U+2581`` + text with every space as ``U+2581``.  When no piece holds that
mark after another character (checked at load), the best path passes through every
word boundary, so words are segmented once and remembered (a bounded memo per task).

Defined cases: null and empty text count 0; other columns are ignored; repeated rows are
returned as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MEMO = 400_000  # words that a task remembers before it starts afresh
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def load_pieces(path: str) -> tuple[tuple[str, float], ...]:
    """The pieces that texts can match and their scores, in id order; control strings, the
    unknown piece and the byte pieces are no text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    text = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in text)


class Segmenter:
    """Piece counts and best scores of words, remembered."""

    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - 10
        self.by_word = not any(MARK in piece.lstrip(MARK) for piece, _ in pieces)
        self.known: dict[str, tuple[int, float]] = {}

    def segment(self, word: str) -> tuple[int, float]:
        n = len(word)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        done = 0  # positions up to here have their best path

        def unknown(end: int, best: float | None, pieces: int) -> None:
            other = score[end - 1] + self.unknown
            if best is None or other > best:
                best, pieces = other, count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            score[end], count[end] = best, pieces

        best, pieces, alone = None, 0, False
        for last, (length, value) in self.automaton.iter(word):  # by end; at one end the longest first
            while done < last:  # close the positions before this end
                done += 1
                if alone:
                    score[done], count[done] = best, pieces
                else:
                    unknown(done, best, pieces)
                best, pieces, alone = None, 0, False
            start = last + 1 - length
            if best is None or score[start] + value > best:
                best, pieces = score[start] + value, count[start] + 1
            alone = alone or length == 1
        while done < n:
            done += 1
            if alone:
                score[done], count[done] = best, pieces
            else:
                unknown(done, best, pieces)
            best, pieces, alone = None, 0, False
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        words = _RUNS.findall(marked) if self.by_word else [marked]
        known, tokens, score = self.known, 0, 0.0
        for w in words:
            got = known.get(w)
            if got is None:
                if len(known) >= MEMO:
                    known.clear()
                got = self.segment(w)
                if len(w) <= 64:
                    known[w] = got
            tokens += got[0]
            score += got[1]
        return tokens, score


@lru_cache(maxsize=2)
def _segmenter(pieces: tuple[tuple[str, float], ...]) -> Segmenter:
    return Segmenter(pieces)


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the score of the best segmentation of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = _segmenter(shared.value)
        for batch in batches:
            counted = [seg.count(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c for c, _ in counted], pa.int64()), pa.array([s for _, s in counted], pa.float64())],
                ["doc_id", "n_tokens", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, score double")
