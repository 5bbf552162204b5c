"""Spelling variant grouping by finite-state composition (dealt operator 12).

Words that differ by one inserted, deleted or replaced code point are found by composing the
minimised acceptor of the vocabulary with a one-edit transducer and the acceptor again.  The
vocabulary is dealt by initial states: with m the length of the shorter word of a pair, either
both begin with the same m // 2 code points (the edit comes after them), or both end with the
same rest (the edit comes before it).  A word therefore goes to the partition of the state that
its first half leads to, forwards, and of the state that its second half leads to, backwards; its
halves are those of its own length and of the length one less, so it goes to four partitions.
There the remainders of the words of length m and of length m + 1 are two minimal acceptors, and
their compositions are enumerated:

    replaced    acceptor(m)     o  read a, write b (a <> b)  o  acceptor(m)
    deleted     acceptor(m + 1) o  read a, write nothing     o  acceptor(m)

Both read the same letters before the edit and after it; state pairs from which no common
remainder is accepted are trimmed.  A deletion within a run of equal letters is that of the last
one, so every pair has one path and is found in one partition.  No list of words is paired with
itself, and no vocabulary is held whole anywhere: a task holds the words of one half at a time.

Counting the words is a plain aggregate over all texts.  Forms are followed to the last by pointer
jumping; a form's count is at least ``FACTOR`` times the word's, so chains are short.

Defined cases: null and empty texts have no words; a null doc_id counts as empty text in the
hash; repeated rows count as often as they come; ties of forms go to the smallest word in
code-point order; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 5  # code points of a word
SELDOM = 3  # occurrences of a word
SLIP = 97  # a run whose hash this divides has lost a code point
FACTOR = 2  # of a word's count that its form reaches
OUT_ROWS = 1 << 15


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, seldom: int = SELDOM, slip: int = SLIP) -> DataFrame:
    """(word, n): the words of all texts and how often they come."""
    # a maximal run of fewer letters can't be a word; A-Z alone are lower-cased, run by run
    runs = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.expr(f"regexp_extract_all(CAST(text AS string), '{LETTERS}{{{shortest},}}', 0)")).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", h.alias("h"), F.char_length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    word = F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
            .where((F.char_length("word") >= shortest) & (F.col("n") >= seldom)))


class Acceptor:
    """A minimal acyclic acceptor of words that come in sorted order: states are numbers, ``arcs`` the
    letters that lead on from each, state 0 has read a whole word and has none."""

    def __init__(self, words: Iterable[str]):
        self.arcs: list[dict[str, int]] = [{}]
        known: dict[tuple, int] = {}
        path: list[tuple[str, dict[str, int]]] = []  # the last word's states that can still get arcs
        self.root: dict[str, int] = {}

        def close(depth: int) -> None:
            """Give the states below ``depth`` their numbers, equal ones the same."""
            while len(path) > depth:
                letter, state = path.pop()
                key = tuple(state.items())
                number = known.setdefault(key, len(self.arcs)) if state else 0
                if number == len(self.arcs):
                    self.arcs.append(state)
                (path[-1][1] if path else self.root)[letter] = number

        last = ""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            close(same)
            path += [(letter, {}) for letter in word[same:]]
            last = word
        close(0)
        self.arcs.append(self.root)
        self.start = len(self.arcs) - 1


class Composition:
    """Acceptor o one-edit transducer o acceptor, over words of one length (replaced) and of one more (deleted)."""

    def __init__(self, short: Acceptor, long: Acceptor):
        self.short, self.long = short, long
        self.trim: dict[tuple, bool] = {}  # whether two states accept a common remainder

    def alive(self, left: Acceptor, p: int, q: int) -> bool:
        side, right = left is self.long, self.short.arcs
        known, todo = self.trim, [(p, q)]
        while todo:
            x, y = todo[-1]
            if (side, x, y) in known:
                todo.pop()
                continue
            a, b = left.arcs[x], right[y]
            below = [(a[c], b[c]) for c in a if c in b]
            if not a and not b or any(known.get((side, *xy)) for xy in below):
                known[side, x, y] = True
            elif open_ := [xy for xy in below if (side, *xy) not in known]:
                todo.append(open_[0])
                continue
            else:
                known[side, x, y] = False
            todo.pop()
        return known[side, p, q]

    def common(self, left: Acceptor, p: int, q: int) -> Iterator[str]:
        """The remainders that both states accept."""
        if not self.alive(left, p, q):
            return
        said: list[str] = []
        walk = [iter([("", p, q)])]
        while walk:
            step = next(walk[-1], None)
            if step is None:
                walk.pop()
                if said:
                    said.pop()
                continue
            letter, x, y = step
            said.append(letter)
            a, b = left.arcs[x], self.short.arcs[y]
            if not a and not b:
                yield "".join(said)
            walk.append(iter([(c, a[c], b[c]) for c in a if c in b and self.alive(left, a[c], b[c])]))

    def _read(self, left: Acceptor) -> Iterator[tuple[str, int, int]]:
        """What both sides read before the edit, and the states it leads to."""
        todo = [("", left.start, self.short.start)]
        while todo:
            said, p, q = todo.pop()
            yield said, p, q
            a, b = left.arcs[p], self.short.arcs[q]
            todo += [(said + c, a[c], b[c]) for c in a if c in b]

    def replaced(self) -> Iterator[tuple[str, str]]:
        """Pairs of words of the shorter length, one way round."""
        for said, p, _ in self._read(self.short):
            arcs = sorted(self.short.arcs[p].items())
            for i, (a, x) in enumerate(arcs):
                for b, y in arcs[:i]:
                    for rest in self.common(self.short, x, y):
                        yield said + a + rest, said + b + rest

    def deleted(self) -> Iterator[tuple[str, str]]:
        """Pairs of a longer word and what is left of it."""
        for said, p, q in self._read(self.long):
            here = self.short.arcs[q]
            for a, x in self.long.arcs[p].items():
                on = self.long.arcs[x]
                if not on and not here:
                    yield said + a, said
                for c in on:
                    if c != a and c in here:  # else the deletion is that of a later letter of the run
                        for rest in self.common(self.long, on[c], here[c]):
                            yield said + a + c + rest, said + c + rest


def partition_pairs(half: str, back: bool, m: int, words: list[str]) -> Iterator[tuple[str, str]]:
    """The near pairs of one initial state: ``words`` of length m and m + 1 with this first half (or second, if ``back``)."""
    if not any(len(w) == m for w in words):
        return
    rests = [w[: len(w) - len(half)][::-1] if back else w[len(half):] for w in words]
    short, long = (Acceptor(sorted({r for r, w in zip(rests, words, strict=True) if len(w) == n})) for n in (m, m + 1))
    both = Composition(short, long)
    whole = (lambda r: r[::-1] + half) if back else (lambda r: half + r)
    for a, b in both.replaced():
        yield whole(a), whole(b)
    for a, b in both.deleted():
        a, b = whole(a), whole(b)
        # backwards the last letter of a run comes first: a deletion that could also lie in the shared first half is found there
        if not back or a[: m // 2] != b[: m // 2]:
            yield a, b


def _enumerated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (half, back, m, word, n) sorted by partition to near pairs, both ways round."""
    held: dict[str, int] = {}
    at = None
    out: list[tuple[str, str, int]] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                                          ["word", "near", "near_n"])

    def done() -> Iterator[pa.RecordBatch]:
        if at is not None and len(held) > 1:
            for a, b in partition_pairs(*at, list(held)):
                out.append((a, b, held[b]))
                out.append((b, a, held[a]))
                if len(out) >= OUT_ROWS:
                    yield batch()

    for b in batches:
        for half, back, m, word, n in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if (half, back, m) != at:
                yield from done()
                at, held = (half, back, m), {}
            held[word] = n
    yield from done()
    yield batch()


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs of words (word, n) that are one edit apart, both ways round."""
    size = F.char_length("word")
    each = words.select("word", "n", size.alias("size"), F.explode(F.array(size, size - 1)).alias("m"))
    half = F.floor(F.col("m") / 2).cast("int")
    each = each.select(
        "m", "word", "n", F.explode(F.array(
            F.struct(F.lit(False).alias("back"), F.substring("word", F.lit(1), half).alias("half")),
            F.struct(F.lit(True).alias("back"), F.substring("word", F.col("size") - (F.col("m") - half) + 1, F.col("m") - half).alias("half")))).alias("key"))
    dealt = each.select("key.half", "key.back", "m", "word", "n").repartition("half", "back", "m").sortWithinPartitions("half", "back", "m")
    return dealt.mapInArrow(_enumerated, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last by pointer jumping."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        on = at.select(F.col("word").alias("via"), F.col("root").alias("further"))
        jumped = at.join(on, F.col("root") == F.col("via"), "left")
        at = keep(jumped.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def spelling_variants(docs: DataFrame, factor: int = FACTOR) -> DataFrame:
    """Per word of ``docs`` (doc_id, text): word, n, n_near, form, form_n and root."""
    words = keep(vocabulary(docs), "words")
    near = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near"))).alias("best"))
    own = words.join(near.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    best = -F.col("best.order")
    large = best >= factor * F.col("n")
    own = keep(own.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                          F.when(large, F.col("best.near")).alias("form"), F.when(large, best).alias("form_n")), "forms")
    last = roots(own.where("form IS NOT NULL").select("word", "form")).withColumnRenamed("word", "of")
    return own.join(last, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
