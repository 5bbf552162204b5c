"""Toxicity by a weighted finite-state pattern grammar (dealt operator 9).

Words are runs of letters, lower-cased; clauses end at . ! ? ; and line breaks.  A word is
an insult, threat, target, negation or report word, or other.  Four letter-to-letter
transducers are composed into one:

    negation   an insult shortly after a negation is a negated insult, a threat then is none
    report     after a report word in the clause insults are reported ones, threats are none
    target     an insult shortly after a target is a directed insult; a target after an insult directs it
    threat     a threat with a target shortly after it is a directed threat

The composed transducer carries a weight for each output; a clause's score is the sum
along its path, and a text's score is the logistic function of its clauses' sum (each kind
of output counts at most ``MOST`` times) plus a base.

What is learnt, from a bounded sample of labelled texts (``sample`` rows of each label):
stems, that is beginnings of words, that stand in many different contexts in toxic texts and
hardly ever in others (copies of a text repeat its contexts and count once), and the weights, by
logistic regression drawn to the prior weights below, which hold where there are no labels.

Defined cases: null, empty and blank texts, and texts without a match, get the base score;
null or unknown labels and labels of unknown ids teach nothing; an id with several labels
teaches each; repeated rows are scored as often as they come; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import labelled_sample
from .shared import bounded_rows, give_back
from .words import chunks, hash_between, hash_word, prefix_sums, separators, spans

SAMPLE = 1500  # labelled rows of each label
THRESHOLD = 0.3
ROWS = 128  # texts that are normalised together
MOST = 10  # what a kind's count in a text tends to, smoothly
STEM = range(3, 9)  # characters of a learnt stem
EVIDENCE = 14.0  # least log-likelihood gain of a learnt stem: about ln(10^6)

# Words of the grammar's classes in English, German, French and Spanish.
INSULTS = """idiot idiots moron morons stupid pathetic loser losers scum trash worthless disgusting clown imbecile
dumm trottel arschloch versager abschaum imbécile connard crétin abruti imbécil estúpido estúpida idiota basura""".split()
THREATS = "kill hurt destroy beat punch shoot stab burn murder töten umbringen schlagen tuer frapper détruire matar golpear destruir".split()
TARGETS = """you your yourself they them he she him these those people du dich dir ihr euch tu toi vous
ils elles tú ti usted ustedes vosotros""".split()
NEGATIONS = "not never nobody isn aren wasn don doesn didn without nicht kein keine keinen nie jamais aucun nunca jamás ningún".split()
REPORTS = """said says claimed claims called calls wrote writes quoted reported according sagte sagt nannte schrieb
disait écrit appelé dijo dice escribió llamó""".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
# outputs beyond the classes
NEGATED, REPORTED, DIRECTED, POINTED, MENACE = range(6, 11)
KINDS = (INSULT, DIRECTED, POINTED, NEGATED, REPORTED, MENACE)
PRIOR = np.array([2.0, 2.5, 0.5, 0.2, 0.3, 3.0])  # of the kinds
BASE = -2.5

_LETTERS = separators(string.ascii_letters)
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?;\n"]] = True
_ODD = r"[^\x00-\x7F\p{L}\p{M}]+"  # what is neither ASCII nor part of a letter separates words: quotes, dashes, an ellipsis
Transducer = dict[tuple[object, int], tuple[object, int]]  # (state, input) to (state, output); starts at 0


def _countdown(trigger: int, window: int, change: dict[int, int]) -> Transducer:
    """Within ``window`` words after ``trigger``, the inputs of ``change`` are rewritten."""
    return {(s, x): ((window if x == trigger else max(0, s - 1)), change.get(x, x) if s else x)
            for s in range(window + 1) for x in range(11)}


def negation() -> Transducer:
    return _countdown(NEGATION, 2, {INSULT: NEGATED, THREAT: OTHER})


def report() -> Transducer:
    return {(s, x): (int(s or x == REPORT), {INSULT: REPORTED, THREAT: OTHER}.get(x, x) if s else x) for s in (0, 1) for x in range(11)}


def target() -> Transducer:
    """State: words left in which an insult is directed, and in which a target would direct the last insult."""
    out: Transducer = {}
    for a in range(4):
        for b in range(4):
            for x in range(11):
                y = DIRECTED if x == INSULT and a else POINTED if x == TARGET and b else x
                nxt = (3 if x == TARGET else max(0, a - 1), 3 if x == INSULT and not a else 0 if x == TARGET else max(0, b - 1))
                out[(0 if (a, b) == (0, 0) else (a, b)), x] = (0 if nxt == (0, 0) else nxt, y)
    return out


def threat() -> Transducer:
    return _countdown(THREAT, 2, {TARGET: MENACE, POINTED: MENACE})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that gives second what first puts out: its states are pairs."""
    out: Transducer = {}
    todo, seen = [(0, 0)], {(0, 0)}
    while todo:
        pair = todo.pop()
        for x in range(11):
            a, y = first.get((pair[0], x), (pair[0], x))
            b, z = second.get((pair[1], y), (pair[1], y))
            out[(0 if pair == (0, 0) else pair), x] = (0 if (a, b) == (0, 0) else (a, b), z)
            if (a, b) not in seen:
                seen.add((a, b))
                todo.append((a, b))
    return out


def tables(machine: Transducer) -> tuple[list[list[int]], list[list[int]]]:
    """Next states and outputs by state number and input."""
    number = {s: i for i, s in enumerate(dict.fromkeys([0, *(s for s, _ in machine)]))}
    nxt, out = ([[0] * 11 for _ in number] for _ in range(2))
    for (s, x), (t, y) in machine.items():
        nxt[number[s]][x], out[number[s]][x] = number[t], y
    return nxt, out


def grammar() -> tuple[list[list[int]], list[list[int]]]:
    return tables(compose(compose(compose(negation(), report()), target()), threat()))


@dataclass
class Model:
    stems: list[str]
    weights: np.ndarray  # of KINDS
    base: float

    def __post_init__(self):
        by_size: dict[int, list[int]] = {}
        for s in self.stems:
            by_size.setdefault(len(s.encode()), []).append(hash_word(s.encode()))
        self.by_size = {n: np.sort(np.array(h, np.uint64)) for n, h in by_size.items()}
        of = {hash_word(w.encode()): c for c, ws in ((INSULT, INSULTS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        self.hashes = np.array(sorted(of), np.uint64)
        self.classes = np.array([of[h] for h in sorted(of)], np.uint8)
        self.next, self.out = grammar()

    def classify(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = prefix_sums(raw)
        own = hash_between(sums, starts, ends)
        near = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
        found = np.where(self.hashes[near] == own, self.classes[near], OTHER).astype(np.uint8)
        for n, stems in self.by_size.items():
            long = np.flatnonzero((ends - starts >= n) & (found == OTHER))
            head = hash_between(sums, starts[long], starts[long] + n)
            near = np.minimum(np.searchsorted(stems, head), len(stems) - 1)
            found[long[stems[near] == head]] = INSULT
        return found

    def kinds(self, column: pa.Array) -> np.ndarray:
        """How often each of KINDS comes in each text."""
        counts = np.zeros((len(column), 11))
        parts = ((low, column.slice(low, ROWS).cast(pa.string())) for low in range(0, len(column), ROWS))  # few copies of texts at a time
        for row, raw, at in ((low + row, raw, at) for low, part in parts for row, raw, at in chunks(pc.utf8_lower(plain(part)))):
            starts, ends, first = spans(raw, at, _LETTERS)
            if not len(starts):
                continue
            classes = self.classify(raw, starts, ends)
            hits = np.flatnonzero((classes == INSULT) | (classes == THREAT))
            if not len(hits):
                continue
            edge = np.unique(np.concatenate([at, np.flatnonzero(_ENDS[raw])]))
            clause = np.searchsorted(edge, starts, side="right")
            which = np.unique(clause[hits])
            lows, highs = np.searchsorted(clause, which), np.searchsorted(clause, which, side="right")
            docs = row + np.searchsorted(first, lows, side="right") - 1
            for doc, lo, hi in zip(docs.tolist(), lows.tolist(), highs.tolist(), strict=True):
                state = 0
                for x in classes[lo:hi].tolist():
                    counts[doc, self.out[state][x]] += 1
                    state = self.next[state][x]
        return counts[:, list(KINDS)]

    def features(self, column: pa.Array) -> np.ndarray:
        """The counts of KINDS, each levelling off at MOST."""
        return MOST * (1 - np.exp(-self.kinds(column) / MOST))

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.features(column) @ self.weights + self.base)))


def plain(column: pa.Array) -> pa.Array:
    """Texts with typographic apostrophes as ASCII ones and other typographic marks as spaces."""
    return pc.replace_substring_regex(pc.replace_substring(column, "\u2019", "'"), _ODD, " ")


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, label, context) of the words of labelled texts, once for each text."""
    import regex

    words = regex.compile(r"\p{L}+")
    for batch in batches:
        stems, labels, contexts = [], [], []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ws = ["", *words.findall((text or "").lower()), ""]
            own = {(w[:n], zlib.crc32(f"{a[:4]} {b[:4]}".encode("utf-8", "surrogatepass"))) for a, w, b in zip(ws, ws[1:], ws[2:], strict=False) for n in {*STEM, len(w)}
                   if STEM.start <= n <= len(w)}
            stems += [s for s, _ in own]
            contexts += [c for _, c in own]
            labels += [label] * len(own)
            if len(stems) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(labels, pa.int32()), pa.array(contexts, pa.int64())], ["stem", "label", "context"])
                stems, labels, contexts = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(labels, pa.int32()), pa.array(contexts, pa.int64())], ["stem", "label", "context"])


def choose_stems(found: dict[str, int]) -> list[str]:
    """Of stems and their contexts: of each shortest one, its longest extension that keeps nine tenths of them."""
    roots: dict[str, str] = {}
    for s in sorted(found, key=lambda s: (len(s), s)):
        root = next((s[:n] for n in range(1, len(s)) if s[:n] in roots), None)
        if root is None:
            roots[s] = s
        elif found[s] >= 0.9 * found[root]:
            roots[root] = s
    return sorted(set(roots.values()))


def learn_stems(texts: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Stems that mark toxic texts (doc_id, label, text)."""
    if not n_toxic or not n_clean:
        return []
    seen = texts.select("label", "text").mapInArrow(_contexts, "stem string, label int, context long").distinct()
    counted = seen.groupBy("stem").agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean"))
    # far more often in toxic texts than chance explains, also among a million stems
    t, c, p = F.col("toxic"), F.col("clean"), n_toxic / (n_toxic + n_clean)
    gain = t * F.log(t / ((t + c) * p)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - p)))).otherwise(0)
    odds = (t + 0.5) / n_toxic / ((c + 0.5) / n_clean)
    rows = bounded_rows(counted.where((t >= max(3, round(0.01 * n_toxic))) & (odds >= 20) & (gain >= EVIDENCE)), 100_000)
    return choose_stems({r["stem"]: r["toxic"] for r in rows})


def fit_weights(x: np.ndarray, y: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and base of a logistic regression on weighted rows, drawn to the prior, none below 0."""
    mid = np.concatenate([PRIOR, [BASE]])
    w, a = mid.copy(), np.hstack([x, np.ones((len(x), 1))])
    pull = np.array([0.5] * len(PRIOR) + [0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a @ w).clip(-30, 30)))
        grad = a.T @ (each * (p - y)) + pull * (w - mid)
        hess = (a * (each * p * (1 - p))[:, None]).T @ a + np.diag(pull)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1, 2 / (np.abs(step).max() + 1e-12))
        w[:-1] = w[:-1].clip(0)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of documents (doc_id, text) and labels (doc_id, label; 1 is toxic)."""
    texts, counts = labelled_sample(docs, labels, sample)
    n = {v: min(sample, counts.get(v, 0)) for v in (0, 1)}
    model = Model(learn_stems(texts, n[1], n[0]), PRIOR, BASE)
    shared = docs.sparkSession.sparkContext.broadcast((model.stems, model.weights, model.base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.features(batch.column(2)).tolist(), pa.list_(pa.float64()))],
                                             ["doc_id", "label", "kinds"])

    rows = bounded_rows(texts.mapInArrow(run, "doc_id long, label int, kinds array<double>").dropDuplicates(["doc_id", "label"]), 2 * sample)
    if not (n[0] and n[1]):
        return model
    x, y = np.array([r["kinds"] for r in rows]), np.array([r["label"] for r in rows])
    return Model(model.stems, *fit_weights(x, y, np.array([counts[v] / n[v] for v in y.tolist()])))


def scorer(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """A column function text -> score (0 to 1, higher: toxic likelier), fitted here."""
    model = fit(docs, labels, sample)
    shared = docs.sparkSession.sparkContext.broadcast((model.stems, model.weights, model.base))

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        for t in texts:
            yield pa.array(own.scores(t), pa.float64())
        give_back()

    return score
