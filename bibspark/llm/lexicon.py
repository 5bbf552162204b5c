"""A minimal acyclic transducer from words to id sequences, in arrays that can be memory-mapped.

States that accept the same suffixes are one state.  Each arc outputs how many words sort
before those reached through it; the outputs along a word's path add up to its rank, which
addresses its ids.
"""

from __future__ import annotations

import numpy as np


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The transducer of word -> ids as one block of bytes."""
    words = sorted(entries)
    register: dict[tuple, int] = {}
    final: list[bool] = []
    arcs: list[tuple[tuple[int, int], ...]] = []  # of each state: (byte, target), by byte

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        at = register.get(key)
        if at is None:
            at = register[key] = len(final)
            final.append(node[0])
            arcs.append(key[1])
        return at

    path: list[list] = [[False, []]]  # open states of the last word: [accepts, finished arcs]
    last = b""
    for word in words:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        for depth in range(len(last), same, -1):
            path[depth - 1][1].append((last[depth - 1], freeze(path.pop())))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        path[depth - 1][1].append((last[depth - 1], freeze(path.pop())))
    root = freeze(path[0])

    below = np.zeros(len(final), np.int64)  # words accepted from each state; targets come before their sources
    keys, targets, outputs = [], [], []
    for state, out in enumerate(arcs):
        n = int(final[state])
        for byte, target in out:
            keys.append(state << 8 | byte)
            targets.append(target)
            outputs.append(n)
            n += int(below[target])
        below[state] = n
    ids = [entries[w] for w in words]
    parts = [np.array([len(final), len(keys), len(words), root, sum(map(len, ids))], np.int64), np.array(keys, np.int64),
             np.array(targets, np.int64), np.array(outputs, np.int64), np.cumsum([0, *map(len, ids)], dtype=np.int64),
             np.array(final, np.int64), np.array([i for seq in ids for i in seq], np.int64)]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Look-ups in a compiled transducer, which stays in the mapped file."""

    def __init__(self, path: str):
        block = np.memmap(path, dtype=np.int64, mode="r")
        n_states, n_arcs, n_words, self.root, n_ids = (int(x) for x in block[:5])
        at = 5
        views = []
        for n in (n_arcs, n_arcs, n_arcs, n_words + 1, n_states, n_ids):
            views.append(block[at : at + n])
            at += n
        self.keys, self.targets, self.outputs, self.bounds, self.final, self.ids = views

    def span_ranks(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The rank of each word (a span of bytes), -1 if it is not in the lexicon; all words step together."""
        rank = np.full(len(start), -1, np.int64)
        if not len(self.keys):
            return rank
        live, state, out = np.arange(len(start)), np.full(len(start), self.root), np.zeros(len(start), np.int64)
        step = 0
        while len(live):
            ended = size[live] == step
            accepted = ended & (self.final[state] == 1)
            rank[live[accepted]] = out[accepted]
            live, state, out = live[~ended], state[~ended], out[~ended]
            key = state << 8 | raw[start[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[arc] == key
            live, arc, out = live[found], arc[found], out[found]
            state, out = self.targets[arc], out + self.outputs[arc]
            step += 1
        return rank

    def flat_tokens(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words with these ranks one after another, and how many each has (-1: none)."""
        known = ranks >= 0
        low = np.where(known, self.bounds[np.maximum(ranks, 0)], 0)
        size = np.where(known, self.bounds[np.maximum(ranks, 0) + 1] - low, 0) if len(self.bounds) > 1 else np.zeros(len(ranks), np.int64)
        ends = np.cumsum(size)
        return self.ids[np.repeat(low - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], size

    def ranks(self, words: list[bytes]) -> np.ndarray:
        size = np.array([len(w) for w in words], np.int64)
        return self.span_ranks(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)

    def tokens(self, ranks: np.ndarray) -> list[list[int] | None]:
        """The ids of the words with these ranks; None for -1."""
        flat, size = self.flat_tokens(ranks)
        own = np.split(flat, np.cumsum(size)[:-1])
        return [ids.tolist() if rank >= 0 else None for rank, ids in zip(ranks.tolist(), own, strict=True)]
