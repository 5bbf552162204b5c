"""Words, word hashes and shingles of whole Arrow text columns, vectorised with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D (so the text is
UTF-8 bytes throughout); hashing lower-cases A-Z only.  A column is worked off in
chunks of about a quarter of a megabyte, so a task's memory is bounded by one chunk (or one
text, if a text is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INV = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(30))
        x = x * _U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> _U(27))
        x = x * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += _U(32)
_VALUE = mix(_LOWER + _U(0x1234567))

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.concatenate([np.ones(1, _U), np.cumprod(np.full(max(n, CHUNK) - 1, base, dtype=_U))])
        _powers[name] = have
    return have


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``limit`` bytes together."""
    raw, at = text_buffers(column)
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, side="right")) - 1)
        yield row, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def separators(inside: str) -> np.ndarray:
    """A table of bytes that separate words: all ASCII but those in ``inside``."""
    out = np.zeros(256, dtype=bool)
    out[:128] = True
    out[[ord(c) for c in inside]] = False
    return out


def spans(raw: np.ndarray, at: np.ndarray, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text (plus one) the index of its first word."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    space = separator[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)  # a text begins here
    cut[at] = True
    before = np.empty(len(raw), dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    before |= cut[:-1]
    after = np.empty(len(raw), dtype=bool)
    after[-1] = True
    after[:-1] = space[1:]
    after |= cut[1:]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, at).astype(np.int64)


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """What ``hash_between`` needs of a block of bytes, once for any number of spans."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, dtype=_U)
        np.cumsum(_VALUE[raw] * _power(_BASE, len(raw) + 1, "up")[: len(raw)], out=sums[1:])
        return sums


def hash_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * _power(_INV, len(sums), "down")[starts] + (ends - starts).astype(_U))


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span with A-Z lower-cased (polynomial prefix sums, then mixed)."""
    if not len(starts):
        return np.zeros(0, _U)
    return hash_between(prefix_sums(raw), starts, ends)


def hash_word(word: bytes) -> int:
    """The hash that ``hash_spans`` gives a span with these bytes."""
    raw = np.frombuffer(word, np.uint8)
    return int(hash_spans(raw, np.array([0]), np.array([len(raw)]))[0])


def shingles(word: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of all texts and each text's bounds in them; a text
    with fewer words than k has its whole sequence as one shingle, one without words none."""
    counts = np.diff(first)
    with np.errstate(over="ignore"):
        n = max(0, len(word) - k + 1)
        h = np.zeros(n, dtype=_U)
        for j in range(k):
            h = h * _U(0xD6E8FEB86659FD93) + word[j : j + n]
        inside = np.arange(n) + k <= np.repeat(first[1:], counts)[:n]
        full = mix(h[inside])
        short = np.flatnonzero((counts > 0) & (counts < k))
        sizes = np.maximum(counts - k + 1, 0)
        if not len(short):
            return full, np.concatenate([[0], np.cumsum(sizes)])
        own = np.zeros(len(short), dtype=_U)
        for i, t in enumerate(short):
            x = _U(counts[t])
            for w in word[first[t] : first[t + 1]]:
                x = x * _U(0xA0761D6478BD642F) + w
            own[i] = x
        before = np.concatenate([[0], np.cumsum(sizes)])
        sizes[short] = 1
        return np.insert(full, before[short], mix(own)), np.concatenate([[0], np.cumsum(sizes)])


def distinct_shingles(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for row, raw, at in chunks(column):
        starts, ends, first = spans(raw, at)
        sh, bounds = shingles(hash_spans(raw, starts, ends), first, k)
        for i in range(len(at) - 1):
            own = np.sort(sh[bounds[i] : bounds[i + 1]])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            yield row + i, own
