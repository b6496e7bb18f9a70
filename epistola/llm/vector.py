"""Word spans and word hashes of a whole batch of texts by numpy, without a Python loop over words."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_MULT = 0x9E3779B97F4A7C15 | 1
#: Bytes hashed at once; the powers below are kept for so many, more only for a longer word.
BLOCK = 1 << 18


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_MULT, -1, 1 << 64)
    out = []
    for base in (_MULT, inverse):
        p = np.ones(1, np.uint64)
        while len(p) < n:
            p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
        out.append(p[:n])
    return out[0], out[1]


_POW: list = [_powers(1 << 8)]
#: A fixed pseudo-random 64-bit code for each byte value.
_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ascii_lower() -> np.ndarray:
    """Byte to byte, A to Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = ascii_lower()
#: Bytes inside a word of the kind [^\x20\x09-\x0D]+.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Bytes inside a word of letters; bytes beyond ASCII count as letters.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in data, and the number of words before each row (len(offsets) values)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    m = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    left = np.empty_like(m)
    left[0], left[1:] = False, m[:-1]
    starts = np.flatnonzero(m & (~left | cut[:-1]))
    right = np.empty_like(m)
    right[-1], right[:-1] = False, m[1:]
    ends = np.flatnonzero(m & (~right | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """A 64-bit hash of each word, its bytes first mapped by `fold`. Equal words have equal hashes wherever they stand."""
    codes = _CODES[fold]
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        stop = int(ends[to - 1])
        if stop - base > len(_POW[0][0]):
            _POW[0] = _powers(max(BLOCK, stop - base))
        power, inverse = _POW[0]
        total = np.empty(stop - base + 1, np.uint64)
        total[0] = 0
        np.cumsum(codes[data[base:stop]] * power[: stop - base], out=total[1:])
        s = starts[at:to] - base
        out[at:to] = (total[ends[at:to] - base] - total[s]) * inverse[s]
        at = to
    return mix(out)


def hash_words(words: list[str], fold: np.ndarray = LOWER) -> np.ndarray:
    """The same hash for a list of non-empty words."""
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(x) for x in raw]) if raw else np.zeros(0, np.int64)
    starts = ends - np.array([len(x) for x in raw], np.int64)
    return hashes(np.frombuffer(b"".join(raw), np.uint8), starts, ends, fold)


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted array."""
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


class HashSet:
    """A set of hashes with a weight each; a table of the top 16 bits turns most strangers away before the exact search."""

    def __init__(self, values: np.ndarray, weights: np.ndarray | None = None):
        order = np.argsort(values, kind="stable")
        self.values = values[order]
        self.weights = np.ones(len(values)) if weights is None else weights[order]
        self.table = np.zeros(1 << 16, bool)
        self.table[(self.values >> np.uint64(48)).astype(np.int64)] = True

    def weigh(self, h: np.ndarray) -> np.ndarray:
        """The weight of each hash, 0 if it isn't in the set."""
        out = np.zeros(len(h))
        if len(self.values):
            maybe = np.flatnonzero(self.table[(h >> np.uint64(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.values, h[maybe]), len(self.values) - 1)
            out[maybe] = np.where(self.values[at] == h[maybe], self.weights[at], 0.0)
        return out


def sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of flags between consecutive edges, empty stretches 0."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.float64)])
    return np.diff(total[edges])
