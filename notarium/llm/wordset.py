"""Words, shingles and token sets of whole batches, as array operations.

Words are runs of letters, digits and marks, lower-cased, in the text as it
looks.  A shingle is three words in a row, or eight characters of words where
the text is mainly written in a script without spaces.  Tokens are 48-bit
hashes; two different shingles of a pair meet with a chance near 1e-10.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .codepoints import DENSE, DIGIT, LETTER, MARK, tables

TOKEN_BITS = 48
TOKEN_MASK = np.uint64((1 << TOKEN_BITS) - 1)
WORDS, CHARS = 3, 8
#: A dense letter (Han, kana, Thai) stands for about this many letters of an alphabet.
DENSE_WEIGHT = 3


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing step of a 64-bit hash (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _values() -> np.ndarray:
    """A random value of each code point; capital and small letters share it."""
    return mix((tables()["lower"].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_POWER = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}
_P = 0xD6E8FEB86659FD93
_I = pow(_P, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWER["p"]) < n:
        m = max(n, 1 << 20)
        for k, base in (("p", _P), ("i", _I)):
            x = np.full(m, base, np.uint64)
            x[0] = 1
            _POWER[k] = np.multiply.accumulate(x)
    return _POWER["p"], _POWER["i"]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running hash; a span [a, b) has the hash (H[b] - H[a]) * inverse power a."""
    p, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


class Words:
    """The words of a batch: start and end among the kept characters, row, hash."""

    def __init__(self, points: np.ndarray, at: np.ndarray):
        kind = tables()["kind"][points]
        self.n = len(at) - 1
        self.index = np.flatnonzero(kind & (LETTER | DIGIT | MARK))
        chars = points[self.index]
        self.char_at = np.searchsorted(self.index, at)
        self.running = prefix_hash(_values()[chars])
        if len(self.index):
            new = np.empty(len(self.index), bool)
            new[0] = True
            np.not_equal(self.index[1:], self.index[:-1] + 1, out=new[1:])
            new[self.char_at[:-1][self.char_at[:-1] < len(new)]] = True
            self.start = np.flatnonzero(new)
        else:
            self.start = np.zeros(0, np.int64)
        self.end = np.append(self.start[1:], len(self.index))[: len(self.start)]
        self.word_at = np.searchsorted(self.start, self.char_at)
        _, inverse = _powers(len(self.running))
        self.hash = mix((self.running[self.end] - self.running[self.start]) * inverse[self.start])
        letters = np.concatenate([[0], np.cumsum((kind & LETTER) > 0)])[at]
        dense = np.concatenate([[0], np.cumsum((kind & DENSE) > 0)])[at]
        letters, dense = np.diff(letters), np.diff(dense)
        self.dense = dense * DENSE_WEIGHT > letters - dense

    def spans(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of each run of so many words, in order."""
        if len(self.hash) < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(len(self.hash) - size + 1, np.uint64)
        for k in range(size):
            h += self.hash[k : len(self.hash) - size + 1 + k] * np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        row = np.repeat(np.arange(self.n), np.diff(self.word_at))
        inside = row[: len(h)] == row[size - 1 :]
        return row[: len(h)][inside], mix(h)[inside]

    def char_spans(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of each run of so many characters of words, in dense rows only."""
        if not self.dense.any() or len(self.index) < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        row = np.repeat(np.arange(self.n), np.diff(self.char_at))
        begin = np.flatnonzero(self.dense[row[: len(row) - size + 1]] & (row[: len(row) - size + 1] == row[size - 1 :]))
        _, inverse = _powers(len(self.running))
        return row[begin], mix((self.running[begin + size] - self.running[begin]) * inverse[begin] + np.uint64(size))


def token_sets(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token) of the distinct shingles, sorted, and the offsets of each row. At most 65,536 rows."""
    w = Words(points, at)
    row, h = w.spans(WORDS)
    if w.dense.any():
        keep = ~w.dense[row]
        more, char_hash = w.char_spans(CHARS)
        row, h = np.concatenate([row[keep], more]), np.concatenate([h[keep], char_hash])
    key = (row.astype(np.uint64) << np.uint64(TOKEN_BITS)) | (h & TOKEN_MASK)
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    row = (key >> np.uint64(TOKEN_BITS)).astype(np.int64)
    return row, key & TOKEN_MASK, np.searchsorted(row, np.arange(w.n + 1))


def set_ids(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 63-bit id of each row's token set; rows without tokens have 0."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens + np.uint64(0x1234567)), dtype=np.uint64)])
    h = mix(total[at[1:]] - total[at[:-1]]) >> np.uint64(1)
    return np.where(np.diff(at) > 0, h, np.uint64(0)).astype(np.int64)
