"""Words of many texts at once, as hashes in numpy."""

from __future__ import annotations

import numpy as np

# Words are runs without ASCII white space; A-Z count as a-z.
_FOLD = bytes(32 if i in range(9, 14) or i == 32 else i + 32 if i in range(65, 91) else i for i in range(256))
_FOLD_SPACE = bytes(32 if i in range(9, 14) else i for i in range(256))
# The same, but anything that is neither letter nor digit parts words, in ASCII; other bytes belong to words.
_FOLD_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in _FOLD)
_PICK = np.random.default_rng(20240229)
_VALUE = _PICK.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_PICK.integers(1, 1 << 62)) * 4 + 3
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


#: Bytes whose terms are held at once.
PART = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < count:
        size = max(count, PART)
        with np.errstate(over="ignore"):
            _POWERS[:] = [
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, base, dtype=np.uint64)]), dtype=np.uint64)
                for base in (np.uint64(_BASE), np.uint64(_INVERSE))
            ]
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[bytes], plain: bool = False, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words, text after text, and where each text's words begin (one more at the end).

    ``plain`` words are runs of letters and digits, ``exact`` words keep their case. A word's hash is a polynomial over its bytes: from running sums over all bytes, divided by the power
    at its first byte.
    """
    fold = _FOLD_SPACE if exact else _FOLD_PLAIN if plain else _FOLD
    codes = np.frombuffer((b" " + b" ".join(texts) + b" ").translate(fold), dtype=np.uint8)
    inside = codes != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    hashes = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):  # words of about PART bytes at a time
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + PART, side="right")))
        part = codes[base : ends[last - 1]]
        power, inverse = _powers(len(part))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[part] * power[: len(part)], dtype=np.uint64)])
        begin, end = starts[first:last] - base, ends[first:last] - base
        hashes[first:last] = mix((sums[end] - sums[begin]) * inverse[begin])
        first = last
    ends_of_texts = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, dtype=np.int64)
    return hashes, np.concatenate([[0], np.searchsorted(starts, ends_of_texts, side="right")])


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes, sorted, of all runs of ``size`` words; of the whole sequence if it is shorter."""
    size = min(size, len(hashes))
    if not size:
        return hashes[:0]
    count = len(hashes) - size + 1
    key = np.full(count, size, dtype=np.uint64)
    for i in range(size):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count])
    return np.unique(key)
