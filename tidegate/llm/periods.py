"""Periodic runs of words inside texts, found by seeds on diagonals.

A run is a stretch of consecutive words with smallest period q, at least ``max(LEAST, TIMES * q)`` words long,
that no neighbouring word extends. On the diagonal of lag q (words i and i + q) such a run is a stretch of at
least ``max(LEAST - q, 2 * q)`` equal words, 16 or more for every q. So word 16-grams are the seeds of all lags
below 16, and k-grams with k = 32, 64, ... those of the lags from k / 2 up to k: a run with such a lag holds at
least one pair of k-grams at distance q. A gram at least as long as the smallest period recurs inside its run at
multiples of q only, hence next at distance q: pairs of *successive* occurrences are enough, their number is
linear, and a stretch that they give has no smaller period. Grams of 2k words are made of two k-grams; only texts
that repeat a k-gram go on to 2k.

Pairs are taken by lag and place. A table keeps, per text and lag, how far the diagonal is covered; pairs inside
are suppressed, the others are extended word by word in both directions.

Words are compared by 64-bit hashes (two different words of one text agree with a probability of 5e-20 per pair).

``collapse`` drops from every run what follows its first period. Results for special inputs: texts that are null,
empty or white space have no words, no runs and the digest of the empty string; a null id counts as an id like
others, without planted period; texts of any length count whole, one text in one task; ties of exponent go to the
smallest start, then period; repeated rows give repeated rows; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched, byte_texts
from tidegate.llm.words import mix, word_hashes

#: Words that a run has at least, and periods.
LEAST, TIMES = 24, 3
#: Words of the shortest seed: the least of max(LEAST - q, 2 * q) over all q.
SEED = 16
#: Bytes of text per pass, and words joined at once; memory only.
PASS_BYTES = 1 << 20
PIECE = 1 << 16

Run = tuple[int, int, int]


def planted(doc_id: object, n: int) -> np.ndarray | None:
    """Original word numbers of the text with its planted period; None for texts that stay as they are."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    numbers = np.arange(n)
    numbers[a:] = a + (numbers[a:] - a) % p
    return numbers


def _extend(words: np.ndarray, low: int, high: int, start: int, lag: int, size: int) -> tuple[int, int]:
    """The stretch of the diagonal around a seed of ``size`` words, between the text's first and last word."""
    left, right = start, start + size
    step = 64
    while right + lag < high:
        stop = min(right + step, high - lag)
        differ = np.flatnonzero(words[right:stop] != words[right + lag : stop + lag])
        if len(differ):
            right += int(differ[0])
            break
        right, step = stop, step * 2
    step = 64
    while left > low:
        stop = max(low, left - step)
        differ = np.flatnonzero(words[stop:left] != words[stop + lag : left + lag])
        if len(differ):
            left = stop + int(differ[-1]) + 1
            break
        left, step = stop, step * 2
    return left, right


def _pairs(grams: np.ndarray, owner: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram occurs again later in the same text, and where it does next."""
    with np.errstate(over="ignore"):
        keys = mix(grams[places] + owner[places].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    again = keys[order[1:]] == keys[order[:-1]]
    one, other = places[order[:-1][again]], places[order[1:][again]]
    same = owner[one] == owner[other]
    return one[same], other[same]


def find_runs(words: np.ndarray, bounds: np.ndarray) -> list[list[Run]]:
    """For each text (words from bounds[t] to bounds[t + 1]) its runs (start, length, period), by start."""
    count = len(bounds) - 1
    found: list[list[Run]] = [[] for _ in range(count)]
    texts = np.flatnonzero(np.diff(bounds) >= LEAST)
    grams, size = words, 1
    covered: dict[tuple[int, int], int] = {}
    while len(texts):
        # Only the texts that are left: their words' places, and those with a whole gram after them.
        lengths = bounds[texts + 1] - bounds[texts]
        target = max(SEED, size * 2)
        while size < target:
            with np.errstate(over="ignore"):
                longer = mix(grams[: len(grams) - size] * np.uint64(0xD1B54A32D192ED03) + grams[size:])
            grams, size = np.concatenate([longer, grams[len(grams) - size :]]), size * 2
        fits = np.maximum(lengths - size, 0)
        owner_of = np.repeat(texts, fits)
        offsets = np.arange(fits.sum()) - np.repeat(np.cumsum(fits) - fits, fits)
        places = bounds[owner_of] + offsets
        owner = np.zeros(len(words), dtype=np.int64)
        owner[places] = owner_of
        # A gram that ends at the last word is the second of a pair at most.
        last = bounds[texts + 1] - size
        ends = last[lengths >= size]
        owner[ends] = texts[lengths >= size]
        one, other = _pairs(grams, owner, np.sort(np.concatenate([places, ends])))
        texts = np.unique(owner[one])
        lag = other - one
        suits = (lag < size) & (lag >= (size // 2 if size > SEED else 1))
        one, lag = one[suits], lag[suits]
        order = np.lexsort((one, lag))
        one, lag = one[order], lag[order]
        # A pair right after another one on the same lag lies inside the stretch of that one.
        fresh = np.ones(len(one), dtype=bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (one[1:] != one[:-1] + 1)
        for start, q in zip(one[fresh].tolist(), lag[fresh].tolist(), strict=True):
            text = int(owner[start])
            if start < covered.get((text, q), 0):
                continue
            low, high = int(bounds[text]), int(bounds[text + 1])
            left, right = _extend(words, low, high, start, q, size)
            covered[text, q] = right
            length = right - left + q
            if length >= max(LEAST, TIMES * q):
                found[text].append((left - low, length, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay: those in no run, or in the first period of each run that they are in."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def _joined(text: bytes, numbers: np.ndarray | None, keep: np.ndarray) -> Iterator[bytes]:
    """The kept words, with one space between them, in pieces."""
    spaced = text.translate(bytes(32 if 9 <= i <= 13 else i for i in range(256)))
    inside = np.concatenate([[False], np.frombuffer(spaced, dtype=np.uint8) != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    chosen = np.flatnonzero(keep) if numbers is None else numbers[keep]
    for at in range(0, len(chosen), PIECE):
        part = chosen[at : at + PIECE]
        words = [text[s:e] for s, e in zip(starts[part].tolist(), ends[part].tolist(), strict=True)]
        yield (b" " if at else b"") + b" ".join(words)


def collapsed_digest(text: bytes, numbers: np.ndarray | None, keep: np.ndarray) -> str:
    if numbers is None and keep.all() and len(text) < PASS_BYTES:
        return hashlib.sha256(b" ".join(text.split())).hexdigest()
    digest = hashlib.sha256()
    for piece in _joined(text, numbers, keep):
        digest.update(piece)
    return digest.hexdigest()


_FIELDS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
_TYPES = [pa.int64()] * 5 + [pa.string()] * 2


def describe(text: bytes, numbers: np.ndarray | None, n: int, runs: list[Run]) -> tuple:
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best: tuple = (None, None, None, None)
    if runs:
        start, length, q = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
        best = (start, length, q, 1000 * length // q)
    digest = collapsed_digest(text, numbers, kept_words(n, runs))
    return (len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), digest)


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    planting: Callable[[object, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """id, n_runs, the run of greatest exponent, and digests of all runs and of the collapsed text, per row.

    ``planting(id, n)`` may give word numbers to read the n words of a text by (see ``planted``).
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            texts, ids = byte_texts(batch.column(1)), batch.column(0).to_pylist()
            hashes, bounds = word_hashes(texts, exact=True)
            numbers = []
            for t, doc_id in enumerate(ids):
                low, high = int(bounds[t]), int(bounds[t + 1])
                numbers.append(planting(doc_id, high - low) if planting else None)
                if numbers[t] is not None:
                    hashes[low:high] = hashes[low:high][numbers[t]]
            runs = find_runs(hashes, bounds)
            rows = [describe(x, numbers[t], int(bounds[t + 1] - bounds[t]), runs[t]) for t, x in enumerate(texts)]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *_FIELDS])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    longs = ", ".join(f"{name} long" for name in _FIELDS[:5])
    found = rows.mapInArrow(run, f"id {kind}, {longs}, runs_sha256 string, collapsed_sha256 string")
    return found.withColumnRenamed("id", id_column)
