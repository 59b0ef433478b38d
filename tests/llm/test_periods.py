"""Periodic runs against a scan of every diagonal."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidegate.llm.periods import find_runs, periodic_runs, planted


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length < max(24, 3 * q):
                continue
            run = words[start : start + length]
            if not any(run[d:] == run[:-d] for d in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = (None,) * 4
    if runs:
        s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    return (len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def sequences(rng):
    for _ in range(rng.randint(1, 5)):
        words = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.3:
                words += [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
            elif kind < 0.8:
                p = rng.choice([1, 2, 3, 5, 8, 9, 12, 15, 16, 17, 20, 31, 32, 33, 40])
                root = [rng.randint(0, rng.choice([1, 2, 50])) for _ in range(p)]
                words += [root[i % p] for i in range(rng.randint(p, p * 5 + 30))]
            else:
                words += [rng.randint(0, 1000) for _ in range(rng.randint(0, 60))]
        yield words


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_sequences(seed):
    texts = list(sequences(random.Random(seed)))
    words = np.array([w for t in texts for w in t], dtype=np.uint64)
    bounds = np.cumsum([0, *map(len, texts)])
    assert find_runs(words, bounds) == [brute_runs(t) for t in texts]


def test_runs_of_fibonacci_and_powers():
    one, other = [0], [0, 1]
    while len(other) < 400:
        one, other = other, other + one
    for text in (other, [0] * 300, ([0] * 30 + [1]) * 9, ([0, 1] * 12 + [2]) * 7):
        assert find_runs(np.array(text, dtype=np.uint64), np.array([0, len(text)])) == [brute_runs(text)]


def _check(spark, rows, schema="doc_id long, text string", **more):
    frame = spark.createDataFrame(rows, schema)
    got = sorted((tuple(r) for r in periodic_runs(frame, planting=planted).collect()), key=str)
    assert got == sorted(((r[0], *brute(*r[:2])) for r in rows), key=str)


def test_given_table(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in frame.collect() if len(r["text"] or "") < 12_000]
    _check(spark, rows)


def test_odd_rows(spark):
    chorus = "la la\tla\x0bla\n" * 20
    rows = [(i, t) for i, t in enumerate([None, "", " \t\r\n\x0b\x0c ", "one", chorus, "  " * 30, "a " * 23, "a " * 24])]
    rows += [(None, chorus), (4, chorus), (5, chorus), (-10, "b c " * 15)]
    _check(spark, rows)
    _check(spark, [(*r, 1, 2) for r in rows], "doc_id long, text string, start long, id long")
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_planted_periods_are_read(spark):
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][:120]
    rng = random.Random(3)
    _check(spark, [(i, " ".join(str(rng.randint(0, 99999)) for _ in range(rng.randint(1, 300)))) for i in ids])


def test_long_text_in_pieces(spark, monkeypatch):
    text = " ".join(str(i) for i in range(90_000)) + " x y z" * 30_000
    _, digest = (r := periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()).n_runs, r[-1]
    assert (r.start, r.length, r.period) == (90_000, 90_000, 3)
    kept = " ".join(str(i) for i in range(90_000)) + " x y z"
    assert digest == hashlib.sha256(kept.encode()).hexdigest()
