"""Removal of repeated strings against a count of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidegate.llm import repeats
from tidegate.llm.bucketed import Bucketed
from tidegate.llm.repeats import Strings, SuffixLevels, _distinct_texts, remove_repeats, segments

LENGTH = 200


def brute(texts):
    counts = Counter(t[i : i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for text in texts:
        gone, end = bytearray(len(text)), 0
        for i in range(len(text) - LENGTH + 1):
            if counts[text[i : i + LENGTH]] > 1:
                for j in range(max(i, end), i + LENGTH):
                    gone[j] = 1
                end = i + LENGTH
        rest = bytes(b for b, x in zip(text, gone, strict=True) if not x)
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((len(text), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def result(frame, **options):
    return sorted(((r[0], tuple(r)[1:]) for r in remove_repeats(frame, **options).collect()), key=str)


def expected(rows):
    return sorted(zip([i for i, _ in rows], brute([(t or "").encode() for _, t in rows]), strict=True), key=str)


def pieces(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdé ") for _ in range(3000))
    texts = [None, "", "x" * 199, "x" * 200, "x" * 1000, "ab" * 300, "x" * 201]
    for _ in range(50):
        text = ""
        for _ in range(rng.randint(1, 6)):
            if rng.random() < 0.6:
                at = rng.randint(0, 2900)
                text += base[at : at + rng.randint(100, 420)]
            else:
                text += "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 300)))
        texts.append(text)
    return list(enumerate(texts + texts[10:14]))


@pytest.mark.parametrize(("batches", "held"), [(1, 1 << 20), (5, 1 << 20), (2, 10)])
def test_same_bytes_go_as_in_a_count(spark, monkeypatch, batches, held):
    monkeypatch.setattr(repeats, "HELD", held)
    monkeypatch.setattr(repeats, "PASS_BYTES", 2000 if held == 10 else 1 << 20)
    rows = pieces(batches)
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), batches=batches) == expected(rows)


def test_given_table(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    assert result(frame) == expected(rows)


def test_keys_of_very_many_kinds_are_compared_by_window(spark, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_KINDS", 2)
    rows = pieces(7)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_edges_of_a_match(spark):
    rng = random.Random(1)

    def noise(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))

    shared, short = noise(200), noise(199)
    rows = [(i, f"{noise(50)}{'ABCD'[i]}{shared if i < 2 else short}{'WXYZ'[i]}{noise(50)}") for i in range(4)]
    got = dict(result(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[i][1] for i in range(4)] == [200, 200, 0, 0]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_odd_rows(spark):
    long = "".join(chr(97 + (i * i + i // 7) % 23) for i in range(3000))
    rows = [(None, long), (1, long), (1, "other"), (1, None), (2, long[:1500] + "#" + long[1500:])]
    more = [(*r, 1, 2) for r in rows]
    frame = spark.createDataFrame(more, "doc_id long, text string, o1 long, n_bytes long")
    assert result(frame) == expected(rows)
    assert result(spark.createDataFrame([], "doc_id string, text string")) == []


def test_long_texts_are_cut_into_parts(monkeypatch):
    text = np.random.default_rng(1).integers(0, 4, 30_000, dtype=np.uint8)
    whole = segments(Strings(text))
    monkeypatch.setattr(repeats, "PART", 1000)
    for one, other in zip(whole, segments(Strings(text)), strict=True):
        assert np.array_equal(one, other)


def test_anchors_are_the_first_least_heads():
    text = np.random.default_rng(2).integers(0, 2, 2000, dtype=np.uint8)
    text[500:1000] = 1
    heads = Strings(text).heads()
    low = np.uint64((1 << 20) - 1)
    place, _, first, last = segments(Strings(text))
    for p, a, b in zip(place, first, last, strict=True):
        for start in (a, b):
            window = heads[start : start + LENGTH - repeats.HEAD + 1] & ~low
            assert p == start + int(np.argmin(window))
    assert first[0] == 0 and last[-1] == 2000 - LENGTH and np.array_equal(first[1:], last[:-1] + 1)


def test_levels_grow_like_a_binary_counter(spark, tmp_path):
    rng = random.Random(4)
    tables = Bucketed(spark, f"file://{tmp_path}/levels", 4)
    index, seen, texts = SuffixLevels(tables), [], []
    for batch in range(6):
        some = ["".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(4)]
        some[0] = some[0] + (texts[-1][100:600] if texts else "")
        texts += some
        frame = _distinct_texts(spark.createDataFrame([(t,) for t in some], "text string"), "text")
        seen.append(index.add(frame).collect())
        sizes = [size for size, _ in index.levels]
        assert sum(sizes) == batch + 1 and sizes == sorted(sizes, reverse=True)
    assert [size for size, _ in index.levels] == [4, 1, 1]
    assert not seen[0] and all(seen[1:])
    given = [tuple(r) for rows in seen for r in rows]
    assert len(given) == len(set(given))  # every suffix once, by the batch that gave it a neighbour
    index.forget_sent()
    # The files of merged levels are gone.
    assert len([p for p in (tmp_path / "levels").iterdir() if p.is_dir()]) == 3
    tables.drop_all()
    assert not [p for p in (tmp_path / "levels").iterdir() if p.is_dir()]
