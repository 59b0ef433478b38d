"""Language-model scores against a direct computation on the same counts."""

import math
import zlib
from collections import Counter

import pytest

from tidegate.llm import lm, lm_corpus

END = lm.END


def fold(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def direct(texts, word_share, gram_share, discount):
    """Scores by looking up every pair in plain dictionaries."""
    words = {d: [*(t or "").encode().lower().split(), END] for d, t in texts.items()}
    train = [w for d, w in words.items() if fold(d, 5) != 1]
    counts = Counter(w for ws in train for w in ws)
    n, v = sum(counts.values()), len(counts)
    low = lambda w: (counts[w] + 0.5) / (n + 0.5 * (v + 1))
    frequent = {w for w, c in counts.items() if c >= max(1, word_share * n)}
    pairs = Counter(p for ws in train for p in zip([END, *ws], ws, strict=False) if p[0] in frequent and p[1] in frequent)
    kept = {p: c for p, c in pairs.items() if c >= max(1, gram_share * n)}
    out = {}
    for d, ws in words.items():
        score = 0.0
        for a, b in zip([END, *ws], ws, strict=False):
            if (a, b) in kept:
                score += math.log10((kept[a, b] - discount) / counts[a])
                continue
            mine = [p for p in kept if p[0] == a]
            if mine:
                left = 1 - sum(kept[p] - discount for p in mine) / counts[a]
                score += math.log10(left / (1 - sum(low(p[1]) for p in mine)))
            score += math.log10(low(b))
        out[d] = (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10(low(w)) for w in ws), score)
    return out


@pytest.mark.parametrize(("word_share", "gram_share"), [(4e-6, 5e-5), (0.01, 0.01), (0.9, 0.9)])
def test_equals_direct(spark, sf_dir, monkeypatch, word_share, gram_share):
    monkeypatch.setattr(lm, "HELD", 50)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    got = lm.score_texts(docs, lm.learn(docs, word_share=word_share, gram_share=gram_share)).collect()
    want = direct({r["doc_id"]: r["text"] for r in docs.collect()}, word_share, gram_share, 0.75)
    assert len(got) == len(want)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert r["held_out"] == (fold(r["doc_id"], 5) == 1)
        assert r["base_score"] == pytest.approx(w[3], rel=1e-9)
        assert r["score"] == pytest.approx(w[4], rel=1e-9)


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, "a b a c " * (i + 1)) for i in range(1, 9)], "doc_id long, text string")
    model = lm.learn(docs, word_share=1e-6, gram_share=1e-3)
    a = model.automaton
    for state, arcs in enumerate(a.arcs):
        other = sum(10 ** (a.failure[state] + a.low[i]) for i in range(len(a.low)) if i not in arcs)
        unseen = 10 ** (a.failure[state] + model.low(0))
        assert sum(10**x for x in arcs.values()) + other + unseen == pytest.approx(1)


def test_odd_rows(spark):
    rows = [(1, None, 1.0), (1, None, 1.0), (None, "a b", 2.0), (2, "", None), (3, "x " * 5000, 0.0)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = lm.score_texts(odd, lm.learn(odd)).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 3), (1, 1), (1, 1), (2, 1), (3, 5001)]
    assert lm.score_texts(odd.limit(0), lm.learn(odd.limit(0))).count() == 0


def test_every_pair_counts(spark, sf_dir, monkeypatch):
    """By default no training pair is too rare for an arc; with rare words as contexts and hardly any arc in the automaton."""
    monkeypatch.setattr(lm, "HELD", 50)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    want = direct({r["doc_id"]: r["text"] for r in docs.collect()}, 0, 0, 0.75)
    for shares in ({}, {"word_share": 0.005, "hot_share": 0.02}, {"word_share": 0.9}):
        got = lm.score_texts(docs, lm.learn(docs, **shares)).collect()
        assert len(got) == len(want)
        for r in got:
            w = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
            assert (r["base_score"], r["score"]) == (pytest.approx(w[3], rel=1e-9), pytest.approx(w[4], rel=1e-9))


def test_pairs_below_any_share_are_arcs(spark):
    """A pair seen twice among 400,000 tokens still tells the text that repeats it from one that does not."""
    ids = [i for i in range(200) if fold(i, 5) != 1]
    rows = [(i, "filler words " * 1250) for i in ids] + [(1000 + i, "quartz lantern") for i in range(9)]
    new = [i for i in range(2000, 2100) if fold(i, 5) == 1][:2]
    rows += [(new[0], "quartz lantern"), (new[1], "lantern quartz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] - r["base_score"] for r in lm.score_texts(docs, lm.learn(docs)).collect()}
    assert got[new[0]] > got[new[1]] + 3


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 3000])
def test_corpus_equals_direct(spark, sf_dir, monkeypatch, chunk_bytes):
    """Scores by chunks are those of the whole model, however the texts are dealt."""
    monkeypatch.setattr(lm_corpus, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(lm_corpus, "PASS_BYTES", 2000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    want = direct({r["doc_id"]: r["text"] for r in docs.collect()}, 0, 0, 0.75)
    got = lm_corpus.score_corpus(docs.repartition(3)).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert r["held_out"] == (fold(r["doc_id"], 5) == 1)
        assert (r["base_score"], r["score"]) == (pytest.approx(w[3], rel=1e-9), pytest.approx(w[4], rel=1e-9))


def test_corpus_odd_rows(spark):
    rows = [(1, None, 1.0), (1, None, 1.0), (None, "a b", 2.0), (2, "", None), (3, "x " * 5000, 0.0), (6, "A\tb", 1.0)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, score double").withColumnRenamed("score", "chunk")
    got = lm_corpus.score_corpus(odd).collect()
    want = lm.score_texts(odd, lm.learn(odd)).collect()
    key = lambda r: (r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"])
    assert sorted(map(key, got)) == sorted(map(key, want))
    for name in ("base_score", "score"):
        assert sorted(r[name] for r in got) == pytest.approx(sorted(r[name] for r in want))
    assert lm_corpus.score_corpus(odd.limit(0)).count() == 0
    held = [i for i in range(100) if fold(i, 5) == 1][:3]
    alone = lm_corpus.score_corpus(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in alone] == [(0, 0, 0.0, 0.0)] * 3
