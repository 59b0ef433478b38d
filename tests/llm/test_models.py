"""Language identification and toxicity learning against plain loops, and the pipeline on odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tidegate.llm import langid, toxicity

MASK = (1 << 64) - 1


def plain_counts(text):
    """Buckets of all letter sequences of one to four signs, marks standing at the ends of words."""
    signs = [(ord(c) if c.isalpha() else 1, c.isalpha()) for c in text.lower() + "\n"]
    if not any(letter for _, letter in signs):
        return None
    found = Counter()
    shift = 64 - langid.BUCKETS.bit_length() + 1
    for at in range(len(signs) - 1):
        key = 0
        for size in range(4):
            if at + size >= len(signs):
                break
            # Between its first and last sign a sequence has letters only.
            if size > 1 and not signs[at + size - 1][1]:
                break
            key = (key * 0x100000001B3 & MASK) ^ signs[at + size][0]
            if size == 0:
                use = signs[at][1]
            else:
                use = signs[at][1] or signs[at + 1][1]
            if use:
                mixed = (key + int(langid._SALTS[size])) * 0xFF51AFD7ED558CCD & MASK
                found[mixed >> shift] += 1
    return found


def test_subword_counts_equal_plain_loops():
    texts = ["", "a", "  ", "Été 12 naïve", "one two, three", "x\ny", "ǅ ß ﬁ", "日本 語"]
    for text, counts in zip(texts, langid.hashed_counts(texts), strict=True):
        want = plain_counts(text)
        if want is None:
            assert not len(counts)
            continue
        got = {int(i): int(counts[i]) for i in np.flatnonzero(counts)}
        assert got == dict(want)


def plain_softmax(logits, temperature=1.0):
    top = max(x / temperature for x in logits)
    e = [math.exp(x / temperature - top) for x in logits]
    return [x / sum(e) for x in e]


def test_training_and_prediction_equal_plain_loops(monkeypatch):
    monkeypatch.setattr(langid, "BUCKETS", 64)
    pick = random.Random(1)
    rows = []
    for i in range(24):
        at = sorted(pick.sample(range(0, 40) if i % 2 else range(24, 64), 8))
        rows.append((np.array(at), np.array([pick.randint(1, 4) for _ in at]), i % 2))
    model = langid.train(rows, ["aa", "bb"], dimensions=3, epochs=3, rate=2.0, seed=5)

    # The same draws, then every sum by hand.
    draw = np.random.default_rng(5)
    table = [[float(x) for x in row] for row in draw.normal(0, 1 / 3, (64, 3)).astype(np.float32)]
    order = draw.permutation(len(rows))
    kept, learn = order[: len(rows) // 5], order[len(rows) // 5 :]
    head = [[float(x) for x in row] for row in draw.normal(0, 0.1, (3, 2)).astype(np.float32)]
    bias = [0.0, 0.0]
    shares = [[c / sum(counts.tolist()) for c in counts.tolist()] for _, counts, _ in rows]
    for epoch in range(3):
        step = 2.0 * (1 - epoch / 3)
        for i in draw.permutation(learn):
            at, kind = rows[i][0].tolist(), rows[i][2]
            mean = [sum(s * table[b][d] for s, b in zip(shares[i], at, strict=True)) for d in range(3)]
            error = plain_softmax([sum(mean[d] * head[d][k] for d in range(3)) + bias[k] for k in range(2)])
            error[kind] -= 1
            slope = [sum(head[d][k] * error[k] for k in range(2)) for d in range(3)]
            for d in range(3):
                for k in range(2):
                    head[d][k] -= 0.01 * step * mean[d] * error[k]
            for k in range(2):
                bias[k] -= 0.001 * step * error[k]
            for s, b in zip(shares[i], at, strict=True):
                for d in range(3):
                    table[b][d] -= step * s * slope[d]
    weights = [[sum(row[d] * head[d][k] for d in range(3)) for k in range(2)] for row in table]
    assert model.weights == pytest.approx(np.array(weights), abs=1e-4)
    assert model.bias == pytest.approx(bias, abs=1e-5)

    def logits(i):
        return [sum(s * weights[b][k] for s, b in zip(shares[i], rows[i][0].tolist(), strict=True)) + bias[k] for k in range(2)]

    def loss(t):
        return sum(-math.log(max(plain_softmax(logits(i), t)[rows[i][2]], 1e-12)) for i in kept) / len(kept)

    temperatures = np.geomspace(0.05, 20, 60).tolist()
    assert loss(model.temperature) == pytest.approx(min(map(loss, temperatures)), abs=1e-4)
    for kind in range(2):
        right = [p[kind] for i in kept if rows[i][2] == kind and (p := plain_softmax(logits(i), model.temperature))[kind] == max(p)]
        want = float(np.quantile(right, 0.01)) if right else 0.5
        assert model.least[kind] == pytest.approx(want, abs=1e-3)


def test_predictions_are_a_softmax_over_mean_weights():
    pick = np.random.default_rng(3)
    model = langid.LanguageModel(["aa", "bb", "cc"], pick.normal(0, 3, (langid.BUCKETS, 3)), pick.normal(0, 1, 3), 0.7, np.array([0.5, 0.4, 0.6]))
    for text in ("hello there", "Été", "a", "123", ""):
        counts = plain_counts(text)
        name, score, accepted = model.predict([text])[0]
        if counts is None:
            assert (name, score, accepted) == ("und", 0.0, False)
            continue
        total = sum(counts.values())
        p = plain_softmax([sum(n / total * model.weights[b, k] for b, n in counts.items()) + model.bias[k] for k in range(3)], 0.7)
        best = p.index(max(p))
        assert name == model.languages[best] and score == pytest.approx(p[best]) and accepted == (p[best] >= model.least[best])


# --- toxicity ---------------------------------------------------------------------------------------------


def plain_model(rows, prior_share=0.1, least_z=3.5):
    """Features with odds and z, and the calibration, in plain loops."""
    seen = defaultdict(set)
    for text, toxic in rows:
        words = [w for t in text.encode().lower().split() if (w := t.strip(toxicity.PUNCTUATION))]
        runs = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
        family = min(xxhash.xxh64_intdigest(r) for r in runs) >> 1
        for word in set(words):
            for feature in [word, *[word[:n] + b" " for n in toxicity.LENGTHS if n < len(word)]]:
                seen[feature].add((family, toxic))
    counts = {f: (sum(t for _, t in s), len(s)) for f, s in seen.items() if len(s) > 1}
    n_toxic, n_both = sum(t for t, _ in counts.values()), sum(b for _, b in counts.values())
    n_clean, prior = n_both - n_toxic, prior_share * n_both
    features = {}
    for feature, (toxic, both) in counts.items():
        alpha = both * prior / n_both
        a, b = toxic + alpha, both - toxic + alpha
        odds = math.log(a / (n_toxic + prior - a)) - math.log(b / (n_clean + prior - b))
        z = odds / math.sqrt(1 / a + 1 / b)
        if z >= least_z:
            features[feature] = (z, odds)
    hits_toxic = sum(counts[f][0] for f in features)
    hits_clean = sum(counts[f][1] - counts[f][0] for f in features)
    share_toxic, share_clean = hits_toxic / n_toxic, (hits_clean + 0.5) / (n_clean + 1)
    other = min(-0.02, math.log((1 - min(share_toxic, 0.9)) / (1 - share_clean)))
    by_score = Counter(round(s, 2) for _, s in features.values())
    shares = [(s, share_clean * n / len(features)) for s, n in by_score.items()] + [(other, 1 - share_clean)]
    return features, other, shares


def test_odds_and_calibration_equal_plain_loops(spark):
    pick = random.Random(4)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(500):
        words = pick.choices(vocabulary, k=pick.randint(20, 80))
        if i % 4 == 0:
            at = pick.randrange(len(words))
            words[at:at] = [pick.choice(["vileness", "vilest", "nasty!"]) for _ in range(3)]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id long, toxic int")
    model = toxicity.learn(docs, marks, per_label=100_000)
    import zlib

    learnt = [(t, x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    features, other, shares = plain_model(learnt)
    assert set(model.features) == set(features) and features
    for feature, (z, odds) in features.items():
        assert model.features[feature] == pytest.approx((z, odds))
    assert model.other == pytest.approx(other)
    # The scale is the root of the sum of the shares of scores, each grown by its score.
    assert sum(p * math.exp(model.scale * s) for s, p in shares) == pytest.approx(1, abs=1e-6)
    # At the calibrated curve the weighted gradient of the log-likelihood vanishes, but for the ridge.
    raw = toxicity.ToxicModel(model.features, model.other, model.scale, 1.0, 0.0, 0.0)
    points = [(raw.evidence(t.encode())[0], x) for t, x in learnt]
    inside = [(x, y) for x, y in points if x > toxicity.NO_EVIDENCE]
    toxic, clean, n = sum(y for _, y in inside), sum(1 - y for _, y in inside), len(inside)
    slope = offset = 0.0
    for x, y in inside:
        weight = n * (0.5 / max(1, toxic) if y else 0.5 / max(1, clean))
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * x + model.offset))))
        slope, offset = slope + weight * (p - y) * x, offset + weight * (p - y)
    assert slope + 1e-3 * n * model.slope == pytest.approx(0, abs=1e-4 * n)
    assert offset + 1e-3 * n * model.offset == pytest.approx(0, abs=1e-4 * n)
    outside = [y for x, y in points if x <= toxicity.NO_EVIDENCE]
    assert model.without == pytest.approx(min(0.5, (sum(outside) + 0.5) / (len(outside) + 1)))


# --- the pipeline ------------------------------------------------------------------------------------------


def test_pipeline_on_odd_rows(spark, sf_dir):
    """Nulls in every column, empty and very long texts and repeated rows go through all stages."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    long = " ".join(f"word{i % 9973} and{i % 7919}" for i in range(60_000))
    odd = [(None, None, None, None, None), (10**6, None, "en", "s", 0), (10**6 + 1, "", None, "s", None),
           (10**6 + 2, long, "en", None, len(long)), (10**6 + 3, long, "en", "s", len(long)),
           (10**6 + 4, "password=hunter2hunter2xyz", None, None, None), (10**6 + 4, "password=hunter2hunter2xyz", None, None, None)]
    docs = spark.createDataFrame(odd, given.schema).unionByName(given.limit(40))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == given.columns
    rows = docs.collect()
    assert sum(r["text"] == long for r in rows) == 1
    assert {r["doc_id"] for r in rows} >= {None, 10**6, 10**6 + 1, 10**6 + 2}
    assert not [r for r in rows if re.search("hunter2", r["text"] or "")]
    assert any(r["text"] == "[SECRET]" for r in rows)
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert len(encoded) == len(rows)
