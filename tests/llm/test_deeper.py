"""Secrets behind prefixes and rarer encodings, recall of leaks by length, and quality by common words."""

import base64
import bz2
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidegate.llm import decontam, quality, secrets

KEY = "password=hunter2hunter2xyz"


def _spans(text):
    return secrets.scan(text)[1]


@pytest.mark.parametrize("prefix", ["", "path/", "my_", "a-", "x+", "/v1/", "KEY_", "ab", "abc", "abcd", "a/b_c-", "x=", "id:"])
@pytest.mark.parametrize("data", [KEY.encode(), b"{'user': 1, '" + KEY.encode() + b"'}"])
def test_prefixes_do_not_hide_base64(prefix, data):
    run = base64.b64encode(data).decode()
    text = f"see {prefix}{run} there"
    found = [s for s in _spans(text) if s[0] == "assign"]
    assert any(4 <= s <= 4 + len(prefix) and e == 4 + len(prefix) + len(run) for _, s, e in found)
    if prefix and prefix[-1] in "/_-+":
        plain = re.split(r"[/+]", run)[0] == run
        assert not plain or ("assign", 4 + len(prefix), 4 + len(prefix) + len(run)) in found
    assert run not in secrets.redacted(text)


def _raw(data):
    deflater = zlib.compressobj(9, zlib.DEFLATED, -15)
    return deflater.compress(data) + deflater.flush()


def _small(data, bits):
    deflater = zlib.compressobj(9, zlib.DEFLATED, bits)
    return deflater.compress(data) + deflater.flush()


@pytest.mark.parametrize(
    "pack",
    [bz2.compress, _raw, *[lambda d, b=b: _small(d, b) for b in range(9, 16)], lambda d: bz2.compress(d[:20]) + bz2.compress(d[20:]),
     lambda d: bz2.compress(zlib.compress(d)), lambda d: _raw(bz2.compress(d))],
)
@pytest.mark.parametrize("size", [0, 3000, 3_000_000])
def test_packed_secrets(pack, size):
    content = (b"lorem ipsum dolor " * (size // 18)) + KEY.encode() + b" end of the text"
    run = base64.b64encode(pack(content)).decode()
    assert any(k == "assign" and (s, e) == (2, 2 + len(run)) for k, s, e in _spans(f"x {run} y"))
    assert any(k == "assign" and e == 7 + len(run) for k, s, e in _spans(f"x path/{run} y"))


@pytest.mark.parametrize(
    "escape",
    [lambda c: f"\\U{ord(c):08x}", lambda c: f"\\u{{{ord(c):x}}}", lambda c: f"%u{ord(c):04X}", lambda c: f"\\u{ord(c):04x}"],
)
def test_escapes(escape):
    inner = "".join(map(escape, KEY))
    assert ("assign", 2, 2 + len(inner)) in _spans(f"é {inner} \\U0010ffff \\U00110000 \\u{{110000}}")
    half = f"pass{escape('w')}ord=hunter2hunter2xyz"
    assert ("assign", 1, 1 + len(half)) in _spans(f" {half}")


def test_places_through_several_layers():
    inner = "".join(f"%{b:02X}" for b in KEY.encode())
    text = f"a%20b \\u0041 {inner}\\u0042 c%2"
    place = text.index(inner)
    assert ("assign", place, place + len(inner) + 6) in _spans(text)


def test_character_maps_of_long_texts_are_small():
    text = "some plain words here, " * 170_000 + "%41 " + KEY + "\\u0041"
    tracemalloc.start()
    spans = _spans(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    start = text.index(KEY)
    assert ("assign", start, start + len(KEY)) in spans
    assert peak < 15 * len(text)


# --- leaks -------------------------------------------------------------------------------------------


def _copies(words, edits, pick):
    words = list(words)
    for _ in range(edits):
        at, kind = pick.randrange(len(words)), pick.randrange(3)
        words[at : at + (kind != 1)] = [] if kind == 2 else [f"new{pick.randrange(10**9)}"]
    return words


def _recall(searcher, items, pick, most):
    missed = total = 0
    texts, owners = [], []
    for number, words in items:
        for _ in range(most):
            edits = int(0.2 * len(words) + 1e-9)
            texts.append(" ".join(["before", *_copies(words, edits, pick), "after"]).encode())
            owners.append(number)
    for start in range(0, len(texts), 500):
        for owner, found in zip(owners[start : start + 500], searcher.search(texts[start : start + 500]), strict=True):
            total += 1
            missed += owner not in {m[0] for m in found}
    return 1 - missed / total


@pytest.mark.parametrize("length", [15, 16, 17, 18, 19, 20])
def test_recall_of_each_length(length):
    pick = random.Random(length)
    items = [(i, [f"w{i}x{j}" for j in range(n)]) for i, n in enumerate([*[length] * 10, 30, 40, 55])]
    searcher = decontam.Searcher([i for i, _ in items], [" ".join(w).encode() for _, w in items], 0.8, 0.99)
    assert min(searcher.measured.values()) >= 0.99
    assert _recall(searcher, items[:10], pick, 100) >= 0.985


def test_lengths_that_sampling_cannot_reach_are_searched_by_pieces():
    pick = random.Random(1)
    items = [(i, [f"w{i}x{j}" for j in range(n)]) for i, n in enumerate([5, 6, 7, 8, 9, 10, 12, 14, 16])]
    texts = [" ".join(w).encode() for _, w in items]
    searcher = decontam.Searcher([i for i, _ in items], texts, 0.8, 1.01)  # no sampling can
    assert searcher.pieces and set(searcher.measured.values()) == {1.0}
    assert _recall(searcher, items, pick, 100) == 1


@pytest.mark.parametrize("kind", ["int", "string", "long", "smallint"])
def test_item_ids_of_any_type(spark, kind):
    words = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([("7", words), (None, words + " more"), ("8", None)], "item_id string, text string")
    items = items.selectExpr(f"cast(item_id as {kind}) as item_id", "text")
    docs = spark.createDataFrame([(1, f"a {words} more b")], "doc_id long, text string")
    found = decontam.find_leaks(docs, items).collect()
    assert {None if r["item_id"] is None else str(r["item_id"]) for r in found} == {"7", None}
    assert decontam.find_leaks(docs, items).schema["item_id"].dataType == items.schema["item_id"].dataType
    assert all(r["recall"] >= 0.99 for r in found)


def test_long_documents_are_searched_whole(spark):
    words = " ".join(f"w{i}" for i in range(20))
    text = "filler text " * 100_000 + words + " filler text" * 100_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    row = decontam.find_leaks(docs, items).first()
    assert (row["first_word"], row["end_word"], row["edits"]) == (200_000, 200_020, 0)


# --- quality --------------------------------------------------------------------------------------------


def _language(pick, words, count):
    return " ".join(pick.choice(words) if pick.random() < 0.45 else "".join(pick.choices("abcdefghij", k=7)) for _ in range(count))


def _documents(pick):
    common = {"en": "the a of and to in is it on as".split(), "de": "der die das und zu ist es auf wie ein".split()}
    rows = [(i, _language(pick, common[lang], pick.choice([60, 120, 250, 500])), lang) for i, lang in enumerate(["en", "de"] * 150)]
    junk = [(1000 + i, " ".join("".join(pick.choices("abcdefghij", k=6)) for _ in range(200)), "en") for i in range(20)]
    other = [(2000 + i, _language(pick, ["og", "er", "det", "som"], 200), "da") for i in range(1)]
    return rows, junk, other


def test_texts_without_common_words_are_rejected(spark):
    rows, junk, other = _documents(random.Random(8))
    docs = spark.createDataFrame(rows + junk + other, "doc_id long, text string, lang string")
    references = quality.learn(docs, language_share=0.02)
    got = {r["doc_id"]: r for r in quality.judge(docs, references).collect()}
    assert not any(got[i]["kept"] for i, _, _ in junk)
    assert not any(got[i]["word_distance"] <= got[i]["word_limit"] for i, _, _ in junk)
    assert sum(got[i]["kept"] for i, _, _ in rows) >= 0.99 * len(rows)
    # A language too rare for a reference is not judged by its words.
    assert references.languages == ["de", "en"] and got[2000]["word_limit"] == 1.0 and got[2000]["kept"]
    assert not {r["doc_id"]: r["kept"] for r in quality.judge(docs.drop("lang"), references).collect()}[2000]


def _direct(rows, least_words=50, least_chars=200, word_share=0.002, language_share=0.02, quantile=0.999, most=0.985, classes=0.30):
    """Distances and verdicts in plain loops."""
    words, chars = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang in rows:
        words[lang].update(text.lower().split())
        chars[lang].update(map(_class, text))
    everything = sum(c.total() for c in words.values())
    langs = sorted(x for x in words if words[x].total() >= language_share * everything)
    common = {x: {w: n / words[x].total() for w, n in words[x].items() if n >= word_share * words[x].total()} for x in langs}
    shares = {x: {c: n / chars[x].total() for c, n in chars[x].items()} for x in langs}

    def apart(p, q):
        total = 0.0
        for key in {*p, *q}:
            a, b = p.get(key, 0.0), q.get(key, 0.0)
            m = (a + b) / 2
            total += (a * math.log2(a / m) if a > 0 else 0) + (b * math.log2(b / m) if b > 0 else 0)
        return math.sqrt(max(0.0, total / 2))

    def full(x):
        return common[x] | {None: 1 - sum(common[x].values())}

    judged = {}
    for doc_id, text, lang in rows:
        tokens = text.lower().split()
        found = []
        for x in langs:
            own = Counter(w for w in tokens if w in common[x])
            own = {w: n / len(tokens) for w, n in own.items()}
            found.append((apart(own | {None: 1 - sum(own.values())}, full(x)), x))
        distance, nearest = min(found)
        counts = Counter(map(_class, text))
        by_class = apart({c: n / counts.total() for c, n in counts.items()}, shares[nearest])
        judged[doc_id] = (nearest, distance, by_class, len(tokens), sum(map(len, tokens)), lang)
    limits = {}
    for x in langs:
        none = apart({None: 1.0}, full(x))
        for band in range(len(quality.BANDS)):
            steps = sorted(int(d * 1000) for n, d, _, size, _, lang in judged.values()
                           if n == lang == x and size >= 50 and quality.band(size) == band)
            limits[x, band] = most * none
            if steps:
                at = next(s for i, s in enumerate(steps) if sum(t <= s for t in steps) >= quantile * len(steps))
                limits[x, band] = min(limits[x, band], (at + 1) / 1000)
    out = {}
    for doc_id, (nearest, distance, by_class, size, letters, lang) in judged.items():
        limit = limits[nearest, quality.band(size)] if lang in langs else 1.0
        out[doc_id] = (nearest, distance, by_class, not (size >= least_words and distance > limit) and not (letters >= least_chars and by_class > classes))
    return out


def _class(c):
    if c.isalpha():
        return "lower" if c.islower() else "upper"
    return "space" if c in " \t" else c


def test_distances_and_verdicts_equal_direct(spark, monkeypatch):
    monkeypatch.setattr(quality, "PASS_BYTES", 5000)
    rows, junk, other = _documents(random.Random(9))
    rows = rows[:120] + junk + other
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality.judge(docs, quality.learn(docs, language_share=0.02)).collect()
    want = _direct(rows)
    for r in got:
        nearest, distance, by_class, kept = want[r["doc_id"]]
        assert r["nearest"] == nearest
        assert r["word_distance"] == pytest.approx(distance, abs=1e-7)
        assert r["class_distance"] == pytest.approx(by_class, abs=1e-7)
        assert r["kept"] == (kept and not r["base_failed"])


def test_clean_documents_of_the_given_table_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = quality.judge(docs, quality.learn(docs)).collect()
    assert all(r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"])
    assert np.isfinite([r["word_limit"] for r in rows]).all()


def test_raw_deflated_run_longer_than_a_window(monkeypatch):
    """Headerless data is inflated whatever the length of its run."""
    import random

    from tidegate.llm import secrets as scanner

    monkeypatch.setattr(scanner, "WINDOW", 1 << 18)
    letters = "".join(random.Random(5).choices("bcdghjklmnoqrtuvwxyz \n", k=700_000))
    content = f"{letters[:600_000]} AKIA{'Q7' * 9} {letters[600_000:]}".encode()
    deflater = zlib.compressobj(9, zlib.DEFLATED, -15)
    run = base64.b64encode(deflater.compress(content) + deflater.flush()).decode()
    assert len(run) > scanner.WINDOW
    assert "AKIA" not in "".join(scanner._windows(scanner._decoded([run])))
    assert any("AKIA" in text for text in scanner._content(run))
