"""Near duplicates, components, archives and the pipeline."""

import base64
import gzip
import hashlib
import io
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegate.llm import minhash, queries, warc
from tidegate.llm.common import work_folder
from tidegate.llm.components import components


def direct_components(texts, size, percent):
    """Smallest id reachable over all linked pairs."""
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def found(rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}


@pytest.mark.parametrize("blocks", [400, 3])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, blocks):
    monkeypatch.setattr(minhash, "BLOCK_CLASSES", blocks)
    pick = random.Random(1)
    base = [[f"w{pick.randrange(3000)}" for _ in range(150)] for _ in range(4)]
    texts = {}
    for i in range(120):
        words = list(base[i % 4])
        for _ in range(pick.randrange(12)):
            words[pick.randrange(len(words))] = f"x{pick.randrange(60)}"
        texts[i * 3 + 1] = " ".join(words).upper() if i % 5 else " ".join(words)
    texts |= {0: None, 2: "", 5: "one two", 8: "One  TWO", 11: "one two three", 14: " \n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("component", F.lit("own"))
    assert found(minhash.near_duplicates(docs, 3, 85).collect()) == direct_components(texts, 3, 85)
    kept = minhash.drop_duplicates(docs, 3, 85)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, x in direct_components(texts, 3, 85).items() if x[2]}


def test_near_duplicates_on_the_table(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert found(queries.near_duplicates(spark, sf_dir).collect()) == direct_components(docs, 3, 85)


def test_near_duplicate_odd_rows(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, None), (3, "q " * 200_000)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gone_id", F.lit(1))
    got = minhash.near_duplicates(odd, 3, 85).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got) == Counter(
        {(1, 1, True): 2, (2, 1, False): 1, (None, None, True): 2, (3, 3, True): 1}
    )
    assert sorted(str(r["doc_id"]) for r in minhash.drop_duplicates(odd, 3, 85).collect()) == ["1", "1", "3", "None", "None"]
    assert minhash.near_duplicates(odd.limit(0), 3, 85).count() == 0


def test_estimates_follow_the_similarity():
    pick = np.random.default_rng(1)
    for similarity in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(60):
            shared = pick.integers(1, 1 << 63, int(1000 * similarity), dtype=np.uint64)
            own = pick.integers(1, 1 << 63, (2, (1000 - len(shared)) // 2), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([shared, x])) for x in own)
            packed = [np.frombuffer(minhash.pack(minhash.minima(s)), np.uint64) for s in (a, b)]
            errors.append(minhash.estimates(packed[0], packed[1][None])[0] - len(shared) / len(np.union1d(a, b)))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_components_of_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(60)] + [(100, j) for j in range(200, 230)] + [(7, 7), (300, 301), (301, 300)]
    got = components(spark.createDataFrame(edges, "a long, b long"), work_folder(spark), "c").collect()
    want = {i: 0 for i in range(61)} | {100: 100, 300: 300, 301: 300} | {j: 100 for j in range(200, 230)}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long"), work_folder(spark), "c").count() == 0


def direct_archive(pages, least):
    facts = [(p, (h or "").encode()) for p, h in pages]
    best = {}
    for p, payload in facts:
        if p is not None:
            best[payload] = max(p, best.get(payload, p))
    out = []
    for p, payload in facts:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        keeper = best.get(payload)
        revisit = p is not None and len(payload) >= least and keeper > p
        out.append((p, len(payload), digest, "revisit" if revisit else "response", keeper if revisit else None))
    return Counter(out)


def archived(rows):
    return Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows)


def test_archive_of_the_table(spark, sf_dir):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert archived(queries.warc_archive(spark, sf_dir).collect()) == direct_archive(pages, 0)


@pytest.mark.parametrize("least", [0, 3])
def test_archive_odd_rows_and_rolling(spark, least):
    rows = [(i * 1000 if i < 40 else i, f"http://a/{i} b", f"page {i % 7} é" * 50) for i in range(90)]
    rows += [(5, None, None), (6, "u", ""), (6, "u", ""), (None, None, "page 1 é" * 50), (None, "x", None), (1 << 60, "y", "zz"), (7, "y", "zz")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit("own"))
    folders = [work_folder(spark) for _ in range(2)]
    for folder, parts in zip(folders, (1, 5), strict=True):
        warc.write_archives(pages.repartition(parts), folder, shard_bytes=6000, roll_bytes=900, least_bytes=least)
        got = warc.read_archives(spark, folder)
        assert archived(got.collect()) == direct_archive([(p, h) for p, _, h in rows], least)
    manifests = [sorted(map(tuple, spark.read.schema(warc.MANIFEST).json(f"{f}/manifest").collect())) for f in folders]
    assert manifests[0] == manifests[1] and len({m[0] for m in manifests[0]}) > 2 and any(m[1] > 0 for m in manifests[0])


def test_archive_files_are_plain_gzip_and_checked(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x" * 100), (2, "http://b", "y")], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/archive"
    manifest = warc.write_archives(pages, folder).collect()
    path = tmp_path / "archive" / "records" / manifest[0]["name"]
    data = path.read_bytes()
    assert hashlib.sha256(data).hexdigest() == manifest[0]["sha256"] and len(data) == manifest[0]["bytes"]
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3
    assert not [p for p in path.parent.iterdir() if p.name.startswith(".pages") and not p.name.endswith(".crc")]
    record = next(m for m in warc.members(io.BytesIO(data)) if b"xxx" in m)
    assert warc.page_fields(*warc.parse(record))[:4] == (1, "http://a", "response", 100)
    with pytest.raises(ValueError):
        warc.parse(record.replace(b"xxx", b"xxy", 1))
    empty = f"file://{tmp_path}/empty"
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_pipeline_keeps_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("kept", F.lit("own"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert after.count() >= 0.8 * docs.count(), name
        docs = after
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert len(r["token_ids"]) == r["n_tokens"]


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_clustered_ids_are_cut_too(spark):
    ids = [-5, 1 << 61, *range(1_000_000, 1_000_400)]
    facts = spark.createDataFrame([(i, "d", 10) for i in ids], "page_id long, digest string, bytes long")
    ranges = warc.shard_ranges(facts, 200)
    placed = warc._with_shard(facts.withColumn("url", F.lit("u")), ranges).collect()
    sizes = Counter(r["shard"] for r in placed)
    assert set(sizes) == set(range(ranges.shards)) and max(sizes.values()) <= 20 and ranges.shards <= 30
    assert [r["shard"] for r in sorted(placed, key=lambda r: r["page_id"])] == sorted(r["shard"] for r in placed)


def _shards(spark, tmp_path, rows, shard_bytes):
    folder = f"file://{tmp_path}/archive"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages, folder, shard_bytes=shard_bytes, roll_bytes=1 << 20).collect()
    back = warc.read_archives(spark, folder).collect()
    assert len(back) == len(rows) == sum(r["records"] for r in manifest)
    return manifest, back


def test_headers_count_when_shards_are_cut(spark, tmp_path):
    manifest, _ = _shards(spark, tmp_path, [(i, f"http://a/{i}", None) for i in range(5000)], 100_000)
    assert len(manifest) >= 30 and max(r["records"] for r in manifest) <= 200


def test_pages_without_id_are_cut_though_they_are_equal(spark, tmp_path):
    rows = [(None, "http://a/", "same")] * 2000 + [(None, "http://b/", "same")] * 300 + [(i, "u", "x") for i in range(20)]
    manifest, back = _shards(spark, tmp_path, rows, 100_000)
    assert max(r["records"] for r in manifest) <= 300 and len(manifest) >= 15
    assert {r["record_type"] for r in back if r["page_id"] is None} == {"response"}
    uris = set()
    for file in (tmp_path / "archive" / "records").glob("*.warc.gz"):
        with file.open("rb") as stream:
            for member in warc.members(stream):
                headers, _ = warc.parse(member)
                assert headers["warc-record-id"] not in uris
                uris.add(headers["warc-record-id"])
