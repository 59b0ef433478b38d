"""Profiles that are kept beside a table, replaced days, and bitmaps of keys."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegate.operators import audits, kept_profiles, layout, profiles

SCHEMA = "id long, ts timestamp_ntz, on_day date, k string"


def _frame(spark, seed, days, count=300):
    rng = random.Random(seed)
    rows = [
        (
            rng.randint(0, 10**9),
            None if rng.random() < 0.05 else datetime(2024, 1, 1) + timedelta(days=rng.choice(days), seconds=rng.randint(0, 86399)),
            None if rng.random() < 0.3 else date(2024, 2, 1) + timedelta(days=rng.randint(0, 5)),
            f"k{rng.randint(0, 40)}",
        )
        for _ in range(count)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def _rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_kept_profiles_equal_full_ones(spark, tmp_path):
    path, store = str(tmp_path / "table"), str(tmp_path / "store")
    layout.write_by_day(_frame(spark, 1, range(5)), "ts", path)
    assert kept_profiles.update_day_counts(spark, path, store) > 0
    layout.write_by_day(_frame(spark, 2, range(3, 9)), "ts", path, mode="append")
    assert kept_profiles.update_day_counts(spark, path, store) > 0
    # Replaced days: their old files go, and so must their counts.
    layout.write_by_day(_frame(spark, 3, [4, 5]), "ts", path, mode="replace_days")
    layout.write_by_day(_frame(spark, 4, [7]).filter("ts is not null"), "ts", path, mode="replace_days")
    assert kept_profiles.update_day_counts(spark, path, store) > 0
    assert kept_profiles.update_day_counts(spark, path, store) == 0
    full = spark.read.parquet(path)
    assert _rows(kept_profiles.kept_day_profile(spark, path, store, "ts")) == _rows(profiles.day_profile(full, "ts"))
    assert _rows(kept_profiles.kept_partition_candidates(spark, path, store)) == _rows(profiles.partition_candidates(full))


def test_an_update_reads_new_files_only(spark, tmp_path):
    path, store = tmp_path / "table", str(tmp_path / "store")
    layout.write_by_day(_frame(spark, 1, range(3)).filter("ts is not null"), "ts", str(path))
    kept_profiles.update_day_counts(spark, str(path), store)
    old = [f for f in path.glob("day=*/*.parquet")]
    for file in old:  # nothing may open them again
        file.write_bytes(b"damaged")
    layout.write_by_day(_frame(spark, 2, [9]).filter("ts is not null"), "ts", str(path), mode="append")
    assert kept_profiles.update_day_counts(spark, str(path), store) >= 1
    assert kept_profiles.kept_day_profile(spark, str(path), store, "ts").count() == 4


def test_kept_sketches_are_close(spark, tmp_path):
    path, store = str(tmp_path / "table"), str(tmp_path / "store")
    columns = ["id", "k", "on_day"]
    for seed in (1, 2):
        layout.write_by_day(_frame(spark, seed, range(10), 3000), "ts", path, mode="append")
        kept_profiles.update_sketches(spark, path, store, "ts", columns)
    some = spark.read.parquet(path).filter("ts >= '2024-01-03' AND ts < '2024-01-07'")
    exact = some.agg(*[F.countDistinct(c).alias(c) for c in columns]).first()
    ranked = kept_profiles.rank_kept_keys(spark, path, store, date(2024, 1, 3), date(2024, 1, 6)).collect()
    assert [r.column_name for r in ranked] == sorted(columns, key=lambda c: -exact[c])
    # Three standard errors of sketches with 4,096 registers.
    assert all(abs(r.distinct_values - exact[r.column_name]) <= max(1, 0.05 * exact[r.column_name]) for r in ranked)
    assert {r.rows for r in ranked} == {some.count()}
    plan = kept_profiles.rank_kept_keys(spark, path, store, date(2024, 1, 3), date(2024, 1, 6))
    assert str(tmp_path / "table") not in plan._jdf.queryExecution().executedPlan().toString()


# --- replaced days ---------------------------------------------------------------------------------------


class Lost(Exception):
    pass


def _table(spark, tmp_path):
    path = str(tmp_path / "table")
    old = _frame(spark, 1, range(4)).withColumn("k", F.lit("old"))
    layout.write_by_day(old, "ts", path)
    new = _frame(spark, 2, [1, 2, 6]).withColumn("k", F.lit("new"))
    return path, layout.with_day(new, "ts"), _rows(spark.read.parquet(path))


def _after(spark, path, before, new):
    days = {r.day for r in new.select("day").distinct().collect()}
    place = spark.read.parquet(path).columns.index("day")
    return sorted([*[r for r in before if r[place] not in days], *_rows(new)], key=str)


def test_a_driver_lost_before_the_commit_leaves_the_old_days(spark, tmp_path):
    path, new, before = _table(spark, tmp_path)
    table = layout.DayFolders(spark, path)
    table.stage(new, "day")
    assert _rows(spark.read.parquet(path)) == before
    assert _rows(table.open()) == before
    layout.replace_day_folders(new, path)
    assert _rows(table.open()) == _after(spark, path, before, new)


@pytest.mark.parametrize("moves", range(8))
def test_a_driver_lost_after_the_commit_leaves_the_new_days(spark, tmp_path, monkeypatch, moves):
    path, new, before = _table(spark, tmp_path)
    table, done = layout.DayFolders(spark, path), []
    table.commit(table.stage(new, "day"))
    move = layout.DayFolders._move

    def some(self, source, target):
        if len(done) == moves:
            raise Lost
        done.append(target)
        move(self, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(layout.DayFolders, "_move", some)
        with pytest.raises(Lost):
            table.finish()
            raise Lost
    expected = _after(spark, path, before, new)
    assert _rows(layout.DayFolders(spark, path).open()) == expected
    assert _rows(spark.read.parquet(path)) == expected
    assert not [p for p in (tmp_path / "table").iterdir() if p.name.startswith(("_staged", "_old", "_replace", "_draft"))]


def test_readers_finish_what_is_committed(spark, tmp_path):
    path, new, before = _table(spark, tmp_path)
    table = layout.DayFolders(spark, path)
    table.commit(table.stage(new, "day"))
    got = layout.read_days(spark, path, "ts", date(2024, 1, 1), date(2024, 1, 31))
    assert {r.k for r in got.filter("day = '2024-01-02'").collect()} == {"new"}


def test_replaced_days_may_come_from_the_table_itself(spark, tmp_path):
    path, _, before = _table(spark, tmp_path)
    layout.replace_day_folders(spark.read.parquet(path).filter("day = '2024-01-02'").withColumn("k", F.lit("again")), path)
    after = _rows(spark.read.parquet(path))
    assert len(after) == len(before) and {r[3] for r in after if str(r[4]) == "2024-01-02"} == {"again"}


# --- bitmaps of keys ----------------------------------------------------------------------------------------


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_find_the_same_orphans(spark):
    rng = random.Random(6)
    keys = [None, 0, 1, -1, 7, 8, 32767, 32768, 32769, 65536, -32768, -32769, 2**40, -(2**40), 2**63 - 1, -(2**63)]
    child = spark.createDataFrame([(rng.choice(keys), i) for i in range(400)], "k long, i int")
    parent = spark.createDataFrame([(k,) for k in keys[::2]] + [(keys[1],)] * 3, "p long")
    plain = _rows(audits.fk_audit(child, parent, {"k": "p"}))
    assert _rows(audits.fk_audit(child, parent, {"k": "p"}, bitmap_bytes=1 << 20)) == plain and len(plain) > 3
    clean = audits.fk_audit(child.filter("k = 7"), parent, {"k": "p"}, bitmap_bytes=1 << 20)
    assert clean.count() == (0 if 7 in keys[::2] else 1)


def test_bitmaps_have_a_size_bound_and_save_the_shuffle(spark):
    child = spark.range(20_000).select((F.col("id") % 5000).alias("k"))
    parent = spark.range(100_000).select(F.col("id").alias("p"))
    used = audits.fk_audit(child, parent, {"k": "p"}, bitmap_bytes=5 * 4096)
    assert "bitmap" in _plan(used).lower()
    assert "bitmap" not in _plan(audits.fk_audit(child, parent, {"k": "p"}, bitmap_bytes=4 * 4096)).lower()
    assert "bitmap" not in _plan(audits.fk_audit(child.select(F.col("k").cast("string")), parent, {"k": "p"}, bitmap_bytes=1 << 20)).lower()
    assert used.count() == 0
