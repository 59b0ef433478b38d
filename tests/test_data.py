"""Conversion, audits, profiles and layout on small tables, against brute force."""

import decimal
import math
import os
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegate.operators import audits, layout, profiles
from tidegate.operators.spec import SourceColumn, convert_table, fit, resolve
from tidegate.plans.migrate import migrate_table
from tidegate.plans.report import migration_report

D = decimal.Decimal
NUMBERS = [("6", "2"), ("10", "0"), ("25", "0"), ("15", "2"), ("", ""), ("3", "1"), ("17", "9"), ("5", "7"),
           ("38", "9"), ("38", "0"), ("30", "15"), ("4", "-2")]


def _expected(number: D, spark_type: str, round_to: int):
    """(converted, misfit, rounded) by exact decimal arithmetic."""
    with decimal.localcontext(prec=400):
        rounded = number.quantize(D(1).scaleb(-round_to), decimal.ROUND_HALF_UP)
        if spark_type == "bigint":
            fits = -(2**63) <= rounded < 2**63
        else:
            digits, scale = map(int, spark_type[8:-1].split(","))
            fits = abs(rounded) < D(10) ** (digits - scale)
        return (rounded if fits else None, not fits, fits and rounded != number)


def _round_to(column):
    if column.places is not None and column.places < 0:
        return column.places
    return 0 if column.spark_type == "bigint" else int(column.spark_type[8:-1].split(",")[1])


@pytest.mark.parametrize("precision, scale", NUMBERS)
def test_doubles_fit_as_decimals_do(spark, precision, scale):
    random.seed(5)
    values = [0.0, 0.07, 1.005, 9999.99, 9999.994, 9999.995, 9999.996, -9999.995, 1e13 - 0.005, 1e13 - 0.006, 0.5, 1.5,
              -2.5, 99.94, 99.95, 150.0, 49.99, 999949.9, 1e15, 9e18, 9.3e18, 1e28, 1e29, 2.0**63, 0.1234567891]
    values += [round(random.uniform(-1, 1) * 10 ** random.randint(0, 15), random.randint(0, 6)) for _ in range(1500)]
    column = resolve([SourceColumn("x", "NUMBER", precision, scale)])[0]
    frame = spark.createDataFrame([(v,) for v in [*values, math.nan, math.inf, None]], "x double")
    parts = fit(frame, column)
    rows = frame.select("x", parts.converted.alias("c"), parts.misfit.alias("m"), parts.rounded.alias("r")).collect()
    for row in rows:
        if row.x is None:
            assert (row.c, row.m, row.r) == (None, False, False)
        elif math.isnan(row.x) or math.isinf(row.x):
            assert (row.c, row.m, row.r) == (None, True, False)
        else:
            converted, misfit, rounded = _expected(D(repr(row.x)), column.spark_type, _round_to(column))
            assert (row.m, row.r) == (misfit, rounded), row
            assert (None if row.c is None else float(row.c)) == (None if converted is None else float(converted)), row


@pytest.mark.parametrize("precision, scale", NUMBERS)
def test_texts_and_integers_fit_as_decimals_do(spark, precision, scale):
    random.seed(6)
    column = resolve([SourceColumn("x", "NUMBER", precision, scale)])[0]
    texts = ["0", "1.5", "12345.678", "-99.95", "9999.995", "0.123456", "9" * 19, "9" * 25, "149", "150", "-1049"]
    texts += [str(round(random.uniform(-1e6, 1e6), random.randint(0, 5))) for _ in range(200)]
    frame = spark.createDataFrame([(t,) for t in [*texts, "abc", ""]], "x string")
    parts = fit(frame, column)
    for row in frame.select("x", parts.converted.alias("c"), parts.misfit.alias("m"), parts.rounded.alias("r")).collect():
        if row.x in ("abc", ""):
            assert (row.c, row.m, row.r) == (None, True, False)
        else:
            converted, misfit, rounded = _expected(D(row.x), column.spark_type, _round_to(column))
            assert (None if row.c is None else D(row.c), row.m, row.r) == (converted, misfit, rounded), row
    whole = [0, 5, -7, 99, 100, 149, 150, 9999, 10**6, 10**12, 2**63 - 1, -(2**63)]
    frame = spark.createDataFrame([(v,) for v in whole], "x long")
    parts = fit(frame, column)
    for row in frame.select("x", parts.converted.alias("c"), parts.misfit.alias("m"), parts.rounded.alias("r")).collect():
        converted, misfit, rounded = _expected(D(row.x), column.spark_type, _round_to(column))
        assert (None if row.c is None else D(row.c), row.m, row.r) == (converted, misfit, rounded), row


def test_numbers_too_long_for_spark_stay_text(spark):
    column = resolve([SourceColumn("x", "NUMBER", "50", "10")])[0]
    assert column.spark_type == "string"
    cases = {"9" * 40: (False, False), "9" * 41: (True, False), "1." + "1" * 10: (False, False),
             "1." + "1" * 11: (False, True), "1.10000000000": (False, False), "x": (True, False)}
    frame = spark.createDataFrame([(t,) for t in cases], "x string")
    parts = fit(frame, column)
    rows = frame.select("x", parts.misfit.alias("m"), parts.rounded.alias("r")).collect()
    assert {r.x: (r.m, r.r) for r in rows} == cases


def test_other_types(spark):
    spec = resolve(
        [SourceColumn("t", "TIMESTAMP(6)"), SourceColumn("f", "FLOAT"), SourceColumn("b", "RAW"), SourceColumn("s", "CLOB")]
    )
    frame = spark.createDataFrame([("2024-02-30", "1.5", "ab", "x"), ("2024-02-29 10:00:00", "z", None, None)], "t string, f string, b string, s string")
    rows = convert_table(frame, spec).collect()
    assert [tuple(r) for r in rows] == [(None, 1.5, bytearray(b"ab"), "x"), (datetime(2024, 2, 29, 10), None, None, None)]
    counts = {r.column_name: (r.nulls, r.misfits) for r in audits.fit_audit(frame, spec).collect()}
    assert counts == {"t": (0, 1), "f": (0, 1), "b": (1, 0), "s": (1, 0)}


def _skewed(spark, rows=9000):
    """A third of all rows under one key; some keys NULL."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 1000).alias("k"),
        (F.col("id") % 4).alias("line"),
        F.col("id"),
    )


def test_keys_under_skew(spark):
    frame = _skewed(spark)
    data = [(r.k, r.line) for r in frame.collect()]
    counts = Counter(data)
    got = {(r.k, r.line): (r.rows, r.reason) for r in audits.pk_audit(frame, ["k", "line"]).collect()}
    assert got == {
        key: (n, "null key" if key[0] is None else "duplicate key") for key, n in counts.items() if n > 1 or key[0] is None
    }
    got = {(r.k, r.line): r.rows for r in audits.unique_audit(frame, ["k", "line"]).collect()}
    assert got == {key: n for key, n in counts.items() if n > 1 and key[0] is not None}
    parent = spark.range(500).select(F.when(F.col("id") != 7, F.col("id")).alias("p")).union(spark.range(2).select(F.lit(3)))
    got = {r.k: r.orphan_rows for r in audits.fk_audit(frame, parent, {"k": "p"}).collect()}
    known = set(range(500)) - {7}
    assert got == {k: n for k, n in Counter(k for k, _ in data).items() if k is not None and k not in known}


def test_keys_reach_the_shuffle_already_counted(spark):
    audits.pk_audit(_skewed(spark), ["k"])
    plan = audits.fk_audit(_skewed(spark), _skewed(spark), {"k": "id"})._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_report_covers_every_rule(spark):
    spec = resolve(
        [
            SourceColumn("k", "NUMBER", "3", "0", nullable="N", primary_key="Y"),
            SourceColumn("amount", "NUMBER", "4", "1"),
            SourceColumn("name", "VARCHAR2", length="3"),
        ]
    )
    frame = spark.createDataFrame(
        [(1, 1.25, "abc"), (1, 5000.0, "abcd"), (None, 2.0, None), (4, -1.0, "x")], "k int, amount double, name string"
    )
    report = migration_report(
        frame,
        spec,
        unique={"name": ["name"]},
        parents={"parent": (spark.createDataFrame([(1,)], "id int"), {"k": "id"})},
        checks={"positive": "amount > 0"},
    )
    assert {(r.check, r.subject): r.violations for r in report.collect()} == {
        ("type", "k"): 0, ("rounding", "k"): 0, ("not null", "k"): 1, ("type", "amount"): 1, ("rounding", "amount"): 1,
        ("type", "name"): 0, ("rounding", "name"): 0, ("length", "name"): 1, ("check", "positive"): 1,
        ("primary key", "k"): 3, ("unique", "name"): 0, ("foreign key", "parent"): 1,
    }
    good, bad = audits.quarantine(frame, spec)
    assert sorted(r.k for r in good.collect()) == [1, 4]
    reasons = {r.k: r.reasons for r in bad.collect()}
    assert reasons == {1: ["amount: does not fit NUMERIC(4, 1)", "name: longer than 3"], None: ["k: null"]}


def test_wide_tables_are_counted_in_groups_of_columns(spark, monkeypatch):
    frame = spark.range(50).select(*[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(12)])
    spec = resolve([SourceColumn(f"c{i}", "NUMBER", "2", "1", nullable="N") for i in range(12)])
    whole = [tuple(r) for r in audits.fit_audit(frame, spec).collect()]
    report = sorted(tuple(r) for r in migration_report(frame, spec).collect())
    monkeypatch.setattr(audits, "COLUMNS_PER_SCAN", 5)
    assert sorted(tuple(r) for r in audits.fit_audit(frame, spec).collect()) == sorted(whole)
    assert sorted(tuple(r) for r in migration_report(frame, spec).collect()) == report
    assert [r[4] for r in whole] == [sum(i * n >= 10 for n in range(50)) for i in range(12)]


def test_every_row_is_loaded_or_rejected(spark, tmp_path):
    spec = resolve(
        [
            SourceColumn("id", "NUMBER", "10", "0", nullable="N", cluster="Y"),
            SourceColumn("at", "DATE", partition="Y"),
            SourceColumn("amount", "NUMBER", "3", "1"),
        ]
    )
    frame = spark.range(200).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).cast("timestamp_ntz").alias("at"),
        F.col("id").cast("double").alias("amount"),
    )
    loaded, rejected = str(tmp_path / "loaded"), str(tmp_path / "rejected")
    migrate_table(frame, spec, loaded, rejected, partitions=4)
    back = spark.read.parquet(loaded)
    assert len(_folders(loaded)) == 3 and dict(back.dtypes)["amount"] == "decimal(3,1)"
    good = [n for n in range(200) if n % 10 and n < 100]
    assert sorted(r.id for r in back.collect()) == good
    assert spark.read.parquet(rejected).count() == 200 - len(good)


def test_number_profile_needs(spark):
    frame = spark.createDataFrame([(0.0, "1", 5), (12.345, "-100.50", -70), (-7.5, "x", 3)], "d double, s string, n int")
    rows = {r.column_name: r for r in profiles.number_profile(frame, ["d", "s", "n"]).collect()}
    assert (rows["d"].precision, rows["d"].scale, rows["d"].type_text) == (5, 3, "NUMERIC(5, 3)")
    assert (rows["s"].precision, rows["s"].scale, rows["s"].unreadable) == (4, 1, 1)
    assert (rows["n"].precision, rows["n"].scale, rows["n"].type_text) == (2, 0, "INT64")


def _moments(spark, n=400):
    """Half the rows on one day, some without a timestamp."""
    day = F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 10)
    start = F.lit(datetime(2024, 1, 1))
    ts = F.when(F.col("id") % 40 != 39, (start + F.make_dt_interval(day, F.col("id") % 24)).cast("timestamp_ntz"))
    return spark.range(n).select("id", ts.alias("ts"), (F.col("id") % 5).alias("g"))


def _folders(path):
    return sorted(p for p in os.listdir(path) if p.startswith("day="))


def test_write_replace_and_read_days(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = _moments(spark)
    layout.write_by_day(frame, "ts", path)
    before = _folders(path)
    assert len(before) == 6
    assert spark.read.parquet(path).count() == 400
    with pytest.raises(Exception, match="already exists"):
        layout.write_by_day(frame, "ts", path)

    one_day = frame.filter("cast(ts as date) = '2024-01-04' and id < 10")
    layout.write_by_day(one_day, "ts", path, mode="replace_days")
    assert _folders(path) == before
    back = spark.read.parquet(path)
    assert back.filter("day = '2024-01-04'").count() == one_day.count()
    others = frame.filter("ts is null or cast(ts as date) <> '2024-01-04'").count()
    assert back.filter("day is null or day <> '2024-01-04'").count() == others

    part = layout.read_days(spark, path, "ts", date(2024, 1, 2), date(2024, 1, 3))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(ts)" in plan
    wanted = frame.filter("cast(ts as date) between '2024-01-02' and '2024-01-03'")
    assert sorted(r.id for r in part.collect()) == sorted(r.id for r in wanted.collect())

    layout.write_by_day(one_day, "ts", path, mode="overwrite")
    assert _folders(path) == ["day=2024-01-04"]


def test_expiry_keeps_rows_without_a_day(spark):
    frame = _moments(spark)
    kept = layout.expire_partitions(frame, "ts", date(2024, 1, 11), 5)
    assert kept.filter("ts is null").count() == frame.filter("ts is null").count() > 0
    assert kept.agg(F.min(F.to_date("ts"))).first()[0] == date(2024, 1, 6)
    gone = layout.expired_days(frame, "ts", date(2024, 1, 11), 5)
    assert kept.count() + gone.agg(F.sum("rows")).first()[0] == frame.count()


def test_cluster_layout_splits_a_hot_key(spark):
    frame = spark.range(20000).select("id", F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 100).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = layout.cluster_layout(frame, ["k"]).withColumn("p", F.spark_partition_id())
        spread = laid.filter("k = 1").groupBy("p").count().collect()
        bounds = laid.groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("p").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(spread) > 1
    assert all(a.hi <= b.lo for a, b in zip(bounds, bounds[1:]))
    assert laid.count() == 20000


def test_save_table_modes(spark):
    frame = spark.range(10).withColumn("day", F.lit(date(2024, 1, 1)))
    layout.save_table(frame, "moved", partition_by=["day"])
    with pytest.raises(Exception):
        layout.save_table(frame, "moved", partition_by=["day"])
    layout.save_table(frame.limit(3), "moved", create_or_replace=True, drop_first=True, partition_by=["day"])
    assert spark.table("moved").count() == 3
    layout.save_table(frame, "bucketed", cluster_by=["id"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed").join(spark.table("bucketed").withColumnRenamed("day", "d2"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_day_profile_reads_the_table_once(spark, sf_dir):
    profile = profiles.day_profile(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")
    profile.collect()
    assert "ReusedExchange" in profile._jdf.queryExecution().executedPlan().toString()
    assert abs(profile.agg(F.sum("share")).first()[0] - 1) < 1e-9


def test_values_are_rounded_once(spark):
    near = "2.4999999999"
    frame = spark.createDataFrame([(near, decimal.Decimal(near), float(near), "1.0000000001")], "a string, b decimal(20,10), c double, d string")
    spec = resolve([SourceColumn(c, "NUMBER", "5", "0") for c in "abc"] + [SourceColumn("d", "NUMBER", "10", "2")])
    row = convert_table(frame, spec).collect()[0]
    assert [int(row[c]) for c in "abc"] == [2, 2, 2]
    assert {r.column_name: r.rounded for r in audits.fit_audit(frame, spec).collect()} == {c: 1 for c in "abcd"}
    hundreds = spark.createDataFrame([("49.9999999999",), ("50",), ("-150.0001",), ("1e2",), (None,)], "n string")
    spec = resolve([SourceColumn("n", "NUMBER", "4", "-2")])
    assert [r.n and int(r.n) for r in convert_table(hundreds, spec).collect()] == [0, 100, -200, 100, None]
    assert audits.fit_audit(hundreds, spec).collect()[0].rounded == 3


def test_small_fractions_are_profiled(spark):
    frame = spark.createDataFrame(
        [(decimal.Decimal("0.000000000000123"), 1e-12, "0.00000000000012300", 1e-25, "1e-3")],
        "a decimal(38,18), b double, c string, d double, e string",
    )
    got = {r.column_name: (r["scale"], r.unreadable) for r in profiles.number_profile(frame, list("abcde")).collect()}
    assert got["a"] == (15, 0) and got["b"] == (12, 0) and got["c"] == (15, 0)
    assert got["d"][1] == got["e"][1] == 1


def test_helper_columns_never_replace_data(spark, tmp_path):
    frame = spark.createDataFrame([(datetime(2024, 1, 1), "mine", "why")], "ts timestamp_ntz, DAY string, Reasons string")
    spec = resolve([SourceColumn("DAY", "VARCHAR2", length="9")])
    for refused in (
        lambda: layout.write_by_day(frame, "ts", str(tmp_path / "x")),
        lambda: layout.cluster_layout(frame, ["DAY"], "ts"),
        lambda: audits.quarantine(frame, spec),
        lambda: convert_table(frame, spec),
    ):
        with pytest.raises(ValueError):
            refused()
    layout.write_by_day(frame, "ts", str(tmp_path / "y"), day="sold_on")
    assert spark.read.parquet(str(tmp_path / "y")).columns == ["ts", "DAY", "Reasons", "sold_on"]
    good, bad = audits.quarantine(frame, spec, "why")
    assert good.columns == frame.columns and bad.columns == [*frame.columns, "why"]
    assert convert_table(frame, spec, "keep").columns == ["DAY", "ts", "Reasons"]
    assert convert_table(frame, spec, "drop").columns == ["DAY"]
    with pytest.raises(ValueError):
        convert_table(frame, resolve([SourceColumn("gone", "DATE")]), "drop")


def test_bytes_have_a_length_and_audits_may_be_empty(spark):
    frame = spark.createDataFrame([(bytearray(b"123"),), (bytearray(b"123456"),)], "raw binary")
    spec = resolve([SourceColumn("raw", "RAW", length="3")])
    _, bad = audits.quarantine(frame, spec)
    assert [r.reasons for r in bad.collect()] == [["raw: longer than 3"]]
    for empty in (audits.not_null_audit(frame, spec), audits.length_audit(frame, spec), audits.check_audit(frame, {})):
        assert empty.count() == 0 and len(empty.columns) >= 3


def test_targets_are_looked_at_before_writing(spark, tmp_path):
    frame = spark.createDataFrame([(1,)], "n int")
    spec = resolve([SourceColumn("n", "NUMBER", "3", "0")])
    path, rejected = str(tmp_path / "t"), str(tmp_path / "r")
    frame.write.parquet(rejected)
    with pytest.raises(FileExistsError):
        migrate_table(frame, spec, path, rejected)
    assert not (tmp_path / "t").exists()
    with pytest.raises(ValueError):
        migrate_table(frame, spec, path, rejected, mode="replace_days")
