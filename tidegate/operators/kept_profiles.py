"""Profiles of stored tables that are kept beside them and brought up to date from new files only.

A profile is a folder of Parquet rows, each about one data file of the table: counts per date column and day, or
sketches of distinct values per day. An update reads the files that the profile does not know yet; a reading takes the
rows of the files that the table has now, so files that were dropped or replaced no longer count. Files are known
by their paths, which the writers of Spark never use twice. The driver holds the table's list of files, as it does for
any read.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.columns import MAX_CLUSTER_COLUMNS
from tidegate.operators.profiles import candidates_of, date_columns

COUNTS = "file string, column_name string, day date, rows long, first_at timestamp_ntz, last_at timestamp_ntz"
SKETCHES = "file string, day date, column_name string, rows long, sketch binary"


def _known(spark: SparkSession, store: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(store)
    except AnalysisException:  # there is no profile yet
        return spark.createDataFrame([], schema)


def _files(spark: SparkSession, table: str) -> list[str]:
    """The data files of a table, from listings alone."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table).inputFiles()


def _new_files(spark: SparkSession, table: str, store: str, schema: str) -> list[str]:
    files = _files(spark, table)
    known = {r["file"] for r in _known(spark, store, schema).select("file").distinct().collect()}
    return sorted(set(files) - known)


def _read(spark: SparkSession, table: str, files: Sequence[str]) -> DataFrame:
    """Some files of a table, with its partition columns and the path of each row's file as ``_file``."""
    rows = spark.read.option("basePath", table).parquet(*files)
    return rows.withColumn("_file", F.input_file_name())


def _current(spark: SparkSession, table: str, kept: DataFrame) -> DataFrame:
    files = spark.createDataFrame([(f,) for f in _files(spark, table)], "file string")
    return kept.join(files, "file", "left_semi")


def update_day_counts(spark: SparkSession, table: str, store: str) -> int:
    """Count the days of every date column in the files that the store does not know; return their number.

    One scan of the new files; a row per file, column and day is stored.
    """
    files = _new_files(spark, table, store, COUNTS)
    if not files:
        return 0
    rows = _read(spark, table, files)
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.to_date(F.col(f"`{c}`")).alias("day"),
            F.col(f"`{c}`").cast("timestamp_ntz").alias("at"),
        )
        for c in date_columns(rows)
    ]
    each = rows.select(F.col("_file").alias("file"), F.inline(F.array(*entries)))
    counted = each.groupBy("file", "column_name", "day").agg(
        F.count("*").alias("rows"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )
    counted.write.mode("append").parquet(store)
    return len(files)


def kept_day_profile(spark: SparkSession, table: str, store: str, ts: str) -> DataFrame:
    """``profiles.day_profile`` of a stored table, from its kept counts; first and last moment as timestamp_ntz."""
    kept = _current(spark, table, _known(spark, store, COUNTS)).filter(F.col("column_name") == ts)
    days = kept.groupBy("day").agg(
        F.sum("rows").alias("rows"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
    )
    overall = F.struct(F.sum("rows").alias("rows"), F.min("first_at"), F.max("last_at"))
    return days.withColumn("share", F.col("rows") / days.select(overall).scalar()["rows"])


def kept_partition_candidates(spark: SparkSession, table: str, store: str) -> DataFrame:
    """``profiles.partition_candidates`` of a stored table, from its kept counts."""
    kept = _current(spark, table, _known(spark, store, COUNTS))
    return candidates_of(kept.groupBy("column_name", "day").agg(F.sum("rows").alias("rows")))


def update_sketches(
    spark: SparkSession, table: str, store: str, ts: str, columns: Sequence[str], lg_k: int = 12
) -> int:
    """Sketch the distinct values of columns per day of ``ts``, in the files that the store does not know.

    A sketch has at most 2^lg_k registers, and a relative standard error of about 1.04 / sqrt(2^lg_k).
    """
    files = _new_files(spark, table, store, SKETCHES)
    if not files:
        return 0
    rows = _read(spark, table, files)
    values = [F.col(f"`{c}`").cast("string") for c in columns]
    sketches = [F.hll_sketch_agg(value, lg_k).alias(f"sketch_{i}") for i, value in enumerate(values)]
    grouped = rows.groupBy(F.col("_file").alias("file"), F.to_date(F.col(f"`{ts}`")).alias("day"))
    wide = grouped.agg(F.count("*").alias("rows"), *sketches)
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col("rows"), F.col(f"sketch_{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ]
    wide.select("file", "day", F.inline(F.array(*entries))).write.mode("append").parquet(store)
    return len(files)


def rank_kept_keys(
    spark: SparkSession, table: str, store: str, start: date, end: date, k: int = MAX_CLUSTER_COLUMNS
) -> DataFrame:
    """The ``k`` columns with the most distinct values on the days ``start`` to ``end``, from kept sketches.

    No data file is read; a sketch per file, day and column is.
    """
    kept = _current(spark, table, _known(spark, store, SKETCHES))
    some = kept.filter((F.col("day") >= F.lit(start)) & (F.col("day") <= F.lit(end)))
    counted = some.groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"), F.sum("rows").alias("rows")
    )
    return counted.orderBy(F.desc("distinct_values"), "column_name").limit(k)
