"""Load one table as its definition says: types, NOT NULL, lengths, partition and clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import layout
from tidegate.operators.audits import with_reasons
from tidegate.operators.spec import TargetColumn, check_columns, convert_table
from tidegate.session import shared_dir


def partition_column(spec: Sequence[TargetColumn]) -> str | None:
    """The first flagged column, if its type can partition by day."""
    flagged = [column for column in spec if column.partition]
    return flagged[0].name if flagged and flagged[0].target_type == "DATETIME" else None


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a table can be read there, by Spark's own readers."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def migrate_table(
    df: DataFrame,
    spec: Sequence[TargetColumn],
    path: str,
    rejected_path: str,
    mode: str = "errorifexists",
    partitions: int | None = None,
    undeclared: str = "error",
    reasons: str = "reasons",
) -> None:
    """Write the converted rows to ``path``, and rows that cannot be loaded, with their reasons, to
    ``rejected_path``: each row goes to exactly one of the two.

    The loaded table is partitioned by the day of the flagged partition column and clustered by the
    flagged clustering columns. Columns that the spec does not name are an error, or are dropped or
    kept, as ``undeclared`` says. ``replace_days`` replaces the loaded days that ``df`` has, and adds
    its rejected rows to those of earlier loads.

    Every rule is evaluated once: rows and reasons are written to the shared folder, and both tables
    are made from there. With ``errorifexists`` both targets are looked at before anything is written.
    """
    spark = df.sparkSession
    ts = partition_column(spec)
    check_columns(df, spec, undeclared)
    if mode == "replace_days" and not ts:
        raise ValueError("days can only be replaced in a table that is partitioned by day")
    if mode == "errorifexists" and (taken := [p for p in (path, rejected_path) if _exists(spark, p)]):
        raise FileExistsError(f"there is a table already: {', '.join(taken)}")
    staged = shared_dir(spark, "staged")
    with_reasons(df, spec, reasons).write.parquet(staged)
    marked = spark.read.parquet(staged)
    loadable, rejected = marked.filter(F.size(reasons) == 0).drop(reasons), marked.filter(F.size(reasons) > 0)
    converted = convert_table(loadable, spec, undeclared)
    cluster_by = [column.name for column in spec if column.cluster]
    if cluster_by:
        layout.write_clustered(converted, cluster_by, path, ts, mode, partitions)
    elif ts:
        layout.write_by_day(converted, ts, path, mode)
    else:
        converted.write.mode(mode).parquet(path)
    rejected.write.mode("append" if mode == "replace_days" else mode).parquet(rejected_path)
