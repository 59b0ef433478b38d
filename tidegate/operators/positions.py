"""Positions 1..n within groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_positions(
    df: DataFrame, group: list[str], order: list[str], bucket: Column, name: str = "column_id"
) -> DataFrame:
    """Number the rows of each group by ``order``, without one task holding a whole group.

    ``bucket`` must never fall as ``order`` rises. Rows are numbered within (group, bucket), then
    shifted by the row counts of the group's earlier buckets; only those counts meet per group.
    Group and bucket form one struct key: it matches NULLs, and the window, the counts and the join
    all partition by it, so the rows are shuffled once.
    """
    rest = [c for c in df.columns if c not in group]
    keyed = df.select(F.struct(*group, bucket.alias("_bucket")).alias("_key"), *rest)
    local = keyed.withColumn("_local", F.row_number().over(Window.partitionBy("_key").orderBy(*order)))
    owner = [F.col(f"_key.`{c}`") for c in group]
    earlier = Window.partitionBy(*owner).orderBy("_key._bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        keyed.groupBy("_key")
        .agg(F.count("*").alias("_rows"))
        .select("_key", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    )
    position = (F.col("_local") + F.col("_shift")).cast("bigint").alias(name)
    numbered = local.join(shifts, "_key")
    return numbered.select(
        *[F.col(f"_key.`{c}`").alias(c) if c in group else F.col(f"`{c}`") for c in df.columns], position
    )
