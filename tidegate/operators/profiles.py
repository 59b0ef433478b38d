"""Profiles that choose types, partitions and clustering keys from the data itself."""

from __future__ import annotations

import decimal
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import types
from tidegate.operators.columns import MAX_CLUSTER_COLUMNS


def _unpivot(one_row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    structs = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{f}_{i}").alias(f) for f in fields])
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*structs)))


def day_profile(df: DataFrame, ts: str) -> DataFrame:
    """Per day of ``ts``: rows, first and last moment, share of all rows. NULL is a day of its own.

    Days are counted before the shuffle. The total is a subquery over the same shuffled counts; it
    asks for every aggregate so that its plan stays the same (ReusedExchange) and the table is read
    once.
    """
    days = df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("rows"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at")
    )
    overall = F.struct(F.sum("rows").alias("rows"), F.min("first_at"), F.max("last_at"))
    return days.withColumn("share", F.col("rows") / days.select(overall).scalar()["rows"])


def date_columns(df: DataFrame) -> list[str]:
    """The columns that could partition a table by day."""
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, dated)]
    if not columns:
        raise ValueError("no date or timestamp column")
    return columns


def partition_candidates(df: DataFrame) -> DataFrame:
    """Every date or timestamp column as a partition column: days, rows per day, NULL rows, and
    its rank (fewest NULLs, then most days).

    All candidate columns in one scan: each row gives one (column, day) per candidate, and these
    are counted before the shuffle.
    """
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.to_date(F.col(f"`{c}`")).alias("day")) for c in date_columns(df)
    ]
    per_day = df.select(F.inline(F.array(*entries))).groupBy("column_name", "day").agg(F.count("*").alias("rows"))
    return candidates_of(per_day)


def candidates_of(per_day: DataFrame) -> DataFrame:
    """Candidate columns, ranked, from (column_name, day, rows)."""
    has_day = F.col("day").isNotNull()
    counted = per_day.groupBy("column_name").agg(
        F.count("day").alias("days"),
        F.coalesce(F.min(F.when(has_day, F.col("rows"))), F.lit(0)).alias("min_rows_per_day"),
        F.coalesce(F.max(F.when(has_day, F.col("rows"))), F.lit(0)).alias("max_rows_per_day"),
        F.coalesce(F.sum(F.when(~has_day, F.col("rows"))), F.lit(0)).alias("null_rows"),
    )
    # One row per candidate column is ranked.
    order = Window.orderBy("null_rows", F.desc("days"), "column_name")
    return counted.withColumn("rank", F.row_number().over(order).cast("bigint"))


def rank_cluster_keys(
    df: DataFrame, columns: Sequence[str], k: int = MAX_CLUSTER_COLUMNS, exact: bool = False
) -> DataFrame:
    """The ``k`` columns with the most distinct values.

    By default one scan with a fixed-size sketch per column. ``exact`` counts every value: the
    (column, value) pairs are made distinct before and after one shuffle that is spread by value,
    so neither a hot value nor a wide column lands in one task.
    """
    if not exact:
        sketches = [F.approx_count_distinct(F.col(f"`{c}`")).alias(f"distinct_values_{i}") for i, c in enumerate(columns)]
        counted = _unpivot(df.agg(*sketches), columns, ["distinct_values"])
    else:
        entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
        pairs = df.select(F.inline(F.array(*entries))).distinct()
        counted = pairs.groupBy("column_name").agg(F.count("value").alias("distinct_values"))
    return counted.orderBy(F.desc("distinct_values"), "column_name").limit(k)


# What a double or a text is read as: 20 digits before the point and 18 after it.
PROFILE_TYPE = T.DecimalType(38, 18)
# Fraction digits that double arithmetic settles by itself.
TESTED_PLACES = 9


def _number_needs(df: DataFrame, name: str) -> tuple[Column, Column, Column]:
    """(absolute value or NULL when unreadable, fraction digits, unreadable) for one column.

    Digits are counted on the value itself: a decimal in its own type, a text in the text, a double
    by arithmetic and, where nine places don't settle it, in its decimal form. A double or text
    with more than 18 fraction digits, or 1e19 and more, is unreadable.
    """
    value, source = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(source, T.IntegralType):
        return F.abs(value.cast("decimal(20,0)")), F.lit(0), F.lit(False)
    if isinstance(source, T.DecimalType):
        return F.abs(value), _fraction_digits(value.cast("string")) if source.scale else F.lit(0), F.lit(False)
    exact = value.try_cast(PROFILE_TYPE)
    if isinstance(source, (T.DoubleType, T.FloatType)):
        value = value.cast("double")
        scale = F.when(F.rint(value) == value, 0)
        for places in range(1, TESTED_PLACES):
            power = F.lit(10.0**places)
            scale = scale.when(F.rint(value * power) / power == value, places)
        settled = scale.isNotNull() | (exact.cast("double") == value)
        readable = ~F.isnan(value) & (F.abs(value) < F.lit(1e19)) & F.coalesce(settled, F.lit(False))
        fraction = F.coalesce(scale, _fraction_digits(exact.cast("string")))
        return F.when(readable, F.abs(value)), fraction, value.isNotNull() & ~readable
    text = F.trim(value.cast("string"))
    plain = text.rlike(r"\A[+-]?[0-9]*(\.[0-9]{0,18}0*)?\z")
    readable = plain & (F.abs(exact) < F.lit(decimal.Decimal(10**19)))
    return F.when(readable, F.abs(exact)), _fraction_digits(text), value.isNotNull() & ~F.coalesce(readable, F.lit(False))


def _fraction_digits(text: Column) -> Column:
    """Digits after the point of a plain decimal text, without closing zeros."""
    digits = F.when(text.contains("."), F.substring_index(text, ".", -1)).otherwise("")
    return F.char_length(F.rtrim(digits, F.lit("0")))


def number_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column: the digits needed before and after the point, and the type they give.

    Settles columns whose source type names no precision. ``unreadable`` counts values
    that cannot be settled; the needed digits then describe the readable rest only. The largest value alone
    decides the whole digits, so text is made once per column, not per row.
    """
    aggregates: list[Column] = []
    for place, name in enumerate(columns):
        number, fraction, unreadable = _number_needs(df, name)
        aggregates += [
            F.max(number).alias(f"largest_{place}"),
            F.max(F.when(number.isNotNull(), fraction)).cast("bigint").alias(f"scale_{place}"),
            F.count_if(unreadable).alias(f"unreadable_{place}"),
        ]
    totals = df.agg(*aggregates)
    for place in range(len(columns)):
        largest = F.col(f"largest_{place}")
        if isinstance(totals.schema[f"largest_{place}"].dataType, T.DoubleType):
            largest = largest.cast(PROFILE_TYPE)
        whole = F.substring_index(largest.cast("string"), ".", 1)
        totals = totals.withColumn(f"whole_{place}", F.char_length(F.ltrim(whole, F.lit("0"))).cast("bigint"))
    tall = _unpivot(totals, columns, ["whole", "scale", "unreadable"])
    precision = F.greatest(F.col("whole") + F.col("scale"), F.lit(1).cast("bigint"))
    settled = tall.select("column_name", precision.alias("precision"), "scale", "unreadable")
    target = types.target_type(F.lit("NUMBER"), F.col("precision"), F.col("scale"))
    none = F.lit(None).cast("bigint")
    return settled.withColumn("target_type", target).withColumn(
        "type_text", types.type_text(F.col("target_type"), F.col("precision"), F.col("scale"), none)
    )
