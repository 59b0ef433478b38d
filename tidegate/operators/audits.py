"""Audits of table data against what the target declares but does not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import escape_description
from tidegate.operators.layout import refuse_clash
from tidegate.operators.spec import TargetColumn, fit


# Columns counted by one aggregate. Generated code for more grows past what the JVM compiles; with
# a columnar source, several scans of disjoint columns read no more than one scan of all of them.
COLUMNS_PER_SCAN = 50


def _tall(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn the one row of a wide aggregate into one row per mapping."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))


def count_tall(df: DataFrame, rows: Sequence[Mapping[str, object]], schema: str) -> DataFrame:
    """One output row per mapping. Text and numbers in a mapping are constants, columns are
    aggregates over ``df``; all of them come from one scan per ``COLUMNS_PER_SCAN`` rows, and a row
    per task is all that is shuffled. Without mappings the result is empty, with the schema."""
    if not rows:
        return df.sparkSession.createDataFrame([], schema)
    parts = []
    for start in range(0, len(rows), COLUMNS_PER_SCAN):
        chunk = rows[start : start + COLUMNS_PER_SCAN]
        aggregates, shown = [], []
        for place, row in enumerate(chunk):
            cells = {}
            for name, value in row.items():
                if isinstance(value, Column):
                    aggregates.append(value.alias(f"{name}_{place}"))
                    cells[name] = F.col(f"{name}_{place}")
                else:
                    cells[name] = F.lit(value)
            shown.append(cells)
        parts.append(_tall(df.agg(*aggregates), shown))
    return reduce(DataFrame.unionByName, parts)


def fit_audit(df: DataFrame, spec: Sequence[TargetColumn]) -> DataFrame:
    """Per column: rows, nulls, values that do not fit the target type, values rounded to fit."""
    rows = []
    for column in spec:
        value = fit(df, column)
        rows.append(
            {
                "column_name": column.name,
                "target_type": column.type_text,
                "rows": F.count("*"),
                "nulls": F.count_if(F.col(f"`{column.name}`").isNull()),
                "misfits": F.count_if(value.misfit),
                "rounded": F.count_if(value.rounded),
            }
        )
    return count_tall(df, rows, "column_name string, target_type string, rows long, nulls long, misfits long, rounded long")


def text_columns(df: DataFrame, spec: Sequence[TargetColumn]) -> list[TargetColumn]:
    return [c for c in spec if c.target_type == "STRING" and isinstance(df.schema[c.name].dataType, T.StringType)]


def too_long(column: TargetColumn) -> Column:
    """Texts count in characters, binary values in bytes."""
    if column.length is None:
        return F.lit(False)
    value = F.col(f"`{column.name}`")
    size = F.octet_length(value) if column.target_type == "BYTES" else F.char_length(value)
    return F.coalesce(size > column.length, F.lit(False))


def length_audit(df: DataFrame, spec: Sequence[TargetColumn]) -> DataFrame:
    """Per text column: declared length, longest value in characters and bytes, rows too long."""
    rows = []
    for column in text_columns(df, spec):
        value = F.col(f"`{column.name}`")
        rows.append(
            {
                "column_name": column.name,
                "declared_length": F.max(F.lit(column.length).cast("bigint")),
                "max_chars": F.max(F.char_length(value)).cast("bigint"),
                "max_bytes": F.max(F.octet_length(value)).cast("bigint"),
                "rows_over": F.count_if(too_long(column)),
            }
        )
    return count_tall(df, rows, "column_name string, declared_length long, max_chars long, max_bytes long, rows_over long")


def not_null_audit(df: DataFrame, spec: Sequence[TargetColumn]) -> DataFrame:
    """Per column declared NOT NULL: rows and NULLs."""
    rows = []
    for column in spec:
        if not column.nullable:
            nulls = F.count_if(F.col(f"`{column.name}`").isNull())
            rows.append({"column_name": column.name, "rows": F.count("*"), "nulls": nulls})
    return count_tall(df, rows, "column_name string, rows long, nulls long")


def _any_null(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for key in keys:
        found = found | F.col(f"`{key}`").isNull()
    return found


def pk_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key, with their row count and the reason.

    One shuffle of the key columns only. Counts combine before it, so a key that holds a third of
    all rows arrives as one row per task.
    """
    reason = F.when(_any_null(keys), "null key").when(F.col("rows") > 1, "duplicate key")
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
    )


def unique_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; rows with a NULL in the key do not count."""
    return (
        df.filter(~_any_null(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
    )


def fk_audit(
    child: DataFrame, parent: DataFrame, pairs: Mapping[str, str], bitmap_bytes: int = 0
) -> DataFrame:
    """Child keys without a parent row, with the number of orphan rows of each.

    Both sides are reduced to distinct keys before they meet, so a hot key is one row on each
    side, and the anti join reuses the partitioning of both aggregates.

    ``bitmap_bytes`` is for a key of one integer column: if a bitmap of the parent's keys takes no more, it goes to
    every task, and only child rows whose bit is not set are counted and shuffled, none where the reference holds.
    Its size is counted first, in a scan of the parent's key.
    """
    child_keys, parent_keys = list(pairs.keys()), list(pairs.values())
    rows = child.filter(~_any_null(child_keys))
    if bitmap_bytes and len(pairs) == 1 and _integers(child, child_keys) and _integers(parent, parent_keys):
        known = key_bitmaps(parent, parent_keys[0])
        if known.select("_bucket").distinct().count() * BITMAP_BYTES <= bitmap_bytes:
            rows = without_known(rows, child_keys[0], known)
    counted = rows.groupBy(*child_keys).agg(F.count("*").alias("orphan_rows"))
    known = parent.filter(~_any_null(parent_keys)).select(*parent_keys).distinct()
    match = [counted[c] == known[p] for c, p in pairs.items()]
    return counted.join(known, match, "left_anti")


# Bytes of one bitmap, a constant of Spark's bitmap functions: eight keys each.
BITMAP_BYTES = 4096


def _integers(df: DataFrame, columns: Sequence[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """``_bucket, _bits``: the keys of an integer column as bitmaps of 32,768 keys."""
    value = F.col(f"`{key}`").cast("bigint")
    keyed = df.filter(value.isNotNull()).select(
        F.bitmap_bucket_number(value).alias("_bucket"), F.bitmap_bit_position(value).alias("_bit")
    )
    return keyed.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def without_known(df: DataFrame, key: str, bitmaps: DataFrame) -> DataFrame:
    """Rows whose key has no bit; the bitmaps go to every task, so their size must have been checked."""
    value = F.col(f"`{key}`").cast("bigint")
    place = F.bitmap_bit_position(value)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    unset = F.col("_bits").isNull() | (F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 0)
    joined = df.join(F.broadcast(bitmaps), F.bitmap_bucket_number(value) == F.col("_bucket"), "left")
    return joined.filter(unset).drop("_bucket", "_bits")


def check_audit(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Per named condition (Spark SQL): rows that violate it, and rows where it is unknown.

    As in SQL, an unknown condition passes.
    """
    rows = []
    for name, condition in checks.items():
        holds = F.expr(condition)
        rows.append(
            {
                "check_name": name,
                "rows": F.count("*"),
                "violations": F.count_if(~holds),
                "unknown": F.count_if(holds.isNull()),
            }
        )
    return count_tall(df, rows, "check_name string, rows long, violations long, unknown long")


def with_reasons(df: DataFrame, spec: Sequence[TargetColumn], name: str = "reasons") -> DataFrame:
    """Add why a row cannot be loaded as declared; an empty array when it can.

    ``name`` must not be a column of ``df`` already.
    """
    refuse_clash(df, name)
    found = []
    for column in spec:
        source = df.schema[column.name].dataType
        if not column.nullable:
            found.append(F.when(F.col(f"`{column.name}`").isNull(), f"{column.name}: null"))
        if column.target_type != "STRING":
            found.append(F.when(fit(df, column).misfit, f"{column.name}: does not fit {column.type_text}"))
        sized = column.target_type in ("STRING", "BYTES") and isinstance(source, (T.StringType, T.BinaryType))
        if sized and column.length is not None:
            found.append(F.when(too_long(column), f"{column.name}: longer than {column.length}"))
    return df.withColumn(name, F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"))


def quarantine(df: DataFrame, spec: Sequence[TargetColumn], name: str = "reasons") -> tuple[DataFrame, DataFrame]:
    """Split into rows that can be loaded and rejected rows with their reasons. Two narrow passes."""
    marked = with_reasons(df, spec, name)
    return marked.filter(F.size(name) == 0).drop(name), marked.filter(F.size(name) > 0)


def clean_text(df: DataFrame, column: str) -> DataFrame:
    """Replace a text column by its cleaned form; ``changed`` tells whether it differs."""
    value = F.col(f"`{column}`")
    clean = escape_description(value)
    return df.select(
        *[clean.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns],
        (clean != value).alias("changed"),
    )
