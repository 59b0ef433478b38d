"""Operators over catalog columns: typing, de-duplication, grouping per table, audits.

Input rows are catalog records (``sources.catalog_csv.catalog_records``): one row per column with
``schema_name``, ``table_name``, ``column_name``, ``column_id`` and the text fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions import names, text, types

TABLE_KEY = ["schema_name", "table_name"]
COLUMN_KEY = [*TABLE_KEY, "column_name"]

# How many key columns the target takes, and how many clustering columns.
MAX_KEY_COLUMNS = 16
MAX_CLUSTER_COLUMNS = 4


def is_flagged(flag: Column) -> Column:
    """Flags are compared without regard to case."""
    return F.upper(flag) == "Y"


def type_columns(
    records: DataFrame, string_mode: str = "auto", preserve_string_length: bool = False
) -> DataFrame:
    """Add ``target_type``, ``type_text`` and ``spark_type`` to each catalog row.

    One narrow pass. The parsed numbers get a select of their own so that the optimizer computes
    them once instead of copying them into every branch.
    """
    numbers = {"_p": "data_precision", "_s": "data_scale", "_n": "char_length"}
    parsed = records.select(
        "*",
        types.base_type(F.col("data_type")).alias("_base"),
        *[types.parse_int(F.col(field)).alias(f"{name}_value") for name, field in numbers.items()],
    )
    broken = {name: types.is_broken_int(F.col(field), F.col(f"{name}_value")) for name, field in numbers.items()}
    judged = parsed.select(
        *records.columns,
        "_base",
        *[f"{name}_value" for name in numbers],
        (broken["_p"] | broken["_s"]).alias("_bad"),
        broken["_n"].alias("_bad_n"),
    )
    # A broken precision or scale voids both; for the written form a broken length voids all three.
    guarded = judged.select(
        *records.columns,
        "_base",
        F.when(~F.col("_bad"), F.col("_p_value")).alias("_p"),
        F.when(~F.col("_bad"), F.col("_s_value")).alias("_s"),
        F.when(~F.col("_bad"), F.col("_n_value")).alias("_n"),
        "_bad_n",
    ).withColumn("target_type", types.target_type(F.col("_base"), F.col("_p"), F.col("_s")))
    written = types.type_text(
        F.col("target_type"),
        F.when(~F.col("_bad_n"), F.col("_p")),
        F.when(~F.col("_bad_n"), F.col("_s")),
        F.col("_n"),
        string_mode,
        preserve_string_length,
    )
    held = types.spark_type(F.col("target_type"), F.col("_p"), F.col("_s"))
    return guarded.select(
        *records.columns, "target_type", written.alias("type_text"), held.alias("spark_type")
    )


def type_census(typed: DataFrame) -> DataFrame:
    """Columns per (schema, target type), how many lose a time zone, and how many stay text
    although they are numbers at the source."""
    kind = types.base_type(F.col("data_type"))
    zoned = kind.startswith("TIMESTAMP") & F.upper("data_type").contains("TIME ZONE")
    return typed.groupBy("schema_name", "target_type").agg(
        F.count("*").alias("columns"),
        F.count_if(zoned).alias("zones_dropped"),
        F.count_if((kind == "NUMBER") & (F.col("spark_type") == "string")).alias("numbers_kept_as_text"),
    )


def tables_per_schema(records: DataFrame) -> DataFrame:
    """Distinct tables and columns rows per schema; the distinct runs on (schema, table) first."""
    return (
        records.groupBy(*TABLE_KEY)
        .agg(F.count("*").alias("columns"))
        .groupBy("schema_name")
        .agg(F.count("*").alias("tables"), F.sum("columns").alias("columns"))
    )


def table_count(records: DataFrame) -> DataFrame:
    return records.select(*TABLE_KEY).distinct().agg(F.count("*").alias("tables"))


def schemas(records: DataFrame) -> DataFrame:
    """Distinct non-empty schema names, sorted."""
    return records.select("schema_name").filter(F.col("schema_name") != "").distinct().orderBy("schema_name")


FLAGS = ("is_primary_key", "partition_yn", "cluster_yn")
CONSTRAINT_NAMES = ("fk_constraint_name", "unique_constraint_name")


def _name_set(column: str) -> Column:
    """Aggregate: the distinct non-empty names in order, as one text."""
    names_found = F.collect_set(F.nullif(F.col(column), F.lit("")))
    return F.array_join(F.array_sort(names_found), ",")


def dedupe(records: DataFrame) -> DataFrame:
    """One row per (schema, table, column): the smallest row by position, then by every field, with
    what the others add: a flag is Y if any row says so, NULLABLE is N if any row says so, and
    constraint names are the ordered set of all of them, parted by commas.

    An aggregate with map-side combine, so repeats of one column never gather in a task.
    """
    rest = [c for c in records.columns if c not in COLUMN_KEY]
    ordered = ["column_id", *[c for c in rest if c != "column_id"]]
    folds = {f: F.bool_or(is_flagged(F.col(f))) for f in FLAGS if f in rest}
    sets = {n: _name_set(n) for n in CONSTRAINT_NAMES if n in rest}
    found = records.groupBy(*COLUMN_KEY).agg(
        F.min(F.struct(*ordered)).alias("_first"),
        F.bool_or(F.col("nullable") == "N").alias("_required"),
        *[value.alias(f"_{name}") for name, value in {**folds, **sets}.items()],
    )

    def shown(name: str) -> Column:
        first = F.col(f"_first.`{name}`")
        if name in folds:
            return F.when(F.col(f"_{name}") & ~is_flagged(first), "Y").otherwise(first)
        if name in sets:
            return F.col(f"_{name}")
        return F.when(F.col("_required"), "N").otherwise(first) if name == "nullable" else first

    return found.select(*[F.col(c) if c in COLUMN_KEY else shown(c).alias(c) for c in records.columns])


def fanout_report(records: DataFrame) -> DataFrame:
    """Columns that appear more than once: their rows, how many differ in their constraint names,
    and the ordered set of those names."""
    per_name = records.groupBy(*COLUMN_KEY, *CONSTRAINT_NAMES).agg(F.count("*").alias("copies"))
    both = F.array(*[F.nullif(F.col(n), F.lit("")) for n in CONSTRAINT_NAMES])
    return (
        per_name.groupBy(*COLUMN_KEY)
        .agg(
            F.sum("copies").alias("copies"),
            F.count("*").alias("variants"),
            F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_compact(both))))), ",").alias(
                "constraint_names"
            ),
        )
        .filter(F.col("copies") > 1)
    )


def column_definition(column_name: Column, type_text: Column, nullable: Column, comment: Column) -> Column:
    """``name TYPE[ NOT NULL][ OPTIONS(description="...")]``; NOT NULL needs exactly 'N'."""
    said = F.nullif(text.escape_description(comment), F.lit(""))
    option = F.concat(F.lit('OPTIONS(description="'), said, F.lit('")'))
    return F.concat_ws(
        " ", names.quote_name(column_name), type_text, F.when(nullable == "N", "NOT NULL"), option
    )


def column_definitions(typed: DataFrame) -> DataFrame:
    return typed.select(
        *TABLE_KEY,
        "column_id",
        "column_name",
        column_definition(
            F.col("column_name"), F.col("type_text"), F.col("nullable"), F.col("column_comment")
        ).alias("definition"),
    )


def qualified_tables(records: DataFrame, project: str | None = names.DEFAULT_PROJECT) -> DataFrame:
    """One row per table with its full quoted name."""
    return (
        records.select(*TABLE_KEY)
        .distinct()
        .withColumn("full_name", names.qualified_name(F.col("schema_name"), F.col("table_name"), project))
    )


def grouped_columns(typed: DataFrame) -> DataFrame:
    """Columns of each table as one ordered array of structs: a row per table, as large as the table."""
    entry = F.struct("column_id", "column_name", "type_text", "nullable", "is_primary_key")
    return typed.groupBy(*TABLE_KEY).agg(F.array_sort(F.collect_list(entry)).alias("columns"))


def partition_flags(records: DataFrame) -> DataFrame:
    """Per table: is any column flagged as partition key."""
    return records.groupBy(*TABLE_KEY).agg(
        F.bool_or(is_flagged(F.col("partition_yn"))).alias("has_partition")
    )


def partition_clause(column_name: Column, target_type: Column) -> Column:
    """Only date-times partition by day; other types give no clause."""
    return F.when(
        target_type == "DATETIME",
        F.concat(F.lit("PARTITION BY DATETIME_TRUNC("), names.quote_name(column_name), F.lit(", DAY)")),
    )


def first_partition_column() -> Column:
    """Aggregate: the first flagged column as struct(column_id, column_name, target_type)."""
    flagged = is_flagged(F.col("partition_yn")) & (F.col("column_name") != "")
    return F.min(F.when(flagged, F.struct("column_id", "column_name", "target_type")))


def partition_clauses(typed: DataFrame) -> DataFrame:
    """Per table with a flagged column: that column, its target type and the clause, if any."""
    flagged = typed.filter(is_flagged(F.col("partition_yn")))
    first = flagged.groupBy(*TABLE_KEY).agg(first_partition_column().alias("_first"))
    return first.filter(F.col("_first").isNotNull()).select(
        *TABLE_KEY,
        F.col("_first.column_name").alias("partition_column"),
        F.col("_first.target_type").alias("target_type"),
        partition_clause(F.col("_first.column_name"), F.col("_first.target_type")).alias("clause"),
    )


def quoted_names(entries: Column, limit: int | None = None) -> Column:
    """The names of an ordered array of columns as one text, quoted where needed; NULL without any."""
    chosen = entries if limit is None else F.slice(entries, 1, limit)
    quoted = F.transform(chosen, lambda e: names.quote_name(e["column_name"]))
    return F.when(F.size(chosen) > 0, F.array_join(quoted, ", "))


def flagged_entries(flag: str) -> Column:
    """Aggregate: the columns under a flag as an array in order of (column_id, column_name)."""
    entry = F.struct("column_id", "column_name")
    return F.array_sort(F.collect_list(F.when(is_flagged(F.col(flag)), entry)))


def cluster_columns(records: DataFrame, max_columns: int | None = None) -> DataFrame:
    """Per table, the flagged clustering columns in order as one clause.

    ``max_columns`` keeps the first ones (the target documents four); by default all are kept, in one
    row, as the clause is one text. Only flagged rows are shuffled.
    """
    flagged = records.filter(is_flagged(F.col("cluster_yn")) & (F.col("column_name") != ""))
    if max_columns is not None:
        place = F.row_number().over(Window.partitionBy(*TABLE_KEY).orderBy("column_id", "column_name"))
        flagged = flagged.withColumn("_place", place).filter(F.col("_place") <= max_columns)
    quoted = F.transform(F.col("_entries"), lambda e: names.quote_name(e["column_name"]))
    return (
        flagged.groupBy(*TABLE_KEY)
        .agg(F.array_sort(F.collect_list(F.struct("column_id", "column_name"))).alias("_entries"))
        .select(
            *TABLE_KEY,
            F.size("_entries").cast("bigint").alias("cluster_columns"),
            F.concat(F.lit("CLUSTER BY "), F.array_join(quoted, ", ")).alias("clause"),
        )
    )


def key_columns(records: DataFrame, limit: int = MAX_KEY_COLUMNS) -> DataFrame:
    """Per table, the first ``limit`` primary-key columns in order, and the names beyond them."""
    flagged = records.filter(is_flagged(F.col("is_primary_key"))).select(*TABLE_KEY, "column_id", "column_name")
    quoted = F.transform(F.col("_entries"), lambda e: names.quote_name(e["column_name"]))
    return (
        flagged.groupBy(*TABLE_KEY)
        .agg(F.array_sort(F.collect_list(F.struct("column_id", "column_name"))).alias("_entries"))
        .select(
            *TABLE_KEY,
            F.least(F.size("_entries"), F.lit(limit)).cast("bigint").alias("key_columns"),
            F.array_join(F.slice(quoted, 1, limit), ", ").alias("key_list"),
            F.array_join(F.slice(quoted, limit + 1, F.greatest(F.size("_entries"), F.lit(1))), ", ").alias("dropped_keys"),
        )
    )


def identifier_audit(records: DataFrame) -> DataFrame:
    """Per schema: column names by reason for quoting."""
    name = F.col("column_name")
    return records.groupBy("schema_name").agg(
        F.count("*").alias("names"),
        F.count_if(names.needs_quotes(name)).alias("need_quotes"),
        F.count_if(name.rlike(names.HANGUL)).alias("hangul"),
        F.count_if(name.rlike(r"\A[0-9]")).alias("leading_digit"),
        F.count_if(name.rlike(r"[^A-Za-z0-9_]")).alias("other_characters"),
        F.count_if(names.is_reserved(name)).alias("reserved"),
    )


def limit_audit(typed: DataFrame) -> DataFrame:
    """Tables that break a limit of the target: too many key or clustering columns, more than one
    partition flag, or a partition column of a type that cannot partition."""
    counted = typed.groupBy(*TABLE_KEY).agg(
        F.count_if(is_flagged(F.col("is_primary_key"))).alias("key_columns"),
        F.count_if(is_flagged(F.col("cluster_yn"))).alias("cluster_columns"),
        F.count_if(is_flagged(F.col("partition_yn"))).alias("partition_flags"),
        first_partition_column().alias("_first"),
    )
    unsupported = F.coalesce(F.col("_first.target_type") != "DATETIME", F.lit(False))
    return (
        counted.withColumn("unsupported_partition", unsupported)
        .drop("_first")
        .filter(
            (F.col("key_columns") > MAX_KEY_COLUMNS)
            | (F.col("cluster_columns") > MAX_CLUSTER_COLUMNS)
            | (F.col("partition_flags") > 1)
            | F.col("unsupported_partition")
        )
    )
