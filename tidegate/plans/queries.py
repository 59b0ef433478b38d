"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import audits, columns, kept_profiles, layout, profiles
from tidegate.operators.spec import SourceColumn, convert_table, resolve
from tidegate.plans import sample_catalogs as samples
from tidegate.plans.catalog_rules import catalog_report, table_rules
from tidegate.plans.ddl import DdlOptions, ddl_lines, table_ddl
from tidegate.plans.extract import extract_catalog
from tidegate.plans.migrate import migrate_table
from tidegate.plans.report import migration_report
from tidegate.session import shared_dir
from tidegate.sinks import files
from tidegate.sources import dictionary
from tidegate.sources.catalog_csv import RECORD_FIELDS, catalog_records, read_catalog_csv, read_csv_text

Query = Callable[[SparkSession, str], DataFrame]

LINEITEM = (
    SourceColumn("l_orderkey", "NUMBER", "10", "0", nullable="N", primary_key="Y"),
    SourceColumn("l_partkey", "NUMBER", "10", "0", nullable="N"),
    SourceColumn("l_suppkey", "NUMBER", "25", "0", nullable="N"),
    SourceColumn("l_linenumber", "NUMBER", "3", "0", nullable="N", primary_key="Y"),
    SourceColumn("l_quantity", "NUMBER", "15", "2"),
    SourceColumn("l_extendedprice", "NUMBER", "6", "2"),
    SourceColumn("l_discount", "NUMBER", "3", "1"),
    SourceColumn("l_tax", "NUMBER"),
    SourceColumn("l_returnflag", "CHAR", length="1", cluster="Y"),
    SourceColumn("l_linestatus", "VARCHAR2", length="10", cluster="Y"),
    SourceColumn("l_shipdate", "DATE", partition="Y"),
)
ORDERS = (
    SourceColumn("o_orderkey", "NUMBER", "12", "0", nullable="N", primary_key="Y"),
    SourceColumn("o_custkey", "NUMBER"),
    SourceColumn("o_orderstatus", "CHAR", length="1"),
    SourceColumn("o_totalprice", "NUMBER", "7", "1"),
    SourceColumn("o_orderdate", "DATE", partition="Y"),
    SourceColumn("o_orderpriority", "VARCHAR2", length="12"),
)
DOCUMENTS = (
    SourceColumn("doc_id", "NUMBER", "18", "0", nullable="N", primary_key="Y"),
    SourceColumn("text", "VARCHAR2", length="4000"),
    SourceColumn("lang", "CHAR", length="2"),
    SourceColumn("source", "VARCHAR2", length="4"),
    SourceColumn("n_chars", "NUMBER", "4", "-2"),
)
EVENTS = (
    SourceColumn("event_id", "NUMBER", "18", "0", nullable="N", primary_key="Y"),
    SourceColumn("ts", "TIMESTAMP(6)", nullable="N", partition="Y"),
    SourceColumn("user_id", "NUMBER", "10", "0", cluster="Y"),
    SourceColumn("event_type", "VARCHAR2", length="6", cluster="Y"),
    SourceColumn("value", "NUMBER", "4", "2"),
    SourceColumn("props", "CLOB"),
)
CHECKS = {
    "small_discount": "l_discount BETWEEN 0 AND 0.05",
    "shipped_after_1998": "l_shipdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00'",
    "later_lines": "nullif(l_linenumber, 1) > 2",
}
CLUSTER_CANDIDATES = ["l_partkey", "l_suppkey", "l_orderkey", "l_returnflag", "l_linestatus"]
GENERATED_ON = datetime(2026, 1, 2, 3, 4, 5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    """A query over one table."""
    return lambda spark, sf_dir: build(table(spark, sf_dir, name))


def _narrow(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on("lineitem", lambda lineitem: build(samples.narrow_catalog(lineitem)))


def _wide(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on("lineitem", lambda lineitem: build(samples.wide_catalog(lineitem)))


def _extract(**options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = samples.dictionary_views(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
        if options.get("variant") == "user":
            views = dictionary.DictionaryViews(
                **{name: getattr(views, name).drop("OWNER") for name in dictionary.VIEW_NAMES}
            )
        return extract_catalog(views, **options)

    return run


def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; those without a label give NULLs to audit."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def not_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = resolve(
        [
            SourceColumn("doc_id", "NUMBER", "10", "0", nullable="N"),
            SourceColumn("quality", "NUMBER", "1", "0", nullable="N"),
            SourceColumn("toxic", "NUMBER", "1", "0", nullable="N"),
            SourceColumn("lang", "CHAR", length="2"),
        ]
    )
    return audits.not_null_audit(_labelled_documents(spark, sf_dir), spec)


def pk_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.pk_audit(_labelled_documents(spark, sf_dir), ["n_chars", "toxic"])


def unique_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.unique_audit(_labelled_documents(spark, sf_dir), ["n_chars", "toxic"])


def fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that no label refers to."""
    return audits.fk_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), {"doc_id": "doc_id"})


def fk_audit_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with a bitmap of the labelled ids ahead of the shuffle."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return audits.fk_audit(documents, labels, {"doc_id": "doc_id"}, bitmap_bytes=64 << 20)


def fk_audit_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.fk_audit(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return migration_report(
        table(spark, sf_dir, "lineitem"),
        resolve(LINEITEM),
        unique={"part and supplier": ["l_partkey", "l_suppkey"]},
        parents={
            "orders": (table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}),
            "labels": (table(spark, sf_dir, "labels"), {"l_orderkey": "doc_id"}),
            "parts": (table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"}),
        },
        checks=CHECKS,
    )


FINE = (
    SourceColumn("as_text", "NUMBER", "5", "0"),
    SourceColumn("as_decimal", "NUMBER", "5", "0"),
    SourceColumn("as_double", "NUMBER", "5", "0"),
    SourceColumn("to_cents", "NUMBER", "10", "2"),
    SourceColumn("to_hundreds", "NUMBER", "4", "-2"),
)


def fine_lines(lineitem: DataFrame) -> DataFrame:
    """Values just below a tie, with twelve digits behind the point, as text, decimal and double."""
    last = F.lpad((F.col("l_suppkey") % 100000).cast("string"), 5, "0")
    fine = F.concat(F.col("l_linenumber").cast("string"), F.lit(".4999999"), last)
    exact = fine.cast("decimal(38,18)")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        fine.alias("as_text"),
        exact.alias("as_decimal"),
        fine.cast("double").alias("as_double"),
        exact.alias("to_cents"),
        fine.alias("to_hundreds"),
    )


def small_lines(lineitem: DataFrame) -> DataFrame:
    """Fractions down to the 15th place."""
    small = F.concat(F.lit("0.0000000000"), F.lpad(F.col("l_linenumber").cast("string"), 5, "0"))
    return lineitem.select(
        small.cast("decimal(38,18)").alias("as_decimal"),
        F.concat(small, F.lit("00")).alias("as_text"),
        small.cast("double").alias("as_double"),
        F.col("l_extendedprice").alias("price"),
    )


def convert_fine_digits(lineitem: DataFrame) -> DataFrame:
    converted = convert_table(fine_lines(lineitem), resolve(FINE), undeclared="keep")
    return converted.select("l_orderkey", "l_linenumber", *[c.name for c in FINE])


def rejected(lineitem: DataFrame) -> DataFrame:
    _, bad = audits.quarantine(lineitem, resolve(LINEITEM))
    return bad.withColumn("reasons", F.array_join("reasons", "; "))


def loadable(lineitem: DataFrame) -> DataFrame:
    spec = resolve(LINEITEM)
    good, _ = audits.quarantine(lineitem, spec)
    return convert_table(good, spec)


def partition_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines: orders without lines have no ship date."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return profiles.partition_candidates(orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"))


def _written_in_two(spark: SparkSession, sf_dir: str, name: str, update: Callable[[str, str], object]) -> tuple[str, str]:
    """The events as a stored table that grows by its later days, and a profile brought up to date after each write."""
    path, store = shared_dir(spark, name), shared_dir(spark, f"{name}-store")
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    layout.write_by_day(events.filter(F.col("ts") < middle), "ts", path)
    update(path, store)
    layout.write_by_day(events.filter((F.col("ts") >= middle) | F.col("ts").isNull()), "ts", path, mode="append")
    update(path, store)
    return path, store


def day_profile_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, store = _written_in_two(spark, sf_dir, "kept", lambda p, s: kept_profiles.update_day_counts(spark, p, s))
    return kept_profiles.kept_day_profile(spark, path, store, "ts")


def rank_kept_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by distinct values on ten days, from sketches; the names alone, as for the estimates of one scan."""

    def update(path: str, store: str) -> None:
        kept_profiles.update_sketches(spark, path, store, "ts", ["event_id", "user_id", "event_type"])

    path, store = _written_in_two(spark, sf_dir, "sketched", update)
    ranked = kept_profiles.rank_kept_keys(spark, path, store, date(2024, 1, 11), date(2024, 1, 20), k=2)
    return ranked.select("column_name")


def write_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "by-day")
    layout.write_by_day(table(spark, sf_dir, "events"), "ts", path)
    return spark.read.parquet(path)


def expire_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of the events, some without a time, loses its old days for good."""
    path = shared_dir(spark, "expire-stored")
    name = "expiring_" + path.rsplit("-", 1)[1]
    some = F.when(F.col("user_id") % 7 != 0, F.col("ts")).alias("ts")
    events = table(spark, sf_dir, "events")
    timed = events.select(*[some if c == "ts" else c for c in events.columns])
    layout.save_table(layout.with_day(timed, "ts"), name, partition_by=[layout.DAY], path=path)
    layout.drop_expired(spark, name, date(2024, 1, 31), 10)
    return spark.table(name)


def replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the second half are replaced by their corrected clicks; the others stay."""
    path = shared_dir(spark, "replace-days")
    events = table(spark, sf_dir, "events")
    layout.write_by_day(events, "ts", path)
    second_half = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    late = events.filter((F.col("event_type") == "click") & second_half)
    layout.write_by_day(late.withColumn("value", F.col("value") + 1000), "ts", path, mode="replace_days")
    return spark.read.parquet(path)


def read_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "read-days")
    layout.write_by_day(table(spark, sf_dir, "events"), "ts", path)
    return layout.read_days(spark, path, "ts", date(2024, 1, 5), date(2024, 1, 14))


def cluster_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "clustered")
    layout.write_clustered(table(spark, sf_dir, "events"), ["event_type", "user_id"], path, ts="ts")
    return spark.read.parquet(path)


def save_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned, bucketed catalog table, created and then replaced by its other rows; read back by name."""
    path = shared_dir(spark, "saved")
    name = "saved_" + path.rsplit("-", 1)[1]
    events = table(spark, sf_dir, "events")
    options = {"partition_by": ["event_type"], "cluster_by": ["user_id"], "buckets": 4, "path": path}
    layout.save_table(events, name, **options)
    clicks = events.filter(F.col("event_type") != "view")
    layout.save_table(clicks, name, create_or_replace=True, drop_first=True, **(options | {"path": f"{path}-2"}))
    return spark.table(name)


def migrate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the events as declared; both the loaded and the rejected rows are read back."""
    path, rejected_path = shared_dir(spark, "migrated"), shared_dir(spark, "rejected")
    migrate_table(table(spark, sf_dir, "events"), resolve(EVENTS), path, rejected_path)
    loaded = spark.read.parquet(path).withColumn("reasons", F.lit(""))
    bad = spark.read.parquet(rejected_path).withColumn("reasons", F.array_join("reasons", "; "))
    keys = ["event_id", "ts", "user_id", "event_type", "props", "reasons"]
    shown = F.col("value").cast("decimal(12,2)").alias("value")
    return loaded.select(*keys, shown, "day").unionByName(
        bad.select(*keys, shown, F.lit(None).cast("date").alias("day"))
    )


# What the dictionary says about three of the tables: owner, table, column, position, type, precision,
# scale, length, nullable, then the primary key, foreign key and its target, unique key, and condition.
CATALOG = [
    ("SALES", "LINEITEM", "l_orderkey", "1", "NUMBER", "10", "0", "", "N", "PK_LINE", "FK_ORDER", "PK_ORDER", "", "", ""),
    ("SALES", "LINEITEM", "l_orderkey", "1", "NUMBER", "10", "0", "", "N", "PK_LINE", "FK_LABEL", "UK_LABEL", "", "", ""),
    ("SALES", "LINEITEM", "l_linenumber", "2", "NUMBER", "3", "0", "", "N", "PK_LINE", "", "", "", "", ""),
    ("SALES", "LINEITEM", "l_partkey", "3", "NUMBER", "10", "0", "", "N", "", "", "", "UK_OFFER", "", ""),
    ("SALES", "LINEITEM", "l_suppkey", "4", "NUMBER", "10", "0", "", "N", "", "", "", "UK_OFFER", "", ""),
    ("SALES", "LINEITEM", "l_extendedprice", "5", "NUMBER", "6", "2", "", "Y", "", "", "", "", "", ""),
    ("SALES", "LINEITEM", "l_discount", "6", "NUMBER", "3", "1", "", "Y", "", "", "", "", "CK_SMALL", "l_discount <= 0.05"),
    ("SALES", "LINEITEM", "l_discount", "6", "NUMBER", "3", "1", "", "Y", "", "", "", "", "CK_SIGN", "l_discount > 0"),
    ("SALES", "LINEITEM", "l_returnflag", "7", "CHAR", "", "", "1", "Y", "", "", "", "", "", ""),
    ("SALES", "ORDERS", "o_orderkey", "1", "NUMBER", "10", "0", "", "N", "PK_ORDER", "", "", "", "", ""),
    ("TEXTS", "LABELS", "doc_id", "1", "NUMBER", "10", "0", "", "N", "", "", "", "UK_LABEL", "", ""),
]
CATALOG_FIELDS = [
    "OWNER", "TABLE_NAME", "COLUMN_NAME", "COLUMN_ID", "DATA_TYPE", "DATA_PRECISION", "DATA_SCALE", "DATA_LENGTH",
    "NULLABLE", "PK_CONSTRAINT_NAME", "FK_CONSTRAINT_NAME", "REFERENCED_CONSTRAINT", "UK_CONSTRAINT_NAME",
    "CK_CONSTRAINT_NAME", "SEARCH_CONDITION",
]


def catalog_to_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a catalog CSV to the rules of a table to the report over its data."""
    path = shared_dir(spark, "catalog")
    extract = spark.createDataFrame(CATALOG, ", ".join(f"{field} string" for field in CATALOG_FIELDS))
    flagged = extract.withColumn("IS_PRIMARY_KEY", F.when(F.col("PK_CONSTRAINT_NAME") != "", "Y").otherwise("N"))
    files.write_catalog_csv(flagged, path)
    rules = table_rules(read_csv_text(spark, path), "SALES", "LINEITEM")
    tables = {
        ("SALES", "LINEITEM"): table(spark, sf_dir, "lineitem"),
        ("SALES", "ORDERS"): table(spark, sf_dir, "orders"),
        ("TEXTS", "LABELS"): table(spark, sf_dir, "labels"),
    }
    return catalog_report(rules, tables, ("SALES", "LINEITEM"))


def migrate_replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily reload of a clustered table: days from the 16th on are replaced by their corrected clicks."""
    path, rejected_path = shared_dir(spark, "reloaded"), shared_dir(spark, "reload-rejected")
    events, spec = table(spark, sf_dir, "events"), resolve(EVENTS)
    migrate_table(events, spec, path, rejected_path)
    second_half = F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    late = events.filter((F.col("event_type") == "click") & second_half)
    migrate_table(late.withColumn("user_id", -F.col("user_id")), spec, path, rejected_path, mode="replace_days")
    return spark.read.parquet(path).select("event_id", "ts", "user_id", "event_type", "day")


def snapshot_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary views written as snapshot files and read back for one owner's tables, some by name."""
    path = shared_dir(spark, "snapshots")
    views = samples.dictionary_views(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    for name, view in dictionary.VIEW_NAMES.items():
        getattr(views, name).write.parquet(f"{path}/ALL_{view}")
    back = dictionary.read_snapshots(spark, path)
    return extract_catalog(back, "tables", owners=["SCHEMA1", "SCHEMA3"], like="T1%")


def _wide_ddl(spark: SparkSession, sf_dir: str, options: DdlOptions) -> DataFrame:
    return table_ddl(columns.type_columns(samples.wide_catalog(table(spark, sf_dir, "lineitem"))), options)


FULL_DDL = DdlOptions(
    create_or_replace=True,
    drop_partition_table_before_create=True,
    partition_expiration_days=90,
    project="",
    max_cluster_columns=4,
)


def _staged(spark: SparkSession, catalog: DataFrame, name: str) -> DataFrame:
    """The typed catalog, written once for what reads it several times."""
    path = shared_dir(spark, f"{name}-typed")
    columns.type_columns(catalog).write.parquet(path)
    return spark.read.parquet(path)


def merged_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "merged-ddl")
    typed = _staged(spark, samples.wide_catalog(table(spark, sf_dir, "lineitem")), "merged-ddl")
    files.write_merged(ddl_lines(typed), columns.table_count(typed), path, GENERATED_ON)
    return spark.read.text(path)


def ddl_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "ddl-files")
    typed = _staged(spark, samples.wide_catalog(table(spark, sf_dir, "lineitem")), "ddl-files")
    files.write_per_table(ddl_lines(typed), path)
    return spark.read.schema("value string, schema_name string, table_name string").text(path)


def catalog_to_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: dictionary views, extract, one row per column, types, definitions."""
    extract = _extract(variant="full", ordered=False)(spark, sf_dir)
    unique_columns = columns.dedupe(catalog_records(extract, numbered=True))
    return table_ddl(columns.type_columns(unique_columns, preserve_string_length=True))


def csv_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "csv")
    files.write_catalog_csv(samples.narrow_extract(table(spark, sf_dir, "lineitem")), path)
    return read_catalog_csv(spark, path)


def csv_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file with few headers, one of them by its other name, and rows without a table name."""
    path = shared_dir(spark, "csv-gaps")
    extract = samples.narrow_extract(table(spark, sf_dir, "lineitem"))
    named = F.when(F.col("DATA_PRECISION") == "", "").otherwise(F.col("TABLE_NAME"))
    few = extract.select(
        F.col("OWNER").alias("TABLE_SCHEMA"), named.alias("TABLE_NAME"), "COLUMN_NAME", "COLUMN_ID", "DATA_TYPE"
    )
    files.write_catalog_csv(few, path)
    return read_catalog_csv(spark, path)


def csv_blank_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV catalog in a stated order, a third of whose rows have no COLUMN_ID."""
    path = shared_dir(spark, "csv-blank")
    lineitem = table(spark, sf_dir, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]
    order += [c for c in lineitem.columns if c not in order]
    given = F.when(F.col("l_partkey") % 3 != 0, F.col("l_linenumber").cast("string")).otherwise("")
    extract = samples.narrow_extract(lineitem.withColumn("given", given).orderBy(*order), F.col("given"))
    files.write_catalog_csv(extract, path)
    return read_catalog_csv(spark, path)


def csv_to_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a catalog CSV to one definition per table."""
    path = shared_dir(spark, "csv-ddl")
    files.write_catalog_csv(samples.wide_extract(table(spark, sf_dir, "lineitem")), path)
    return table_ddl(columns.type_columns(read_catalog_csv(spark, path)))


def csv_korean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in an older Korean encoding, found and read back."""
    path = shared_dir(spark, "csv-korean")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # as build_session does
    files.write_catalog_csv(samples.narrow_extract(table(spark, sf_dir, "lineitem")), path, encoding="EUC-KR")
    return read_catalog_csv(spark, path)


def grouped_columns(records: DataFrame) -> DataFrame:
    """The ordered arrays as text, so that they compare across engines."""
    listed = F.transform("columns", lambda c: F.concat_ws(" ", c["column_name"], c["type_text"], c["nullable"]))
    return columns.grouped_columns(columns.type_columns(records)).select(
        *columns.TABLE_KEY,
        F.size("columns").cast("bigint").alias("n_columns"),
        F.array_join(listed, ", ").alias("column_list"),
    )


QUERIES: dict[str, Query] = {
    # Audits and conversion of table data
    "fit_audit": _on("lineitem", lambda t: audits.fit_audit(t, resolve(LINEITEM))),
    "fit_audit_fine_digits": _on("lineitem", lambda t: audits.fit_audit(fine_lines(t), resolve(FINE))),
    "convert_fine_digits": _on("lineitem", convert_fine_digits),
    "fit_audit_documents": _on("documents", lambda t: audits.fit_audit(t, resolve(DOCUMENTS))),
    "convert_orders": _on("orders", lambda t: convert_table(t, resolve(ORDERS))),
    "length_audit": _on("documents", lambda t: audits.length_audit(t, resolve(DOCUMENTS))),
    "not_null_audit": not_null_audit,
    "pk_audit": _on("lineitem", lambda t: audits.pk_audit(t, ["l_orderkey", "l_linenumber"])),
    "pk_null_audit": pk_null_audit,
    "unique_audit": _on("lineitem", lambda t: audits.unique_audit(t, ["l_partkey", "l_suppkey"])),
    "unique_null_audit": unique_null_audit,
    "fk_audit": fk_audit,
    "fk_audit_bitmap": fk_audit_bitmap,
    "fk_audit_clean": fk_audit_clean,
    "check_audit": _on("lineitem", lambda t: audits.check_audit(t, CHECKS)),
    "quarantine": _on("lineitem", rejected),
    "quarantine_loadable": _on("lineitem", loadable),
    "migration_report": report,
    "catalog_to_report": catalog_to_report,
    "clean_text": _on("documents", lambda t: audits.clean_text(t, "text")),
    # Profiles
    "number_profile": _on(
        "lineitem",
        lambda t: profiles.number_profile(
            t, ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        ),
    ),
    "number_profile_small": _on(
        "lineitem",
        lambda t: profiles.number_profile(small_lines(t), ["as_decimal", "as_text", "as_double", "price"]),
    ),
    "day_profile": _on("events", lambda t: profiles.day_profile(t, "ts")),
    "day_profile_kept": day_profile_kept,
    "rank_kept_keys": rank_kept_keys,
    "day_profile_lineitem": _on("lineitem", lambda t: profiles.day_profile(t, "l_shipdate")),
    "partition_candidates": partition_candidates,
    "rank_cluster_keys": _on("lineitem", lambda t: profiles.rank_cluster_keys(t, CLUSTER_CANDIDATES, exact=True)),
    # The names alone: the estimates behind them differ from the exact counts, the ranking does not.
    "rank_cluster_keys_approx": _on(
        "lineitem", lambda t: profiles.rank_cluster_keys(t, CLUSTER_CANDIDATES).select("column_name")
    ),
    # Layout
    "write_by_day": write_by_day,
    "replace_days": replace_days,
    "read_days": read_days,
    "cluster_layout": cluster_layout,
    "save_table": save_table,
    "migrate_events": migrate_events,
    "migrate_replace_days": migrate_replace_days,
    "expire_days": _on("events", lambda t: layout.expire_partitions(t, "ts", date(2024, 1, 31), 10)),
    "expire_stored": expire_stored,
    "expired_days": _on("events", lambda t: layout.expired_days(t, "ts", date(2024, 1, 31), 10)),
    # Catalog intake and extract
    "csv_intake": csv_intake,
    "csv_korean": csv_korean,
    "csv_blank_ids": csv_blank_ids,
    "csv_gaps": csv_gaps,
    "catalog_records": _narrow(lambda r: r.select(*RECORD_FIELDS, "column_id")),
    "partitioned_tables": _on(
        "orders", lambda t: dictionary.partitioned_tables(samples.partitioned_table_view(t))
    ),
    "partition_keys": lambda spark, sf_dir: dictionary.partition_key_columns(
        samples.dictionary_views(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")).partition_keys
    ),
    "extract_full": _extract(variant="full"),
    "extract_simple": _extract(variant="simple"),
    "extract_user": _extract(variant="user", user="MIGRATOR"),
    "extract_tables": _extract(
        variant="tables", owners=["SCHEMA1", "SCHEMA3"], like="T1%"
    ),
    "extract_snapshots": snapshot_extract,
    "extract_named_tables": _extract(variant="simple", tables=["T1", "T2", "T33", "T100"]),
    # Catalog operators
    "type_map": _narrow(columns.type_columns),
    "type_map_lengths": _narrow(
        lambda r: columns.type_columns(r, preserve_string_length=True).select(
            *columns.COLUMN_KEY, "char_length", "target_type", "type_text"
        )
    ),
    "type_census": _narrow(lambda r: columns.type_census(columns.type_columns(r))),
    "tables_per_schema": _narrow(columns.tables_per_schema),
    "table_count": _narrow(columns.table_count),
    "schemas": _narrow(columns.schemas),
    "catalog_dedupe": _narrow(columns.dedupe),
    "fanout_report": _narrow(columns.fanout_report),
    "column_definitions": _narrow(lambda r: columns.column_definitions(columns.type_columns(r))),
    "qualified_tables": _narrow(columns.qualified_tables),
    "grouped_columns": _wide(grouped_columns),
    "partition_flags": _narrow(columns.partition_flags),
    "partition_clause": _wide(lambda r: columns.partition_clauses(columns.type_columns(r))),
    "cluster_clause": _wide(columns.cluster_columns),
    "cluster_clause_top4": _wide(lambda r: columns.cluster_columns(r, max_columns=4)),
    "pk_columns": _wide(columns.key_columns),
    "identifier_audit": _wide(columns.identifier_audit),
    "limit_audit": _wide(lambda r: columns.limit_audit(columns.type_columns(r))),
    # Definitions
    "ddl_per_table": lambda spark, sf_dir: _wide_ddl(spark, sf_dir, DdlOptions()),
    "ddl_replace_options": lambda spark, sf_dir: _wide_ddl(spark, sf_dir, FULL_DDL),
    "ddl_lines_huge_tables": lambda spark, sf_dir: ddl_lines(
        _staged(spark, samples.huge_catalog(table(spark, sf_dir, "lineitem")), "ddl-huge")
    ).select(*columns.TABLE_KEY, F.col("line").alias("value")),
    "merged_ddl": merged_ddl,
    "ddl_files": ddl_files,
    "catalog_to_ddl": catalog_to_ddl,
    "csv_to_ddl": csv_to_ddl,
}
