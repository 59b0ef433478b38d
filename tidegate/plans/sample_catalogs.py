"""Catalogs and dictionary views that Spark derives from the given tables.

They give the catalog operators inputs that grow with the data: the narrow catalog has one small
table per order, the wide one has one table of hundreds of columns per supplier, and the
dictionary views describe one source table per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.positions import dense_positions
from tidegate.sources.catalog_csv import catalog_records
from tidegate.sources.dictionary import DictionaryViews

SOURCE_TYPES = [
    "NUMBER", "NUMBER", "VARCHAR2", "CHAR", "DATE", "TIMESTAMP(6)", "TIMESTAMP(6) WITH TIME ZONE",
    "CLOB", "RAW", "INTEGER", "FLOAT", "INTERVAL DAY(2) TO SECOND(6)",
]


def _label(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _pick_type(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, SOURCE_TYPES)), (number % len(SOURCE_TYPES) + 1).cast("int"))


def _described(lineitem: DataFrame) -> list[Column]:
    """The catalog fields that both catalogs share, under the headers of the extract."""
    c = F.col
    comment = F.concat(
        F.lit('  ships "'), F.to_date("l_shipdate").cast("string"), F.lit('"\n\tfrom  '),
        c("l_suppkey").cast("string"), F.lit(" 창고 "),
    )
    return [
        _pick_type(c("l_partkey")).alias("DATA_TYPE"),
        F.when(c("l_suppkey") % 4 == 0, "").otherwise((c("l_orderkey") % 80).cast("string")).alias("DATA_PRECISION"),
        F.when(c("l_linenumber") == 7, "").otherwise((c("l_partkey") % 45 - 3).cast("string")).alias("DATA_SCALE"),
        F.when(c("l_quantity") == 13, "n/a").otherwise(c("l_quantity").cast("int").cast("string")).alias("DATA_LENGTH"),
        F.when(c("l_linestatus") == "O", "N").otherwise("Y").alias("NULLABLE"),
        F.when(c("l_linenumber") <= 2, "Y").otherwise("n").alias("IS_PRIMARY_KEY"),
        F.when(c("l_returnflag") == "A", _label("FK_", c("l_suppkey") % 3)).otherwise("").alias("FK_CONSTRAINT_NAME"),
        F.when(c("l_returnflag") == "N", _label("UK_", c("l_partkey") % 2)).otherwise("").alias("UK_CONSTRAINT_NAME"),
        F.when(c("l_linestatus") == "O", comment).otherwise("  ").alias("COLUMN_COMMENT"),
        F.when(c("l_returnflag") == "R", "y").otherwise("N").alias("PARTITION_YN"),
        F.when(c("l_returnflag") == "A", "Y").otherwise("").alias("CLUSTER_YN"),
    ]


def narrow_extract(lineitem: DataFrame, place: Column | None = None) -> DataFrame:
    """Many small tables; a column may appear several times, as in an extract with fan-out.

    ``place`` is what stands under COLUMN_ID, by default the line number.
    """
    place = F.col("l_linenumber").cast("string") if place is None else place
    return lineitem.select(
        _label("SCHEMA", F.col("l_orderkey") % 5).alias("OWNER"),
        _label("T", F.col("l_orderkey")).alias("TABLE_NAME"),
        _label("C", F.col("l_linenumber")).alias("COLUMN_NAME"),
        place.alias("COLUMN_ID"),
        *_described(lineitem),
    )


def narrow_catalog(lineitem: DataFrame) -> DataFrame:
    return catalog_records(narrow_extract(lineitem), numbered=True)


def wide_extract(lineitem: DataFrame) -> DataFrame:
    """Few tables with hundreds of uniquely named columns, some of whose names need quotes."""
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    order += [c for c in lineitem.columns if c not in (*order, "l_suppkey")]
    placed = dense_positions(
        lineitem, ["l_suppkey"], order, F.floor(F.col("l_orderkey") / 4096), name="place"
    )
    place = F.col("place")
    name = (
        F.when(place == 7, "Order")
        .when(place % 5 == 0, _label("C-", place))
        .when(place % 11 == 0, _label("컬럼", place))
        .when(place % 13 == 0, F.concat(place.cast("string"), F.lit("C")))
        .otherwise(_label("C", place))
    )
    return placed.select(
        _label("SCHEMA", F.col("l_suppkey") % 5).alias("OWNER"),
        _label("T", F.col("l_suppkey")).alias("TABLE_NAME"),
        name.alias("COLUMN_NAME"),
        place.cast("string").alias("COLUMN_ID"),
        *_described(lineitem),
    )


def wide_catalog(lineitem: DataFrame) -> DataFrame:
    return catalog_records(wide_extract(lineitem), numbered=True)


def huge_catalog(lineitem: DataFrame) -> DataFrame:
    """One table per schema with all its lines as columns; positions have gaps and repeat."""
    line = ["l_orderkey", "l_linenumber"]
    copy = F.row_number().over(Window.partitionBy(*line).orderBy(*[c for c in lineitem.columns if c not in line]))
    name = F.concat_ws("_", _label("L", F.col("l_orderkey")), F.col("l_linenumber").cast("string"), copy.cast("string"))
    return catalog_records(
        lineitem.select(
            _label("SCHEMA", F.col("l_orderkey") % 5).alias("OWNER"),
            F.lit("ALL_LINES").alias("TABLE_NAME"),
            name.alias("COLUMN_NAME"),
            (F.col("l_orderkey") * 10).cast("string").alias("COLUMN_ID"),
            *_described(lineitem),
        ),
        numbered=True,
    )


# Constraints of every sample source table: name prefix, kind, and the columns it covers.
SAMPLE_CONSTRAINTS = [
    ("PK_T", "P", ["C1", "C2"]),
    ("FK_T", "R", ["C2"]),
    ("UK_T", "U", ["C2", "C3"]),
    ("CK_T", "C", ["C3"]),
    ("CK2_T", "C", ["C3", "C4"]),
    ("SYSTEM_CK_T", "C", ["C1"]),
]


def _table_of(key: str) -> list[Column]:
    return [_label("SCHEMA", F.col(key) % 5).alias("OWNER"), _label("T", F.col(key)).alias("TABLE_NAME")]


def dictionary_views(orders: DataFrame, lineitem: DataFrame) -> DictionaryViews:
    """One source table per order, with one column per line number."""
    c = F.col
    described = lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("part"),
        F.min("l_suppkey").alias("supp"),
        F.min("l_quantity").alias("qty"),
        F.bool_and(c("l_linestatus") == "O").alias("open"),
        F.bool_or(c("l_returnflag") == "A").alias("returned"),
        F.max(F.to_date("l_shipdate")).alias("shipped"),
    )
    named = _label("C", c("l_linenumber")).alias("COLUMN_NAME")
    columns = described.select(
        *_table_of("l_orderkey"),
        named,
        c("l_linenumber").alias("COLUMN_ID"),
        _pick_type(c("part")).alias("DATA_TYPE"),
        c("qty").cast("int").alias("DATA_LENGTH"),
        F.when(c("supp") % 4 != 0, (c("l_orderkey") % 80).cast("int")).alias("DATA_PRECISION"),
        F.when(c("supp") % 4 != 0, (c("part") % 45 - 3).cast("int")).alias("DATA_SCALE"),
        F.when(c("open"), "N").otherwise("Y").alias("NULLABLE"),
        F.lit(None).cast("string").alias("DATA_DEFAULT"),
    )
    # As in a dictionary, every column and table has a row; the comment itself may be absent.
    shipped = F.concat(F.lit("ships "), c("shipped").cast("string"))
    column_comments = described.select(
        *_table_of("l_orderkey"), named, F.when(c("returned"), shipped).alias("COMMENTS")
    )
    table_comments = orders.select(
        *_table_of("o_orderkey"), F.when(c("o_orderstatus") != "P", c("o_orderpriority")).alias("COMMENTS")
    )
    constraint = F.explode(
        F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(k).alias("kind")) for p, k, _ in SAMPLE_CONSTRAINTS])
    )
    name = F.concat(c("k.prefix"), c("o_orderkey").cast("string"))
    constraints = orders.select("o_orderkey", "o_custkey", constraint.alias("k")).select(
        *_table_of("o_orderkey"),
        name.alias("CONSTRAINT_NAME"),
        c("k.kind").alias("CONSTRAINT_TYPE"),
        F.when(c("k.kind") == "R", _label("PK_T", c("o_custkey"))).alias("R_CONSTRAINT_NAME"),
        F.when(c("k.kind") == "C", _label("C3 > ", c("o_custkey") % 7)).alias("SEARCH_CONDITION"),
    )
    covered = F.explode(
        F.array(
            *[
                F.struct(F.lit(p).alias("prefix"), F.lit(column).alias("column"))
                for p, _, columns_ in SAMPLE_CONSTRAINTS
                for column in columns_
            ]
        )
    )
    constraint_columns = orders.select("o_orderkey", covered.alias("k")).select(
        *_table_of("o_orderkey"), name.alias("CONSTRAINT_NAME"), c("k.column").alias("COLUMN_NAME")
    )
    partition_keys = orders.select(
        _label("SCHEMA", c("o_orderkey") % 5).alias("OWNER"),
        _label("T", c("o_orderkey")).alias("NAME"),
        F.when(c("o_orderstatus") == "O", "INDEX").otherwise("TABLE").alias("OBJECT_TYPE"),
        F.lit("C1").alias("COLUMN_NAME"),
        F.lit(1).alias("COLUMN_POSITION"),
    )
    return DictionaryViews(columns, table_comments, column_comments, constraints, constraint_columns, partition_keys)


def partitioned_table_view(orders: DataFrame) -> DataFrame:
    """Source tables that are partitioned, one per order, as the dictionary lists them."""
    kind = F.when(F.col("o_orderstatus") == "O", "HASH").when(F.col("o_orderpriority") == "1-URGENT", "LIST")
    return orders.select(
        *_table_of("o_orderkey"),
        kind.otherwise("RANGE").alias("PARTITIONING_TYPE"),
        (F.col("o_custkey") % 10 + 1).alias("PARTITION_COUNT"),
    )
