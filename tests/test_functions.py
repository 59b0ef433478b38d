"""Type rules, names and text against stated values."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidegate.functions import names, text, types
from tidegate.operators.columns import type_columns
from tidegate.sources.catalog_csv import catalog_records

# source type, precision, scale, length -> target, written form, written form with lengths, Spark type
TYPE_CASES = [
    ("NUMBER", "10", "0", "22", "INT64", "INT64", "INT64", "bigint"),
    ("NUMBER", "18", "0", "", "INT64", "INT64", "INT64", "bigint"),
    ("NUMBER", "19", "0", "", "NUMERIC", "NUMERIC(19, 0)", "NUMERIC(19, 0)", "decimal(19,0)"),
    ("NUMBER", "25", "0", "", "NUMERIC", "NUMERIC(25, 0)", "NUMERIC(25, 0)", "decimal(25,0)"),
    ("NUMBER", "29", "0", "", "NUMERIC", "NUMERIC(29, 0)", "NUMERIC(29, 0)", "decimal(29,0)"),
    ("NUMBER", "30", "0", "", "BIGNUMERIC", "BIGNUMERIC(30, 0)", "BIGNUMERIC(30, 0)", "decimal(30,0)"),
    ("NUMBER", "38", "0", "", "BIGNUMERIC", "BIGNUMERIC(38, 0)", "BIGNUMERIC(38, 0)", "decimal(38,0)"),
    ("NUMBER", "50", "0", "", "BIGNUMERIC", "BIGNUMERIC(50, 0)", "BIGNUMERIC(50, 0)", "string"),
    ("NUMBER", "", "0", "", "BIGNUMERIC", "BIGNUMERIC", "BIGNUMERIC", "decimal(38,0)"),
    ("NUMBER", "15", "2", "", "NUMERIC", "NUMERIC(15, 2)", "NUMERIC(15, 2)", "decimal(15,2)"),
    ("NUMBER", "38", "9", "", "NUMERIC", "NUMERIC(38, 9)", "NUMERIC(38, 9)", "decimal(38,9)"),
    ("NUMBER", "3", "5", "", "NUMERIC", "NUMERIC(3, 5)", "NUMERIC(3, 5)", "decimal(5,5)"),
    ("NUMBER", "38", "10", "", "BIGNUMERIC", "BIGNUMERIC(38, 10)", "BIGNUMERIC(38, 10)", "decimal(38,10)"),
    ("NUMBER", "50", "10", "", "BIGNUMERIC", "BIGNUMERIC(50, 10)", "BIGNUMERIC(50, 10)", "string"),
    ("NUMBER", "76", "38", "", "BIGNUMERIC", "BIGNUMERIC(76, 38)", "BIGNUMERIC(76, 38)", "string"),
    ("NUMBER", "80", "5", "22", "STRING", "STRING", "STRING(22)", "string"),
    ("NUMBER", "20", "39", "", "STRING", "STRING", "STRING", "string"),
    ("NUMBER", "", "4", "", "NUMERIC", "NUMERIC", "NUMERIC", "decimal(38,9)"),
    ("NUMBER", "10", "-2", "", "NUMERIC", "NUMERIC(10, -2)", "NUMERIC(10, -2)", "decimal(12,0)"),
    ("NUMBER", "39", "-2", "", "NUMERIC", "BIGNUMERIC(39, -2)", "BIGNUMERIC(39, -2)", "decimal(38,0)"),
    ("NUMBER", "", "-2", "", "NUMERIC", "NUMERIC", "NUMERIC", "decimal(38,0)"),
    ("NUMBER", "10", "", "", "NUMERIC", "NUMERIC(10)", "NUMERIC(10)", "decimal(10,0)"),
    ("NUMBER", "15", " ", "", "NUMERIC", "NUMERIC(15)", "NUMERIC(15)", "decimal(15,0)"),
    ("NUMBER", "35", "", "", "NUMERIC", "BIGNUMERIC(35)", "BIGNUMERIC(35)", "decimal(35,0)"),
    ("NUMBER", "50", "", "", "NUMERIC", "BIGNUMERIC(50)", "BIGNUMERIC(50)", "string"),
    ("NUMBER", "", "", "", "NUMERIC", "NUMERIC", "NUMERIC", "decimal(38,9)"),
    ("NUMBER", "ten", "2", "", "NUMERIC", "NUMERIC", "NUMERIC", "decimal(38,9)"),
    ("NUMBER", "10", "x", "", "NUMERIC", "NUMERIC", "NUMERIC", "decimal(38,9)"),
    ("NUMBER", "10", "2", "n/a", "NUMERIC", "NUMERIC", "NUMERIC", "decimal(10,2)"),
    ("NUMBER", " 10 ", "+2", "", "NUMERIC", "NUMERIC(10, 2)", "NUMERIC(10, 2)", "decimal(10,2)"),
    ("NUMBER", "10.0", "2", "", "NUMERIC", "NUMERIC", "NUMERIC", "decimal(38,9)"),
    ("number(10)", "10", "0", "", "INT64", "INT64", "INT64", "bigint"),
    ("NUMBER (10)", "10", "0", "", "STRING", "STRING", "STRING", "string"),
    ("VARCHAR2", "", "", "100", "STRING", "STRING", "STRING(100)", "string"),
    ("VARCHAR2", "", "", "abc", "STRING", "STRING", "STRING", "string"),
    ("CHAR", "", "", "", "STRING", "STRING", "STRING", "string"),
    ("CLOB", "", "", "4000", "STRING", "STRING", "STRING(4000)", "string"),
    ("LONG", "", "", "", "STRING", "STRING", "STRING", "string"),
    ("LONG RAW", "", "", "", "STRING", "STRING", "STRING", "string"),
    ("ROWID", "", "", "", "STRING", "STRING", "STRING", "string"),
    ("INTERVAL DAY(2) TO SECOND(6)", "2", "6", "", "STRING", "STRING", "STRING", "string"),
    ("BLOB", "", "", "", "BYTES", "BYTES", "BYTES", "binary"),
    ("RAW", "", "", "16", "BYTES", "BYTES", "BYTES", "binary"),
    ("DATE", "", "", "7", "DATETIME", "DATETIME", "DATETIME", "timestamp_ntz"),
    ("TIMESTAMP", "", "", "", "DATETIME", "DATETIME", "DATETIME", "timestamp_ntz"),
    ("TIMESTAMP(6) WITH TIME ZONE", "", "6", "", "DATETIME", "DATETIME", "DATETIME", "timestamp_ntz"),
    ("INTEGER", "", "", "", "INT64", "INT64", "INT64", "bigint"),
    ("FLOAT", "126", "", "", "FLOAT64", "FLOAT64", "FLOAT64", "double"),
    ("BINARY_DOUBLE", "", "", "", "STRING", "STRING", "STRING", "string"),
    ("", "", "", "", "STRING", "STRING", "STRING", "string"),
]


def _typed(spark, **options):
    rows = [("T", f"C{i}", str(i), *case[:4]) for i, case in enumerate(TYPE_CASES)]
    header = "TABLE_NAME string, COLUMN_NAME string, COLUMN_ID string, DATA_TYPE string, DATA_PRECISION string, "
    raw = spark.createDataFrame(rows, header + "DATA_SCALE string, DATA_LENGTH string")
    return type_columns(catalog_records(raw), **options).orderBy("column_id").collect()


def test_type_rules(spark):
    for row, kept, string_only, case in zip(
        _typed(spark),
        _typed(spark, preserve_string_length=True),
        _typed(spark, preserve_string_length=True, string_mode="string_only"),
        TYPE_CASES,
    ):
        got = (row.target_type, row.type_text, kept.type_text, row.spark_type)
        assert got == case[4:], case
        assert string_only.type_text == case[5]


@pytest.mark.parametrize(
    "name, quoted",
    [
        ("normal_column", False), ("한글컬럼", True), ("123column", True), ("column-name", True), ("SELECT", True),
        ("select", True), ("FROM", True), ("valid_name_123", False), ("_x", False), ("", False), ("a b", True),
        ("line\n", True), ("é", True), ("Within", True), ("withins", False),
    ],
)
def test_quoting(spark, name, quoted):
    row = spark.range(1).select(
        names.needs_quotes(F.lit(name)).alias("needs"), names.quote_name(F.lit(name)).alias("text")
    ).first()
    assert row.needs is quoted
    assert row.text == (f"`{name}`" if quoted else name)


@pytest.mark.parametrize(
    "owner, table, project, expected",
    [
        ("S", "T", "p", "`p.S.T`"), ("S", "T", "", "`S.T`"), ("S", "T", None, "`S.T`"), ("S", "T", "  ", "`S.T`"),
        ("", "T", "p", "`p.your_dataset.T`"), (None, "T", "p", "`p.your_dataset.T`"),
        ("MyDataset", "`Customer_Info`", "p", "`p.MyDataset.Customer_Info`"),
    ],
)
def test_qualified_names(spark, owner, table, project, expected):
    frame = spark.createDataFrame([(owner, table)], "o string, t string")
    assert frame.select(names.qualified_name(F.col("o"), F.col("t"), project)).first()[0] == expected


def test_text_rules_match_python_white_space(spark):
    random.seed(11)
    letters = list(text.WHITE_SPACE_CHARACTERS) + list(' \n\r\t"\\ab한\u200b')
    samples = ['say "hi"', "a\nb\r\nc", "  many   spaces  ", "", " \u3000 "]
    samples += ["".join(random.choices(letters, k=random.randint(0, 14))) for _ in range(3000)]
    rows = (
        spark.createDataFrame([(s,) for s in samples], "s string")
        .select(
            "s",
            text.escape_description(F.col("s")).alias("clean"),
            text.strip(F.col("s")).alias("strip"),
            text.description(F.col("s")).alias("said"),
        )
        .collect()
    )
    for row in rows:
        folded = re.sub(r"\s+", " ", row.s.replace('"', '\\"')).strip()
        assert (row.clean, row.strip, row.said) == (folded, row.s.strip(), row.s.strip() or None)


def test_int_parsing(spark):
    cases = {"10": 10, " 10\t": 10, "\u300010": 10, "+5": 5, "-3": -3, "007": 7, "": None, "  ": None, "1_0": None,
             "10.0": None, "x": None, "1e3": None, "5L": None, "9" * 30: None}
    frame = spark.createDataFrame([(k,) for k in cases], "s string")
    parsed = types.parse_int(F.col("s"))
    rows = frame.select("s", parsed.alias("n"), types.is_broken_int(F.col("s"), parsed).alias("bad")).collect()
    assert {r.s: r.n for r in rows} == cases
    assert {r.s for r in rows if r.bad} == {k for k, v in cases.items() if v is None and k.strip()}


def test_stamp(spark):
    row = spark.sql("select timestamp_ntz'2026-01-02 03:04:05.678' t").select(text.stamp(F.col("t"))).first()
    assert row[0] == "2026-01-02 03:04:05"
