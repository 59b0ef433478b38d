"""CSV intake, extract, grouping and definitions on small hand-written catalogs."""

import re
from datetime import datetime
from glob import glob

import pytest
from pyspark.sql import functions as F

from tidegate.operators import columns
from tidegate.operators.positions import dense_positions
from tidegate.operators.spec import table_spec
from tidegate.plans import sample_catalogs
from tidegate.plans.ddl import DdlOptions, ddl_lines, table_ddl
from tidegate.plans.extract import extract_catalog
from tidegate.sinks import files
from tidegate.sources import dictionary
from tidegate.sources.catalog_csv import catalog_records, file_encodings, read_catalog_csv

HEADER = "TABLE_NAME,OWNER,COLUMN_NAME,DATA_TYPE,DATA_PRECISION,DATA_SCALE,DATA_LENGTH,NULLABLE,IS_PRIMARY_KEY,COLUMN_COMMENT\n"
KOREAN = '고객,샵,고객_ID,NUMBER,10,0,,N,Y,고객 번호\n고객,샵,이름,VARCHAR2,,,100,Y,N,"이름, ""별명""\n둘째 줄"\n'


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_quotes_breaks_blanks_and_order(spark, tmp_path):
    body = "".join(f"T{i % 3},S,C{i},NUMBER,10,0,,Y,N,\n" for i in range(30))
    path = _write(tmp_path / "a.csv", HEADER + KOREAN + body + ",S,LOST,NUMBER,,,,,,\n")
    rows = read_catalog_csv(spark, path).collect()
    assert len(rows) == 32
    named = {r.column_name: r for r in rows}
    assert named["이름"].column_comment == '이름, "별명"\n둘째 줄'
    assert named["이름"].char_length == "100" and named["C1"].char_length == ""
    assert (named["C1"].partition_yn, named["C1"].fk_constraint_name) == ("N", "")
    order = sorted((r.column_id, r.column_name) for r in rows if r.table_name == "T1")
    assert order == [(n + 1, f"C{3 * n + 1}") for n in range(10)]


def test_each_file_in_its_own_encoding(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _write(folder / "utf8.csv", HEADER + KOREAN.replace("고객,샵", "U,샵"))
    _write(folder / "euckr.csv", HEADER + KOREAN, "euc-kr")
    # A late byte decides: the first thousands of characters are plain.
    _write(folder / "late.csv", HEADER + "L,샵,C1,NUMBER,1,0,,Y,N,x\n" * 200 + "L,샵,똠,NUMBER,1,0,,Y,N,x\n", "cp949")
    found = {r.path.rsplit("/", 1)[1]: r.encoding for r in file_encodings(spark, str(folder)).collect()}
    assert found == {"utf8.csv": "UTF-8", "euckr.csv": "x-windows-949", "late.csv": "x-windows-949"}
    rows = read_catalog_csv(spark, str(folder)).collect()
    assert {r.schema_name for r in rows} == {"샵"}
    assert {r.column_name for r in rows if r.table_name in ("U", "고객")} == {"고객_ID", "이름"}
    assert "똠" in {r.column_name for r in rows}


def test_bom_is_ignored(spark, tmp_path):
    path = _write(tmp_path / "bom.csv", "\ufeff" + HEADER + KOREAN)
    assert {r.table_name for r in read_catalog_csv(spark, path).collect()} == {"고객"}


def test_csv_round_trip(spark, tmp_path):
    values = [("T", "a\n\"b\", c", " x "), ("T", "", "\\"), ("T", "한글", '"')]
    frame = spark.createDataFrame(values, "TABLE_NAME string, COLUMN_NAME string, COMMENTS string")
    files.write_catalog_csv(frame, str(tmp_path / "out"))
    rows = read_catalog_csv(spark, str(tmp_path / "out")).collect()
    assert sorted((r.table_name, r.column_name, r.column_comment) for r in rows) == sorted(values)


def test_header_aliases_and_defaults(spark):
    frame = spark.createDataFrame(
        [("T", "", "S1", "C", "UK1", "d1", "", "7"), ("T", "S0", "S1", "D", "", "", "note", "")],
        "TABLE_NAME string, OWNER string, TABLE_SCHEMA string, COLUMN_NAME string, UK_CONSTRAINT_NAME string, "
        "DATA_DEFAULT string, COMMENTS string, DATA_LENGTH string",
    )
    rows = {r.column_name: r for r in catalog_records(frame).collect()}
    assert rows["C"].schema_name == "S1" and rows["D"].schema_name == "S0"
    assert (rows["C"].unique_constraint_name, rows["C"].default_value, rows["C"].char_length) == ("UK1", "d1", "7")
    assert rows["D"].column_comment == "note"
    assert (rows["D"].nullable, rows["D"].is_primary_key, rows["D"].cluster_yn) == ("Y", "N", "N")


def test_positions_of_a_hot_group(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise((F.col("id") % 40).cast("string")).alias("g"), "id"
    )
    got = dense_positions(frame, ["g"], ["id"], F.floor(F.col("id") / 100), "n").collect()
    assert len(got) == 5000
    groups = {}
    for row in sorted(got, key=lambda r: r.id):
        groups.setdefault(row.g, []).append(row.n)
    assert all(n == list(range(1, len(n) + 1)) for n in groups.values())


# --- extract -----------------------------------------------------------------------------------------


def _views(spark):
    def frame(schema, rows):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in schema.split()))

    base = "OWNER TABLE_NAME COLUMN_NAME COLUMN_ID DATA_TYPE DATA_LENGTH DATA_PRECISION DATA_SCALE NULLABLE DATA_DEFAULT"
    cols = [
        ("A", "SALES", "ID", "1", "NUMBER", "22", "10", "0", "N", None),
        ("A", "SALES", "LINE", "2", "NUMBER", "22", "3", "0", "N", None),
        ("A", "SALES", "SOLD_AT", "3", "DATE", "7", None, None, "Y", None),
        ("A", "SALES", "AMOUNT", "4", "NUMBER", "22", "12", "2", "Y", "0"),
        ("A", "고객", "이름", "1", "VARCHAR2", "40", None, None, "Y", None),
        ("B", "SALES", "ID", "1", "NUMBER", "22", "10", "0", "N", None),
    ]
    constraints = [
        ("A", "SALES", "PK_S", "P", None, None),
        ("A", "SALES", "FK_S", "R", "PK_X", None),
        ("A", "SALES", "UK_S", "U", None, None),
        ("A", "SALES", "CK_1", "C", None, "AMOUNT > 0"),
        ("A", "SALES", "CK_2", "C", None, "AMOUNT < 9"),
        ("A", "SALES", "SYSTEM_CK", "C", None, "AMOUNT <> 5"),
        ("A", "SALES", "SYS_C01", "C", None, "ID IS NOT NULL"),
        ("B", "SALES", "PK_S", "P", None, None),
    ]
    covered = [
        ("A", "PK_S", "ID"), ("A", "PK_S", "LINE"), ("A", "FK_S", "ID"), ("A", "UK_S", "LINE"), ("A", "CK_1", "AMOUNT"),
        ("A", "CK_2", "AMOUNT"), ("A", "SYSTEM_CK", "AMOUNT"), ("A", "SYS_C01", "ID"), ("B", "PK_S", "ID"),
    ]
    return dictionary.DictionaryViews(
        columns=frame(base, cols),
        table_comments=frame("OWNER TABLE_NAME COMMENTS", [("A", "SALES", "All sales")]),
        column_comments=frame("OWNER TABLE_NAME COLUMN_NAME COMMENTS", [("A", "고객", "이름", "고객 이름")]),
        constraints=frame("OWNER TABLE_NAME CONSTRAINT_NAME CONSTRAINT_TYPE R_CONSTRAINT_NAME SEARCH_CONDITION", constraints),
        constraint_columns=frame("OWNER CONSTRAINT_NAME COLUMN_NAME", covered),
        partition_keys=frame(
            "OWNER NAME OBJECT_TYPE COLUMN_NAME COLUMN_POSITION",
            [("A", "SALES", "TABLE", "SOLD_AT", "1"), ("A", "SALES", "INDEX", "ID", "1")],
        ),
    )


def test_full_extract(spark):
    rows = extract_catalog(_views(spark), "full", owners=["A"]).collect()
    by_column = {}
    for row in rows:
        by_column.setdefault((row.TABLE_NAME, row.COLUMN_NAME), []).append(row)
    assert len(rows) == 6 and len(by_column[("SALES", "AMOUNT")]) == 2
    first = by_column[("SALES", "ID")][0]
    assert (first.IS_PRIMARY_KEY, first.PK_CONSTRAINT_NAME, first.FK_CONSTRAINT_NAME, first.REFERENCED_CONSTRAINT) == (
        "Y", "PK_S", "FK_S", "PK_X",
    )
    assert first.CK_CONSTRAINT_NAME is None and first.TABLE_COMMENT == "All sales" and first.PARTITION_YN == "N"
    checks = {r.CK_CONSTRAINT_NAME: r.SEARCH_CONDITION for r in by_column[("SALES", "AMOUNT")]}
    assert checks == {"CK_1": "AMOUNT > 0", "CK_2": "AMOUNT < 9"}
    assert by_column[("SALES", "SOLD_AT")][0].PARTITION_YN == "Y"
    assert by_column[("고객", "이름")][0].COLUMN_COMMENT == "고객 이름"
    assert [(r.TABLE_NAME, r.COLUMN_ID) for r in rows] == sorted((r.TABLE_NAME, r.COLUMN_ID) for r in rows)
    assert len(rows[0]) == 24


def test_extract_broadcasts_no_view(spark):
    """Views that look small to Spark may be large: none goes through the driver."""
    for variant in ("full", "simple", "tables"):
        rows = extract_catalog(_views(spark), variant, ordered=False)
        rows.collect()
        assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()


def test_extract_moves_what_it_read(spark, sf_dir):
    """What can be told from other fields is added behind the sort; rows stay where the table comments met them."""
    orders, lineitem = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem"))
    rows = extract_catalog(sample_catalogs.dictionary_views(orders, lineitem), "full")
    above, below = rows._jdf.queryExecution().executedPlan().toString().split("Exchange rangepartitioning", 1)
    assert "AS FK_CONSTRAINT_TYPE" in above
    assert not re.findall(r"AS (?:[FUC]K_CONSTRAINT_TYPE|PK_TYPE|IS_PRIMARY_KEY|CLUSTER_YN)", below)
    assert len(re.findall(r"Exchange hashpartitioning\(TABLE_NAME#\d+, OWNER#\d+,", below)) == 3  # columns and two views


def test_constraint_types_stand_beside_names(spark):
    for row in extract_catalog(_views(spark), "full").collect():
        for kind, field in (("R", "FK"), ("U", "UK"), ("C", "CK")):
            assert row[f"{field}_CONSTRAINT_TYPE"] == (None if row[f"{field}_CONSTRAINT_NAME"] is None else kind)


def test_extract_variants(spark):
    views = _views(spark)
    simple = extract_catalog(views, "simple", owners=["A", "B"]).collect()
    assert len(simple) == 6 and {r.IS_PRIMARY_KEY for r in simple} == {"N"} and {r.CK_CONSTRAINT_NAME for r in simple} == {""}
    one = extract_catalog(views, "tables", owners=["A"], tables=["SALES"]).collect()
    assert len(one) == 4 and [r.IS_PRIMARY_KEY for r in one] == ["Y", "Y", "N", "N"] and len(one[0]) == 24
    assert extract_catalog(views, "simple", owners=["A"], like="SAL%").count() == 4
    mine = dictionary.DictionaryViews(
        **{n: getattr(views, n).filter("OWNER = 'A'").drop("OWNER") for n in dictionary.VIEW_NAMES}
    )
    user = extract_catalog(mine, "user", user="ME").collect()
    assert {r.OWNER for r in user} == {"ME"} and sum(r.IS_PRIMARY_KEY == "Y" for r in user) == 2
    with pytest.raises(ValueError):
        extract_catalog(mine, "user")


def test_snapshots_round_trip(spark, tmp_path):
    views = _views(spark)
    for name, view in dictionary.VIEW_NAMES.items():
        getattr(views, name).write.parquet(str(tmp_path / f"ALL_{view}"))
    back = dictionary.read_snapshots(spark, str(tmp_path))
    assert extract_catalog(back, "full").count() == extract_catalog(views, "full").count()


def test_partition_diagnostics(spark):
    views = _views(spark)
    assert [r.COLUMN_NAME for r in dictionary.partition_key_columns(views.partition_keys, "A").collect()] == ["SOLD_AT"]
    tables = spark.createDataFrame(
        [("A", "SALES", "RANGE", 3), ("B", "X", "LIST", 1)],
        "OWNER string, TABLE_NAME string, PARTITIONING_TYPE string, PARTITION_COUNT int",
    )
    assert [r.TABLE_NAME for r in dictionary.partitioned_tables(tables, "A").collect()] == ["SALES"]


# --- definitions -------------------------------------------------------------------------------------


def _catalog(spark, rows):
    """Rows of (table, column, type, precision, scale, nullable, key, comment, partition, cluster)."""
    header = "TABLE_NAME COLUMN_NAME DATA_TYPE DATA_PRECISION DATA_SCALE NULLABLE IS_PRIMARY_KEY COLUMN_COMMENT PARTITION_YN CLUSTER_YN"
    numbered = [("MyDataset", str(i), *row) for i, row in enumerate(rows, 1)]
    schema = "OWNER string, COLUMN_ID string, " + ", ".join(f"{c} string" for c in header.split())
    return columns.type_columns(catalog_records(spark.createDataFrame(numbered, schema)))


SALES = [
    ("Sales", "Order", "NUMBER", "10", "0", "N", "Y", 'the "key"\n of it', "N", "y"),
    ("Sales", "고객", "VARCHAR2", "", "", "Y", "y", "", "N", "N"),
    ("Sales", "SoldAt", "TIMESTAMP(6)", "", "", "n", "N", "  ", "Y", "N"),
    ("Sales", "Amount", "NUMBER", "12", "2", "Y", "N", "", "Y", "Y"),
]
SALES_DDL = """CREATE TABLE `your_project.MyDataset.Sales` (
  `Order` INT64 NOT NULL OPTIONS(description="the \\"key\\" of it"),
  `고객` STRING,
  SoldAt DATETIME,
  Amount NUMERIC(12, 2)
,
  PRIMARY KEY (`Order`, `고객`) NOT ENFORCED
)
PARTITION BY DATETIME_TRUNC(SoldAt, DAY)
CLUSTER BY `Order`, Amount
;"""


def _text(frame):
    rows = sorted(frame.collect(), key=lambda r: (r.schema_name, r.table_name))
    return "\n".join(r.ddl for r in rows)


def test_definition_text(spark):
    assert _text(table_ddl(_catalog(spark, SALES))) == SALES_DDL


def test_definition_options(spark):
    typed = _catalog(spark, SALES)
    text = _text(
        table_ddl(
            typed,
            DdlOptions(project=None, create_primary_keys=False, create_or_replace=True,
                       drop_partition_table_before_create=True, partition_expiration_days=30, enable_clustering=False),
        )
    )
    assert text.startswith(
        "DROP TABLE IF EXISTS `MyDataset.Sales`;\n\nCREATE OR REPLACE TABLE `MyDataset.Sales` (\n"
    )
    assert "PRIMARY KEY" not in text and "CLUSTER BY" not in text
    assert text.endswith(")\nPARTITION BY DATETIME_TRUNC(SoldAt, DAY)\nOPTIONS(partition_expiration_days=30)\n;")
    off = _text(table_ddl(typed, DdlOptions(enable_partitioning=False, partition_expiration_days=30, max_cluster_columns=1)))
    assert "PARTITION BY" not in off and "expiration" not in off and off.endswith(")\nCLUSTER BY `Order`\n;")
    # Dropping needs replacing and a partition flag.
    assert "DROP" not in _text(table_ddl(typed, DdlOptions(drop_partition_table_before_create=True)))
    plain = _catalog(spark, [("T", "ID", "NUMBER", "10", "0", "N", "Y", "", "N", "N")])
    options = DdlOptions(create_or_replace=True, drop_partition_table_before_create=True, partition_expiration_days=3)
    text = _text(table_ddl(plain, options))
    assert "DROP" not in text and text.endswith("NOT ENFORCED\n)\nOPTIONS(partition_expiration_days=3)\n;")


@pytest.mark.parametrize("kind", ["VARCHAR2", "NUMBER", "BLOB"])
def test_first_partition_column_decides(spark, kind):
    rows = [("T", "A", kind, "10", "0", "Y", "N", "", "Y", "N"), ("T", "B", "DATE", "", "", "Y", "N", "", "Y", "N")]
    assert "PARTITION BY" not in _text(table_ddl(_catalog(spark, rows)))


def test_sixteen_key_columns(spark):
    rows = [("T", f"PK{i:02d}", "NUMBER", "10", "0", "N", "Y", "", "N", "N") for i in range(1, 19)]
    text = _text(table_ddl(_catalog(spark, rows)))
    assert "PRIMARY KEY (" + ", ".join(f"PK{i:02d}" for i in range(1, 17)) + ") NOT ENFORCED" in text


def test_tables_of_any_size_and_numbering(spark):
    def row(i, number):
        return ("S", "T", f"C{i:05d}", number, "DATE" if i == 12 else "NUMBER", "Y" if i in (2, 7, 14) else "N", "Y" if i == 12 else "N", "Y" if i in (4, 1500) else "N")

    header = "OWNER string, TABLE_NAME string, COLUMN_NAME string, COLUMN_ID string, DATA_TYPE string, IS_PRIMARY_KEY string, PARTITION_YN string, CLUSTER_YN string"
    blank = [row(i, "") for i in range(2000)]
    gapped = [row(i, str(i * i + 5)) for i in range(2000)]
    repeated = [row(i, str(i // 3)) for i in range(2000)]
    texts = set()
    for rows in (blank, gapped, repeated):
        typed = columns.type_columns(catalog_records(spark.createDataFrame(rows, header).coalesce(1)))
        statements = table_ddl(typed).collect()
        assert len(statements) == 1
        texts.add(statements[0].ddl)
        lines = sorted(ddl_lines(typed).collect(), key=lambda r: (r.section, r.position, r.tie))
        assert "\n".join(r.line for r in lines) == statements[0].ddl
        assert [r.columns for r in columns.grouped_columns(typed).select(F.size("columns").alias("columns")).collect()] == [2000]
    text = texts.pop()
    assert not texts and text.count("CLUSTER BY ") == 1 and "CLUSTER BY C00004, C01500" in text
    assert [c.split()[0] for c in text.splitlines()[1:2001]] == [f"C{i:05d}" for i in range(2000)]


def test_dropped_keys_are_shown(spark):
    rows = [("T", f"PK{i:02d}", "NUMBER", "10", "0", "N", "Y", "", "N", "N") for i in range(1, 19)]
    found = columns.key_columns(_catalog(spark, rows)).collect()[0]
    assert (found.key_columns, found.dropped_keys) == (16, "PK17, PK18")
    assert "PK18)" in _text(table_ddl(_catalog(spark, rows), DdlOptions(max_key_columns=18)))


def test_merged_text_in_order(spark, tmp_path):
    two = [(f"T{n}", *row[1:]) for n in range(12) for row in SALES]
    typed = _catalog(spark, two)
    path = str(tmp_path / "merged")
    files.write_merged(ddl_lines(typed), columns.table_count(typed), path, datetime(2026, 1, 2, 3, 4, 5), title="Definitions")
    text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob(path + "/part-*")))
    assert text.startswith("-- Definitions\n-- Generated on: 2026-01-02 03:04:05\n-- Total tables: 12\n\n-- =====")
    rule = "-- ========================================"
    for name in sorted(f"T{n}" for n in range(12)):
        section = f"{rule}\n-- Table: {name}\n-- Schema: MyDataset\n{rule}\n\n" + SALES_DDL.replace(".Sales`", f".{name}`") + "\n\n"
        assert section in text
    heads = [line for line in text.splitlines() if line.startswith("-- Table: ")]
    assert heads == sorted(heads) and len(heads) == 12


def test_one_folder_per_table(spark, tmp_path):
    typed = _catalog(spark, SALES + [("S_ales", *SALES[0][1:])])
    path = tmp_path / "ddl"
    files.write_per_table(ddl_lines(typed), str(path))
    found = glob(f"{path}/schema_name=MyDataset/table_name=Sales/part-*")
    assert len(found) == 1 and open(found[0], encoding="utf-8").read().rstrip("\n") == SALES_DDL
    assert glob(f"{path}/schema_name=MyDataset/table_name=S_ales/part-*")


def test_lists_of_a_table_come_from_its_parts(spark):
    """Columns far apart: keys and clusters stay in order, and no aggregate holds the entries of a whole table."""
    place = (F.col("id") * 50_000).cast("string")
    raw = spark.range(1, 31).select(
        F.lit("S").alias("OWNER"), F.lit("T").alias("TABLE_NAME"), F.concat(F.lit("C"), "id").alias("COLUMN_NAME"),
        place.alias("COLUMN_ID"), F.lit("DATE").alias("DATA_TYPE"), F.lit("Y").alias("IS_PRIMARY_KEY"),
        F.when(F.col("id") % 2 == 0, "y").otherwise("N").alias("CLUSTER_YN"),
    )
    rows = ddl_lines(columns.type_columns(catalog_records(raw, numbered=True)))
    lines = [r.line for r in rows.orderBy("section", "position", "tie").collect()]
    assert f"  PRIMARY KEY ({', '.join(f'C{i}' for i in range(1, 17))}) NOT ENFORCED" in lines
    assert f"CLUSTER BY {', '.join(f'C{i}' for i in range(2, 31, 2))}" in lines
    assert [x.strip().split()[0] for x in lines[1:31]] == [f"C{i}" for i in range(1, 31)]
    assert [x.endswith(",") for x in lines[1:31]] == [True] * 29 + [False]
    assert "_part" in rows._jdf.queryExecution().optimizedPlan().toString()
    top = ddl_lines(columns.type_columns(catalog_records(raw, numbered=True)), DdlOptions(max_cluster_columns=3))
    assert "CLUSTER BY C2, C4, C6" in [r.line for r in top.collect()]


def test_csv_files_are_of_bounded_size(spark, tmp_path):
    """No written file needs more than one task to be read, whatever its fields hold."""
    rows = spark.range(25).select(F.concat(F.lit("T"), "id").alias("TABLE_NAME"), F.lit("a\nb").alias("COLUMN_COMMENT"))
    files.write_catalog_csv(rows.coalesce(1), str(tmp_path / "x"), rows_per_file=10)
    assert len(glob(str(tmp_path / "x" / "*.csv"))) == 3
    back = read_catalog_csv(spark, str(tmp_path / "x"))
    assert sorted(r.table_name for r in back.collect()) == sorted(f"T{i}" for i in range(25))


def test_extract_to_definitions(spark):
    unique = columns.dedupe(catalog_records(extract_catalog(_views(spark), "full", ordered=False)))
    assert unique.count() == 6
    typed = columns.type_columns(unique)
    text = _text(table_ddl(typed.filter("schema_name = 'A' and table_name = 'SALES'")))
    assert text.count("AMOUNT") == 1 and "PRIMARY KEY (ID, LINE) NOT ENFORCED" in text
    assert "PARTITION BY DATETIME_TRUNC(SOLD_AT, DAY)" in text
    spec = table_spec(typed, "A", "SALES")
    assert [(c.name, c.spark_type, c.nullable) for c in spec] == [
        ("ID", "bigint", False), ("LINE", "bigint", False), ("SOLD_AT", "timestamp_ntz", True), ("AMOUNT", "decimal(12,2)", True),
    ]


def test_fanout_and_limits(spark):
    rows = [("T", "A", "DATE", "", "", "Y", "N", "", "Y", "N"), ("T", "A", "DATE", "", "", "Y", "N", "", "Y", "N")]
    rows += [("U", f"K{i}", "NUMBER", "5", "0", "Y", "Y", "", "N", "Y") for i in range(17)]
    rows += [("V", "A", "NUMBER", "5", "0", "Y", "N", "", "Y", "N"), ("W", "A", "DATE", "", "", "Y", "N", "", "Y", "N")]
    typed = _catalog(spark, rows)
    assert {(r.table_name, r.copies) for r in columns.fanout_report(typed).collect()} == {("T", 2)}
    found = {r.table_name: r for r in columns.limit_audit(typed).collect()}
    assert set(found) == {"T", "U", "V"}
    assert (found["U"].key_columns, found["U"].cluster_columns, found["T"].partition_flags) == (17, 17, 2)
    assert found["V"].unsupported_partition and not found["T"].unsupported_partition


def test_bytes_of_no_known_encoding_raise(spark, tmp_path):
    path = _write(tmp_path / "latin.csv", HEADER + "T,S,C1,NUMBER,10,0,,Y,N,café réel\n", "latin-1")
    with pytest.raises(ValueError, match="latin.csv"):
        read_catalog_csv(spark, path)
    named = read_catalog_csv(spark, path, encoding="ISO-8859-1").collect()
    assert named[0].column_comment == "café réel"


def test_owner_ranges_are_disjoint_and_complete(spark):
    owners = spark.createDataFrame([("A",), ("F",), ("M",), ("O'X",), ("Z",), (None,)], "OWNER string")
    ranges = dictionary.owner_predicates(["M", "F", "O'X"])
    assert [owners.filter(p).count() for p in ranges] == [2, 1, 1, 2]
    assert dictionary.owner_predicates([]) == ["1 = 1"]
