"""The same questions as plain SQL over the same tables, written apart from the Spark code, constants included."""

from __future__ import annotations

# Words that the target reserves, its limits, and the rule drawn in the merged text.
RESERVED_WORDS = """
    ALL AND ANY ARRAY AS ASC ASSERT_ROWS_MODIFIED AT BETWEEN BY CASE CAST COLLATE CONTAINS CREATE CROSS CUBE CURRENT
    DEFAULT DEFINE DESC DISTINCT ELSE END ENUM ESCAPE EXCEPT EXCLUDE EXISTS EXTRACT FALSE FETCH FOLLOWING FOR FROM FULL
    GROUP GROUPING GROUPS HASH HAVING IF IGNORE IN INNER INTERSECT INTERVAL INTO IS JOIN LATERAL LEFT LIKE LIMIT LOOKUP
    MERGE NATURAL NEW NO NOT NULL NULLS OF ON OR ORDER OUTER OVER PARTITION PRECEDING PROTO RANGE RECURSIVE RESPECT
    RIGHT ROLLUP ROWS SELECT SET SOME STRUCT TABLESAMPLE THEN TO TREAT TRUE UNBOUNDED UNION UNNEST USING WHEN WHERE
    WINDOW WITH WITHIN
""".split()
MAX_KEY_COLUMNS, MAX_CLUSTER_COLUMNS = 16, 4
RULE = "-- ========================================"
# What counts as white space, as a character class of code points.
WHITE_SPACE = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The types that the sample catalogs take in turn, and the constraints of their tables with their columns.
SOURCE_TYPES = [
    "NUMBER", "NUMBER", "VARCHAR2", "CHAR", "DATE", "TIMESTAMP(6)", "TIMESTAMP(6) WITH TIME ZONE",
    "CLOB", "RAW", "INTEGER", "FLOAT", "INTERVAL DAY(2) TO SECOND(6)",
]
SAMPLE_CONSTRAINTS = [
    ("PK_T", "P", ["C1", "C2"]),
    ("FK_T", "R", ["C2"]),
    ("UK_T", "U", ["C2", "C3"]),
    ("CK_T", "C", ["C3"]),
    ("CK2_T", "C", ["C3", "C4"]),
    ("SYSTEM_CK_T", "C", ["C1"]),
]

# --- the sample catalogs -------------------------------------------------------------------------


def _quoted(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


_DESCRIBED = f"""
    list_extract([{_quoted(SOURCE_TYPES)}], CAST(l_partkey % 12 + 1 AS INT)) AS data_type,
    CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE CAST(l_orderkey % 80 AS VARCHAR) END AS data_precision,
    CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_partkey % 45 - 3 AS VARCHAR) END AS data_scale,
    CASE WHEN l_quantity = 13 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS char_length,
    CASE WHEN l_quantity = 13 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS data_length,
    CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'Y' END AS nullable,
    CASE WHEN l_linenumber <= 2 THEN 'Y' ELSE 'n' END AS is_primary_key,
    CASE WHEN l_returnflag = 'A' THEN 'FK_' || (l_suppkey % 3) ELSE '' END AS fk_constraint_name,
    CASE WHEN l_returnflag = 'N' THEN 'UK_' || (l_partkey % 2) ELSE '' END AS unique_constraint_name,
    '' AS default_value,
    '' AS data_default,
    CASE WHEN l_linestatus = 'O'
         THEN '  ships "' || CAST(l_shipdate AS DATE) || '"' || chr(10) || chr(9) || 'from  ' || l_suppkey || ' 창고 '
         ELSE '  ' END AS column_comment,
    CASE WHEN l_returnflag = 'R' THEN 'y' ELSE 'N' END AS partition_yn,
    CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE '' END AS cluster_yn"""

NARROW = f"""
cat AS (
  SELECT 'SCHEMA' || (l_orderkey % 5) AS schema_name, 'T' || l_orderkey AS table_name,
    'C' || l_linenumber AS column_name, CAST(l_linenumber AS BIGINT) AS column_id, {_DESCRIBED}
  FROM lineitem)"""

WIDE = f"""
placed AS (
  SELECT *, row_number() OVER (
      PARTITION BY l_suppkey
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, l_shipdate) AS place
  FROM lineitem),
cat AS (
  SELECT 'SCHEMA' || (l_suppkey % 5) AS schema_name, 'T' || l_suppkey AS table_name,
    CASE WHEN place = 7 THEN 'Order'
         WHEN place % 5 = 0 THEN 'C-' || place
         WHEN place % 11 = 0 THEN '컬럼' || place
         WHEN place % 13 = 0 THEN place || 'C'
         ELSE 'C' || place END AS column_name,
    CAST(place AS BIGINT) AS column_id, {_DESCRIBED}
  FROM placed)"""

# One table per schema with all lines as its columns; positions have gaps and repeat.
HUGE = f"""
cat AS (
  SELECT 'SCHEMA' || (l_orderkey % 5) AS schema_name, 'ALL_LINES' AS table_name,
    'L' || l_orderkey || '_' || l_linenumber || '_' || row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                 l_shipdate) AS column_name,
    CAST(l_orderkey * 10 AS BIGINT) AS column_id, {_DESCRIBED}
  FROM lineitem)"""

# The order of the rows of one column, without what is the same in all extracts.
EXTRACT_ORDER = """column_id, data_type, data_precision, data_scale, char_length, data_length, nullable, is_primary_key,
  fk_constraint_name, unique_constraint_name, column_comment, partition_yn, cluster_yn"""
RECORD_ORDER = EXTRACT_ORDER.replace("column_comment", "default_value, data_default, column_comment")


def _folded(source: str, order: str) -> str:
    """The first row of each column, with the flags and constraint names of all its rows."""

    def flag(name: str) -> str:
        return f"""CASE WHEN bool_or(upper({name}) = 'Y') OVER w AND upper({name}) <> 'Y' THEN 'Y' ELSE {name} END AS {name}"""

    def name_set(name: str) -> str:
        names = f"list({name}) FILTER ({name} <> '') OVER w"
        return f"coalesce(array_to_string(list_sort(list_distinct({names})), ','), '') AS {name}"

    return f"""folded AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT * REPLACE ({flag("is_primary_key")}, {flag("partition_yn")}, {flag("cluster_yn")},
        {name_set("fk_constraint_name")}, {name_set("unique_constraint_name")},
        CASE WHEN bool_or(nullable = 'N') OVER w THEN 'N' ELSE nullable END AS nullable),
      row_number() OVER (PARTITION BY schema_name, table_name, column_name ORDER BY {order}) AS place
    FROM {source}
    WINDOW w AS (PARTITION BY schema_name, table_name, column_name))
  WHERE place = 1)"""


RECORD = """schema_name, table_name, column_name, data_type, data_precision, data_scale, char_length,
  data_length, nullable, is_primary_key, fk_constraint_name, unique_constraint_name, default_value,
  data_default, column_comment, partition_yn, cluster_yn"""

# --- type rules, in the order of the rule table ----------------------------------------------------


def _int(column: str) -> str:
    return rf"CASE WHEN regexp_matches(trim({column}), '\A[+-]?[0-9]+\z') THEN TRY_CAST(trim({column}) AS BIGINT) END"


def _broken(column: str) -> str:
    return rf"(trim({column}) <> '' AND NOT regexp_matches(trim({column}), '\A[+-]?[0-9]+\z'))"


def typed(source: str = "cat", keep_length: bool = False) -> str:
    """CTEs that end in ``typed``: every catalog row with its three types."""
    text_with_length = (
        "WHEN target_type = 'STRING' AND fn IS NOT NULL THEN 'STRING(' || fn || ')'" if keep_length else ""
    )
    return f"""
numbers AS (
  SELECT *, split_part(upper(data_type), '(', 1) AS base,
    {_int("data_precision")} AS p0, {_int("data_scale")} AS s0, {_int("char_length")} AS n0,
    {_broken("data_precision")} OR {_broken("data_scale")} AS bad,
    {_broken("char_length")} AS bad_n
  FROM {source}),
guarded AS (
  SELECT *, CASE WHEN NOT bad THEN p0 END AS p, CASE WHEN NOT bad THEN s0 END AS s,
    CASE WHEN NOT (bad OR bad_n) THEN p0 END AS fp, CASE WHEN NOT (bad OR bad_n) THEN s0 END AS fs,
    CASE WHEN NOT (bad OR bad_n) THEN n0 END AS fn
  FROM numbers),
targeted AS (
  SELECT *, CASE
    WHEN base = 'NUMBER' AND p IS NULL AND s IS NULL THEN 'NUMERIC'
    WHEN base = 'NUMBER' AND s = 0 AND p <= 18 THEN 'INT64'
    WHEN base = 'NUMBER' AND s = 0 AND p <= 29 THEN 'NUMERIC'
    WHEN base = 'NUMBER' AND s = 0 THEN 'BIGNUMERIC'
    WHEN base = 'NUMBER' AND s > 0 AND p <= 38 AND s <= 9 THEN 'NUMERIC'
    WHEN base = 'NUMBER' AND s > 0 AND p <= 76 AND s <= 38 THEN 'BIGNUMERIC'
    WHEN base = 'NUMBER' AND s > 0 AND p IS NOT NULL THEN 'STRING'
    WHEN base = 'NUMBER' THEN 'NUMERIC'
    WHEN base LIKE 'TIMESTAMP%' THEN 'DATETIME'
    WHEN base IN ('BLOB', 'RAW') THEN 'BYTES'
    WHEN base = 'DATE' THEN 'DATETIME'
    WHEN base = 'INTEGER' THEN 'INT64'
    WHEN base = 'FLOAT' THEN 'FLOAT64'
    ELSE 'STRING' END AS target_type
  FROM guarded),
typed AS (
  SELECT *,
    CASE
      WHEN target_type = 'NUMERIC' AND fs = 0 AND fp > 29 THEN 'BIGNUMERIC(' || fp || ', ' || fs || ')'
      WHEN target_type = 'NUMERIC' AND fs IS NOT NULL AND (fp > 38 OR (fp IS NOT NULL AND fs > 9))
        THEN 'BIGNUMERIC(' || fp || ', ' || fs || ')'
      WHEN target_type IN ('NUMERIC', 'BIGNUMERIC') AND fp IS NOT NULL AND fs IS NOT NULL
        THEN target_type || '(' || fp || ', ' || fs || ')'
      WHEN target_type = 'NUMERIC' AND fp > 29 THEN 'BIGNUMERIC(' || fp || ')'
      WHEN target_type IN ('NUMERIC', 'BIGNUMERIC') AND fp IS NOT NULL THEN target_type || '(' || fp || ')'
      {text_with_length}
      ELSE target_type END AS type_text,
    CASE
      WHEN target_type = 'INT64' THEN 'bigint'
      WHEN target_type = 'FLOAT64' THEN 'double'
      WHEN target_type = 'DATETIME' THEN 'timestamp_ntz'
      WHEN target_type = 'BYTES' THEN 'binary'
      WHEN target_type = 'STRING' THEN 'string'
      WHEN p IS NULL AND s <= 0 THEN 'decimal(38,0)'
      WHEN p IS NULL THEN 'decimal(38,9)'
      WHEN s < 0 THEN 'decimal(' || least(greatest(p, 1) - s, 38) || ',0)'
      WHEN p > 38 THEN 'string'
      WHEN s > 0 THEN 'decimal(' || greatest(p, s) || ',' || s || ')'
      ELSE 'decimal(' || greatest(p, 1) || ',0)' END AS spark_type
  FROM targeted)"""


def _needs_quotes(name: str) -> str:
    return (
        rf"({name} <> '' AND (NOT regexp_matches({name}, '\A[A-Za-z_][A-Za-z0-9_]*\z')"
        f" OR upper({name}) IN ({_quoted(RESERVED_WORDS)})))"
    )


def _quote(name: str) -> str:
    return f"CASE WHEN {_needs_quotes(name)} THEN '`' || {name} || '`' ELSE {name} END"


def _clean(text: str) -> str:
    return f"""trim(regexp_replace(replace({text}, '"', '\\"'), '{WHITE_SPACE}+', ' ', 'g'), ' ')"""


_DEFINITION = f"""({_quote("column_name")}) || ' ' || type_text
    || CASE WHEN nullable = 'N' THEN ' NOT NULL' ELSE '' END
    || CASE WHEN {_clean("column_comment")} <> ''
            THEN ' OPTIONS(description="' || {_clean("column_comment")} || '")' ELSE '' END"""

_PARTITION = f"""CASE WHEN target_type = 'DATETIME'
    THEN 'PARTITION BY DATETIME_TRUNC(' || ({_quote("column_name")}) || ', DAY)' END"""

_FIRST_PARTITION = f"""
first_partition AS (
  SELECT schema_name, table_name, column_name AS partition_column, target_type, {_PARTITION} AS clause
  FROM (SELECT *, row_number() OVER (PARTITION BY schema_name, table_name ORDER BY column_id, column_name) AS place
        FROM typed WHERE upper(partition_yn) = 'Y')
  WHERE place = 1)"""

_KEYS = f"""
keys AS (
  SELECT schema_name, table_name, count(*) FILTER (place <= {MAX_KEY_COLUMNS}) AS key_columns,
    string_agg({_quote("column_name")}, ', ' ORDER BY column_id, column_name)
      FILTER (place <= {MAX_KEY_COLUMNS}) AS key_list,
    coalesce(string_agg({_quote("column_name")}, ', ' ORDER BY column_id, column_name)
      FILTER (place > {MAX_KEY_COLUMNS}), '') AS dropped_keys
  FROM (SELECT *, row_number() OVER (PARTITION BY schema_name, table_name ORDER BY column_id, column_name) AS place
        FROM cat WHERE upper(is_primary_key) = 'Y')
  GROUP BY ALL)"""


def _clusters(limit: int | None) -> str:
    kept = f"WHERE place <= {limit}" if limit else ""
    return f"""
clusters AS (
  SELECT schema_name, table_name, count(*) AS cluster_columns,
    'CLUSTER BY ' || string_agg({_quote("column_name")}, ', ' ORDER BY column_id, column_name) AS clause
  FROM (SELECT *, row_number() OVER (PARTITION BY schema_name, table_name ORDER BY column_id, column_name) AS place
        FROM cat WHERE upper(cluster_yn) = 'Y')
  {kept}
  GROUP BY ALL)"""


def ddl(
    catalog: str,
    source: str = "cat",
    keep_length: bool = False,
    full_name: str = "'`your_project.' || schema_name || '.' || table_name || '`'",
    replace: bool = False,
    cluster_limit: int | None = None,
    expiry: int | None = None,
) -> str:
    """CTEs that end in ``ddl``: one statement per table."""
    create = "CREATE OR REPLACE TABLE " if replace else "CREATE TABLE "
    full_name = full_name.replace("schema_name", "b.schema_name").replace("table_name", "b.table_name")
    drop = (
        f"CASE WHEN flagged THEN 'DROP TABLE IF EXISTS ' || {full_name} || ';' || chr(10) || chr(10) ELSE '' END ||"
        if replace
        else ""
    )
    options = f"|| chr(10) || 'OPTIONS(partition_expiration_days={expiry})'" if expiry else ""
    return f"""{catalog},
{typed(source, keep_length)},
{_FIRST_PARTITION},
{_KEYS},
{_clusters(cluster_limit)},
bodies AS (
  SELECT schema_name, table_name, bool_or(upper(partition_yn) = 'Y') AS flagged,
    string_agg('  ' || {_DEFINITION}, ',' || chr(10) ORDER BY column_id, column_name) AS body
  FROM typed GROUP BY ALL),
ddl AS (
  SELECT b.schema_name, b.table_name,
    {drop} '{create}' || {full_name}
      || ' (' || chr(10) || body
      || CASE WHEN key_list IS NOT NULL
              THEN chr(10) || ',' || chr(10) || '  PRIMARY KEY (' || key_list || ') NOT ENFORCED' ELSE '' END
      || chr(10) || ')'
      || coalesce(chr(10) || f.clause, '')
      || coalesce(chr(10) || c.clause, '') {options}
      || chr(10) || ';' AS ddl
  FROM bodies b
  LEFT JOIN first_partition f ON b.schema_name = f.schema_name AND b.table_name = f.table_name
  LEFT JOIN keys k ON b.schema_name = k.schema_name AND b.table_name = k.table_name
  LEFT JOIN clusters c ON b.schema_name = c.schema_name AND b.table_name = c.table_name)"""


_DDL_ROWS = "SELECT schema_name, table_name, ddl FROM ddl"

# --- the dictionary views and the extract ----------------------------------------------------------

_COVERED = ", ".join(
    f"{{'prefix': '{prefix}', 'col': '{column}'}}" for prefix, _, covered in SAMPLE_CONSTRAINTS for column in covered
)
_KINDS = ", ".join(f"{{'prefix': '{prefix}', 'kind': '{kind}'}}" for prefix, kind, _ in SAMPLE_CONSTRAINTS)

DICTIONARY = f"""
described AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, min(l_partkey) AS part, min(l_suppkey) AS supp,
    min(l_quantity) AS qty, min(l_linestatus) AS status, min(l_returnflag) AS flag,
    max(CAST(l_shipdate AS DATE)) AS shipped
  FROM lineitem GROUP BY ALL),
all_tab_columns AS (
  SELECT 'SCHEMA' || (ok % 5) AS OWNER, 'T' || ok AS TABLE_NAME, 'C' || ln AS COLUMN_NAME, ln AS COLUMN_ID,
    list_extract([{_quoted(SOURCE_TYPES)}], CAST(part % 12 + 1 AS INT)) AS DATA_TYPE,
    CAST(qty AS INT) AS DATA_LENGTH,
    CAST(CASE WHEN supp % 4 <> 0 THEN ok % 80 END AS INT) AS DATA_PRECISION,
    CAST(CASE WHEN supp % 4 <> 0 THEN part % 45 - 3 END AS INT) AS DATA_SCALE,
    CASE WHEN status = 'O' THEN 'N' ELSE 'Y' END AS NULLABLE, CAST(NULL AS VARCHAR) AS DATA_DEFAULT
  FROM described),
all_col_comments AS (
  SELECT 'SCHEMA' || (ok % 5) AS OWNER, 'T' || ok AS TABLE_NAME, 'C' || ln AS COLUMN_NAME,
    'ships ' || shipped AS COMMENTS
  FROM described WHERE flag = 'A'),
all_tab_comments AS (
  SELECT 'SCHEMA' || (o_orderkey % 5) AS OWNER, 'T' || o_orderkey AS TABLE_NAME, o_orderpriority AS COMMENTS
  FROM orders WHERE o_orderstatus <> 'P'),
all_constraints AS (
  SELECT 'SCHEMA' || (o_orderkey % 5) AS OWNER, 'T' || o_orderkey AS TABLE_NAME,
    k.prefix || o_orderkey AS CONSTRAINT_NAME, k.kind AS CONSTRAINT_TYPE,
    CASE WHEN k.kind = 'R' THEN 'PK_T' || o_custkey END AS R_CONSTRAINT_NAME,
    CASE WHEN k.kind = 'C' THEN 'C3 > ' || (o_custkey % 7) END AS SEARCH_CONDITION
  FROM (SELECT o_orderkey, o_custkey, unnest([{_KINDS}]) AS k FROM orders)),
all_cons_columns AS (
  SELECT 'SCHEMA' || (o_orderkey % 5) AS OWNER, 'T' || o_orderkey AS TABLE_NAME,
    k.prefix || o_orderkey AS CONSTRAINT_NAME, k.col AS COLUMN_NAME
  FROM (SELECT o_orderkey, unnest([{_COVERED}]) AS k FROM orders)),
all_part_key_columns AS (
  SELECT 'SCHEMA' || (o_orderkey % 5) AS OWNER, 'T' || o_orderkey AS NAME,
    CASE WHEN o_orderstatus = 'O' THEN 'INDEX' ELSE 'TABLE' END AS OBJECT_TYPE, 'C1' AS COLUMN_NAME,
    1 AS COLUMN_POSITION
  FROM orders),
constrained AS (
  SELECT c.OWNER, c.TABLE_NAME, cc.COLUMN_NAME, c.CONSTRAINT_NAME, c.CONSTRAINT_TYPE, c.R_CONSTRAINT_NAME,
    c.SEARCH_CONDITION
  FROM all_constraints c JOIN all_cons_columns cc
    ON c.OWNER = cc.OWNER AND c.CONSTRAINT_NAME = cc.CONSTRAINT_NAME)"""

_BASE = """a.TABLE_NAME, a.OWNER, a.COLUMN_NAME, a.COLUMN_ID, a.DATA_TYPE, a.DATA_LENGTH, a.DATA_PRECISION,
    a.DATA_SCALE, a.NULLABLE, a.DATA_DEFAULT"""
_BLANK_CONSTRAINTS = """'' AS FK_CONSTRAINT_TYPE, '' AS FK_CONSTRAINT_NAME, '' AS REFERENCED_CONSTRAINT,
    '' AS UK_CONSTRAINT_TYPE, '' AS UK_CONSTRAINT_NAME, '' AS CK_CONSTRAINT_TYPE, '' AS CK_CONSTRAINT_NAME,
    '' AS SEARCH_CONDITION"""
_ON = "ON a.OWNER = {0}.OWNER AND a.TABLE_NAME = {0}.TABLE_NAME AND a.COLUMN_NAME = {0}.COLUMN_NAME"
_COMMON_JOINS = f"""
  LEFT JOIN all_tab_comments tc ON a.OWNER = tc.OWNER AND a.TABLE_NAME = tc.TABLE_NAME
  LEFT JOIN all_col_comments co {_ON.format("co")}
  LEFT JOIN (SELECT OWNER, NAME AS TABLE_NAME, COLUMN_NAME FROM all_part_key_columns
             WHERE OBJECT_TYPE = 'TABLE') pt {_ON.format("pt")}"""
_TAIL = """tc.COMMENTS AS TABLE_COMMENT, co.COMMENTS AS COLUMN_COMMENT,
    CASE WHEN pt.COLUMN_NAME IS NOT NULL THEN 'Y' ELSE 'N' END AS PARTITION_YN, 'N' AS CLUSTER_YN"""


def _kind(alias: str, kind: str, extra: str = "") -> str:
    return f"LEFT JOIN (SELECT * FROM constrained WHERE CONSTRAINT_TYPE = '{kind}' {extra}) {alias} {_ON.format(alias)}"


_EXTRACT_FULL = f"""
  SELECT {_BASE}, CASE WHEN pk.CONSTRAINT_TYPE = 'P' THEN 'Y' ELSE 'N' END AS IS_PRIMARY_KEY,
    pk.CONSTRAINT_NAME AS PK_CONSTRAINT_NAME, fk.CONSTRAINT_TYPE AS FK_CONSTRAINT_TYPE,
    fk.CONSTRAINT_NAME AS FK_CONSTRAINT_NAME, fk.R_CONSTRAINT_NAME AS REFERENCED_CONSTRAINT,
    uk.CONSTRAINT_TYPE AS UK_CONSTRAINT_TYPE, uk.CONSTRAINT_NAME AS UK_CONSTRAINT_NAME,
    ck.CONSTRAINT_TYPE AS CK_CONSTRAINT_TYPE, ck.CONSTRAINT_NAME AS CK_CONSTRAINT_NAME, ck.SEARCH_CONDITION,
    {_TAIL}
  FROM all_tab_columns a {_COMMON_JOINS}
  {_kind("pk", "P")} {_kind("fk", "R")} {_kind("uk", "U")}
  {_kind("ck", "C", "AND CONSTRAINT_NAME NOT LIKE 'SYS_%'")}"""

_EXTRACT_SIMPLE = f"""
  SELECT {_BASE}, 'N' AS IS_PRIMARY_KEY, '' AS PK_CONSTRAINT_NAME, {_BLANK_CONSTRAINTS}, {_TAIL}
  FROM all_tab_columns a {_COMMON_JOINS}"""


def _extract_keys(owner: str, where: str) -> str:
    return f"""
  SELECT {_BASE.replace("a.OWNER", owner)}, CASE WHEN pk.CONSTRAINT_TYPE = 'P' THEN 'Y' ELSE 'N' END AS IS_PRIMARY_KEY,
    pk.CONSTRAINT_NAME AS PK_CONSTRAINT_NAME, {_BLANK_CONSTRAINTS}, {_TAIL}
  FROM all_tab_columns a {_COMMON_JOINS} {_kind("pk", "P")} {where}"""


_TABLES_OF_TWO = f"""WITH {DICTIONARY} {_extract_keys("a.OWNER", "WHERE a.TABLE_NAME LIKE 'T1%' AND a.OWNER IN ('SCHEMA1', 'SCHEMA3')")}"""

# The extract as catalog records, one row per column: the smallest row by position and then by
# every other field.
EXTRACTED = f"""{DICTIONARY},
extracted AS ({_EXTRACT_FULL}),
records AS (
  SELECT OWNER AS schema_name, TABLE_NAME AS table_name, COLUMN_NAME AS column_name, DATA_TYPE AS data_type,
    coalesce(CAST(DATA_PRECISION AS VARCHAR), '') AS data_precision,
    coalesce(CAST(DATA_SCALE AS VARCHAR), '') AS data_scale,
    CAST(DATA_LENGTH AS VARCHAR) AS char_length, CAST(DATA_LENGTH AS VARCHAR) AS data_length,
    NULLABLE AS nullable, IS_PRIMARY_KEY AS is_primary_key,
    coalesce(FK_CONSTRAINT_NAME, '') AS fk_constraint_name, coalesce(UK_CONSTRAINT_NAME, '') AS unique_constraint_name,
    '' AS default_value, '' AS data_default, coalesce(COLUMN_COMMENT, '') AS column_comment,
    PARTITION_YN AS partition_yn, CLUSTER_YN AS cluster_yn, CAST(COLUMN_ID AS BIGINT) AS column_id
  FROM extracted),
{_folded("records", EXTRACT_ORDER)},
cat AS (SELECT * FROM folded)"""

# --- audits of table data ----------------------------------------------------------------------------


# A value as a number with 20 digits before the point and 18 after it, read from its text.
def _exact(column: str) -> str:
    return f"TRY_CAST(CAST({column} AS VARCHAR) AS DECIMAL(38,18))"


def _number_fit(column: str, cast: str, places: int, work: str = "DECIMAL(38,18)") -> tuple[str, str]:
    exact = _exact(column)
    rounded = f"round({exact}, {places})"
    misfit = f"{column} IS NOT NULL AND TRY_CAST({rounded} AS {cast}) IS NULL"
    lost = f"TRY_CAST({rounded} AS {cast}) IS NOT NULL AND TRY_CAST({rounded} AS {work}) <> {exact}"
    return misfit, lost


LINEITEM_TYPES = {
    "l_orderkey": ("INT64", _number_fit("l_orderkey", "BIGINT", 0)),
    "l_partkey": ("INT64", _number_fit("l_partkey", "BIGINT", 0)),
    "l_suppkey": ("NUMERIC(25, 0)", _number_fit("l_suppkey", "DECIMAL(25,0)", 0)),
    "l_linenumber": ("INT64", _number_fit("l_linenumber", "BIGINT", 0)),
    "l_quantity": ("NUMERIC(15, 2)", _number_fit("l_quantity", "DECIMAL(15,2)", 2)),
    "l_extendedprice": ("NUMERIC(6, 2)", _number_fit("l_extendedprice", "DECIMAL(6,2)", 2)),
    "l_discount": ("NUMERIC(3, 1)", _number_fit("l_discount", "DECIMAL(3,1)", 1)),
    "l_tax": ("NUMERIC", _number_fit("l_tax", "DECIMAL(38,9)", 9)),
    "l_returnflag": ("STRING", ("false", "false")),
    "l_linestatus": ("STRING", ("false", "false")),
    "l_shipdate": ("DATETIME", ("false", "false")),
}
DOCUMENT_TYPES = {
    "doc_id": ("INT64", _number_fit("doc_id", "BIGINT", 0)),
    "text": ("STRING", ("false", "false")),
    "lang": ("STRING", ("false", "false")),
    "source": ("STRING", ("false", "false")),
    "n_chars": ("NUMERIC(4, -2)", _number_fit("n_chars", "DECIMAL(6,0)", -2)),
}


def _fit_audit(table: str, columns: dict) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS column_name, '{target}' AS target_type, count(*) AS rows,
  count(*) - count({name}) AS nulls, count(*) FILTER ({misfit}) AS misfits, count(*) FILTER ({lost}) AS rounded
FROM {table}"""
        for name, (target, (misfit, lost)) in columns.items()
    )


_LABELLED = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"
_ORDERS_WITH_LINES = "(SELECT * FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)"

_REASONS = ", ".join(
    [
        "CASE WHEN l_orderkey IS NULL THEN 'l_orderkey: null' END",
        f"CASE WHEN {LINEITEM_TYPES['l_orderkey'][1][0]} THEN 'l_orderkey: does not fit INT64' END",
        f"CASE WHEN {LINEITEM_TYPES['l_extendedprice'][1][0]} THEN 'l_extendedprice: does not fit NUMERIC(6, 2)' END",
        f"CASE WHEN {LINEITEM_TYPES['l_discount'][1][0]} THEN 'l_discount: does not fit NUMERIC(3, 1)' END",
        "CASE WHEN length(l_returnflag) > 1 THEN 'l_returnflag: longer than 1' END",
        "CASE WHEN length(l_linestatus) > 10 THEN 'l_linestatus: longer than 10' END",
    ]
)


def _convert(column: str, cast: str, places: int) -> str:
    return f"TRY_CAST(round({_exact(column)}, {places}) AS {cast}) AS {column}"


# Values of 12 digits behind the point that lie just below a tie, as text, decimal and double.
FINE_LINES = """(SELECT l_orderkey, l_linenumber, fine AS as_text, CAST(fine AS DECIMAL(38,18)) AS as_decimal,
    CAST(fine AS DOUBLE) AS as_double, CAST(fine AS DECIMAL(38,18)) AS to_cents, fine AS to_hundreds
  FROM (SELECT *, CAST(l_linenumber AS VARCHAR) || '.4999999' || lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0') AS fine
    FROM lineitem))"""
FINE_TYPES = {
    "as_text": ("INT64", _number_fit("as_text", "BIGINT", 0)),
    "as_decimal": ("INT64", _number_fit("as_decimal", "BIGINT", 0)),
    "as_double": ("INT64", _number_fit("as_double", "BIGINT", 0)),
    "to_cents": ("NUMERIC(10, 2)", _number_fit("to_cents", "DECIMAL(10,2)", 2)),
    "to_hundreds": ("NUMERIC(4, -2)", _number_fit("to_hundreds", "DECIMAL(6,0)", -2)),
}
# Fractions down to the 15th place.
SMALL_LINES = """(SELECT CAST('0.0000000000' || lpad(CAST(l_linenumber AS VARCHAR), 5, '0') AS DECIMAL(38,18)) AS as_decimal,
    '0.0000000000' || lpad(CAST(l_linenumber AS VARCHAR), 5, '0') || '00' AS as_text,
    CAST('0.0000000000' || lpad(CAST(l_linenumber AS VARCHAR), 5, '0') AS DOUBLE) AS as_double,
    l_extendedprice AS price
  FROM lineitem)"""


def _length(column: str, declared: int) -> str:
    return f"""SELECT '{column}' AS column_name, CAST({declared} AS BIGINT) AS declared_length,
  max(length({column})) AS max_chars, max(strlen({column})) AS max_bytes,
  count(*) FILTER (length({column}) > {declared}) AS rows_over
FROM documents"""


def _not_null(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) AS rows, count(*) - count({column}) AS nulls
FROM {_LABELLED}"""


CHECK_SQL = {
    "small_discount": "l_discount BETWEEN 0 AND 0.05",
    "shipped_after_1998": "l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'",
    "later_lines": "nullif(l_linenumber, 1) > 2",
}


def _check(name: str, condition: str) -> str:
    return f"""SELECT '{name}' AS check_name, count(*) AS rows, count(*) FILTER (NOT ({condition})) AS violations,
  count(*) FILTER (({condition}) IS NULL) AS unknown FROM lineitem"""


def _duplicates(table: str, keys: str) -> str:
    return f"SELECT {keys}, count(*) AS rows FROM {table} GROUP BY {keys} HAVING count(*) > 1"


def _violations(check: str, subject: str, rows: str) -> str:
    return f"""SELECT '{check}' AS "check", '{subject}' AS subject, CAST(({rows}) AS BIGINT) AS violations"""


def _lines(condition: str) -> str:
    return f"SELECT count(*) FROM lineitem WHERE {condition}"


def _report() -> str:
    rows = []
    for name, (_, (misfit, lost)) in LINEITEM_TYPES.items():
        rows.append(_violations("type", name, _lines(misfit)))
        rows.append(_violations("rounding", name, _lines(lost)))
    for name in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"):
        rows.append(_violations("not null", name, _lines(f"{name} IS NULL")))
    rows.append(_violations("length", "l_returnflag", _lines("length(l_returnflag) > 1")))
    rows.append(_violations("length", "l_linestatus", _lines("length(l_linestatus) > 10")))
    for name, condition in CHECK_SQL.items():
        rows.append(_violations("check", name, _lines(f"NOT ({condition})")))
    for check, subject, keys in (
        ("primary key", "l_orderkey, l_linenumber", "l_orderkey, l_linenumber"),
        ("unique", "part and supplier", "l_partkey, l_suppkey"),
    ):
        broken = _duplicates("lineitem", keys)
        rows.append(_violations(check, subject, f"SELECT coalesce(sum(rows), 0) FROM ({broken})"))
    rows.append(
        _violations("foreign key", "orders", _lines("l_orderkey NOT IN (SELECT o_orderkey FROM orders)"))
    )
    rows.append(
        _violations("foreign key", "labels", _lines("l_orderkey NOT IN (SELECT doc_id FROM labels)"))
    )
    rows.append(_violations("foreign key", "parts", _lines("l_partkey NOT IN (SELECT p_partkey FROM part)")))
    return "\nUNION ALL\n".join(rows)


def _catalog_report() -> str:
    numbers = {"l_orderkey": ("BIGINT", 0), "l_linenumber": ("BIGINT", 0), "l_partkey": ("BIGINT", 0),
               "l_suppkey": ("BIGINT", 0), "l_extendedprice": ("DECIMAL(6,2)", 2), "l_discount": ("DECIMAL(3,1)", 1)}
    rows = []
    for name, (cast, places) in numbers.items():
        misfit, lost = _number_fit(name, cast, places)
        rows += [_violations("type", name, _lines(misfit)), _violations("rounding", name, _lines(lost))]
    rows += [_violations(check, "l_returnflag", _lines("false")) for check in ("type", "rounding")]
    for name in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"):
        rows.append(_violations("not null", name, _lines(f"{name} IS NULL")))
    rows.append(_violations("length", "l_returnflag", _lines("length(l_returnflag) > 1")))
    rows.append(_violations("check", "CK_SMALL", _lines("l_discount > 0.05")))
    rows.append(_violations("check", "CK_SIGN", _lines("l_discount <= 0")))
    for check, subject, keys in (
        ("primary key", "l_orderkey, l_linenumber", "l_orderkey, l_linenumber"),
        ("unique", "UK_OFFER", "l_partkey, l_suppkey"),
    ):
        rows.append(_violations(check, subject, f"SELECT coalesce(sum(rows), 0) FROM ({_duplicates('lineitem', keys)})"))
    for subject, parent in (("FK_ORDER", "SELECT o_orderkey FROM orders"), ("FK_LABEL", "SELECT doc_id FROM labels")):
        rows.append(_violations("foreign key", subject, _lines(f"l_orderkey NOT IN ({parent})")))
    return "\nUNION ALL\n".join(rows)


def _profile(column: str, table: str = "lineitem") -> str:
    number = f"CAST(abs({_exact(column)}) AS VARCHAR)"
    return f"""SELECT '{column}' AS column_name,
  max(length(ltrim(split_part({number}, '.', 1), '0'))) AS whole,
  max(length(rtrim(split_part({number}, '.', 2), '0'))) AS scale,
  count(*) FILTER ({column} IS NOT NULL AND {number} IS NULL) AS unreadable
FROM {table}"""


def _profiles(parts: list[str]) -> str:
    return f"""WITH needs AS ({" UNION ALL ".join(parts)}),
sized AS (SELECT column_name, greatest(whole + scale, 1) AS precision, scale, unreadable FROM needs)
SELECT *, CASE WHEN scale = 0 AND precision <= 18 THEN 'INT64' WHEN scale = 0 AND precision > 29 THEN 'BIGNUMERIC'
               WHEN scale > 9 THEN 'BIGNUMERIC' ELSE 'NUMERIC' END AS target_type,
  CASE WHEN scale = 0 AND precision <= 18 THEN 'INT64'
       WHEN scale > 9 OR scale = 0 AND precision > 29 THEN 'BIGNUMERIC(' || precision || ', ' || scale || ')'
       ELSE 'NUMERIC(' || precision || ', ' || scale || ')' END AS type_text
FROM sized"""


_PROFILE_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _day_profile(table: str, ts: str) -> str:
    return f"""SELECT CAST({ts} AS DATE) AS day, count(*) AS rows, min({ts}) AS first_at, max({ts}) AS last_at,
  CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM {table}) AS DOUBLE) AS share
FROM {table} GROUP BY 1"""


def _candidate(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(day) AS days,
  coalesce(min(rows) FILTER (day IS NOT NULL), 0) AS min_rows_per_day,
  coalesce(max(rows) FILTER (day IS NOT NULL), 0) AS max_rows_per_day,
  CAST(coalesce(sum(rows) FILTER (day IS NULL), 0) AS BIGINT) AS null_rows
FROM (SELECT CAST({column} AS DATE) AS day, count(*) AS rows FROM {_ORDERS_WITH_LINES} GROUP BY 1)"""


def _distinct_values(column: str) -> str:
    return f"SELECT '{column}' AS column_name, count(DISTINCT {column}) AS distinct_values FROM lineitem"


def _lines_of(text: str, keys: str = "") -> str:
    return f"SELECT {keys} unnest(string_split({text}, chr(10))) AS value"


_UNLABELLED = """SELECT d.doc_id, count(*) AS orphan_rows FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1"""

SQL: dict[str, str] = {
    "fit_audit": _fit_audit("lineitem", LINEITEM_TYPES),
    "fit_audit_fine_digits": _fit_audit(FINE_LINES, FINE_TYPES),
    "convert_fine_digits": f"""SELECT l_orderkey, l_linenumber, {_convert("as_text", "BIGINT", 0)},
  {_convert("as_decimal", "BIGINT", 0)}, {_convert("as_double", "BIGINT", 0)}, {_convert("to_cents", "DECIMAL(10,2)", 2)},
  {_convert("to_hundreds", "DECIMAL(6,0)", -2)} FROM {FINE_LINES}""",
    "fit_audit_documents": _fit_audit("documents", DOCUMENT_TYPES),
    "convert_orders": f"""SELECT o_orderkey, {_convert("o_custkey", "DECIMAL(38,9)", 9)},
  o_orderstatus, {_convert("o_totalprice", "DECIMAL(7,1)", 1)}, o_orderdate, o_orderpriority FROM orders""",
    "length_audit": "\nUNION ALL\n".join([_length("text", 4000), _length("lang", 2), _length("source", 4)]),
    "not_null_audit": "\nUNION ALL\n".join(map(_not_null, ["doc_id", "quality", "toxic"])),
    "pk_audit": f"""SELECT *, 'duplicate key' AS reason
FROM ({_duplicates("lineitem", "l_orderkey, l_linenumber")})""",
    "pk_null_audit": f"""SELECT n_chars, toxic, count(*) AS rows,
  CASE WHEN toxic IS NULL THEN 'null key' ELSE 'duplicate key' END AS reason
FROM {_LABELLED} GROUP BY ALL HAVING count(*) > 1 OR toxic IS NULL""",
    "unique_audit": _duplicates("lineitem", "l_partkey, l_suppkey"),
    "unique_null_audit": _duplicates(
        f"(SELECT * FROM {_LABELLED} WHERE toxic IS NOT NULL)", "n_chars, toxic"
    ),
    "fk_audit": _UNLABELLED,
    "fk_audit_bitmap": _UNLABELLED,
    "fk_audit_clean": """SELECT l_orderkey, count(*) AS orphan_rows FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey) GROUP BY 1""",
    "check_audit": "\nUNION ALL\n".join(_check(*item) for item in CHECK_SQL.items()),
    "quarantine": f"""SELECT * FROM (SELECT *, concat_ws('; ', {_REASONS}) AS reasons FROM lineitem)
WHERE reasons <> ''""",
    "quarantine_loadable": f"""SELECT l_orderkey, l_partkey, CAST(l_suppkey AS DECIMAL(25,0)) AS l_suppkey,
  CAST(l_linenumber AS BIGINT) AS l_linenumber, {_convert("l_quantity", "DECIMAL(15,2)", 2)},
  {_convert("l_extendedprice", "DECIMAL(6,2)", 2)}, {_convert("l_discount", "DECIMAL(3,1)", 1)},
  {_convert("l_tax", "DECIMAL(38,9)", 9)}, l_returnflag, l_linestatus, l_shipdate
FROM lineitem WHERE concat_ws('; ', {_REASONS}) = ''""",
    "migration_report": _report(),
    "catalog_to_report": _catalog_report(),
    "clean_text": f"""SELECT doc_id, {_clean("text")} AS text, lang, source, n_chars, {_clean("text")} <> text AS changed
FROM documents""",
    "number_profile": _profiles([_profile(c) for c in _PROFILE_COLUMNS]),
    "number_profile_small": _profiles([_profile(c, SMALL_LINES) for c in ("as_decimal", "as_text", "as_double", "price")]),
    "day_profile": _day_profile("events", "ts"),
    "day_profile_kept": _day_profile("events", "ts"),
    "rank_kept_keys": """SELECT column_name FROM (
  SELECT 'event_id' AS column_name, count(DISTINCT event_id) AS n FROM days
  UNION ALL SELECT 'user_id', count(DISTINCT user_id) FROM days
  UNION ALL SELECT 'event_type', count(DISTINCT event_type) FROM days)
ORDER BY n DESC, column_name LIMIT 2""".replace(
        "FROM days", "FROM events WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'"
    ),
    "day_profile_lineitem": _day_profile("lineitem", "l_shipdate"),
    "partition_candidates": f"""SELECT *, row_number() OVER (ORDER BY null_rows, days DESC, column_name) AS rank
FROM ({" UNION ALL ".join(map(_candidate, ["l_shipdate", "o_orderdate"]))})""",
    "rank_cluster_keys": f"""SELECT * FROM ({" UNION ALL ".join(map(
        _distinct_values, ["l_partkey", "l_suppkey", "l_orderkey", "l_returnflag", "l_linestatus"]))})
ORDER BY distinct_values DESC, column_name LIMIT 4""",
    "rank_cluster_keys_approx": f"""SELECT column_name FROM (SELECT * FROM ({" UNION ALL ".join(map(
        _distinct_values, ["l_partkey", "l_suppkey", "l_orderkey", "l_returnflag", "l_linestatus"]))})
ORDER BY distinct_values DESC, column_name LIMIT 4)""",
    "migrate_replace_days": """WITH loadable AS (SELECT * FROM events WHERE length(event_type) <= 6
  AND (value IS NULL OR abs(round(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,18)), 2)) < 100))
SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS day FROM loadable WHERE ts < TIMESTAMP '2024-01-16'
   OR CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM loadable WHERE event_type = 'click'
                               AND ts >= TIMESTAMP '2024-01-16')
UNION ALL
SELECT event_id, ts, -user_id AS user_id, event_type, CAST(ts AS DATE) AS day FROM loadable
WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-16'""",
    "write_by_day": "SELECT *, CAST(ts AS DATE) AS day FROM events",
    "replace_days": """SELECT *, CAST(ts AS DATE) AS day FROM events WHERE ts < TIMESTAMP '2024-01-16'
   OR CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'click'
                               AND ts >= TIMESTAMP '2024-01-16')
UNION ALL
SELECT * REPLACE (value + 1000 AS value), CAST(ts AS DATE) AS day FROM events
WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-16'""",
    "read_days": """SELECT *, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-14'""",
    "save_table": "SELECT * FROM events WHERE event_type <> 'view'",
    "cluster_layout": "SELECT *, CAST(ts AS DATE) AS day FROM events",
    "migrate_events": f"""SELECT event_id, ts, user_id, event_type, props, reasons,
  CAST(value AS DECIMAL(12,2)) AS value, CASE WHEN reasons = '' THEN CAST(ts AS DATE) END AS day
FROM (SELECT *, concat_ws('; ',
    CASE WHEN length(event_type) > 6 THEN 'event_type: longer than 6' END,
    CASE WHEN {_number_fit("value", "DECIMAL(4,2)", 2)[0]} THEN 'value: does not fit NUMERIC(4, 2)' END) AS reasons
  FROM events)""",
    "expire_days": "SELECT * FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 10",
    "expired_days": """SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events
WHERE CAST(ts AS DATE) < DATE '2024-01-31' - 10 GROUP BY 1""",
    "csv_intake": f"WITH {NARROW} SELECT {RECORD}, column_id FROM cat",
    "csv_gaps": f"""WITH {NARROW} SELECT schema_name, table_name, column_name, data_type, '' AS data_precision,
  '' AS data_scale, '' AS char_length, '' AS data_length, 'Y' AS nullable, 'N' AS is_primary_key,
  '' AS fk_constraint_name, '' AS unique_constraint_name, '' AS default_value, '' AS data_default,
  '' AS column_comment, 'N' AS partition_yn, 'N' AS cluster_yn, column_id
FROM cat WHERE data_precision <> ''""",
    "csv_korean": f"WITH {NARROW} SELECT {RECORD}, column_id FROM cat",
    "catalog_records": f"WITH {NARROW} SELECT {RECORD}, column_id FROM cat",
    "partitioned_tables": """SELECT 'SCHEMA' || (o_orderkey % 5) AS OWNER, 'T' || o_orderkey AS TABLE_NAME,
  CASE WHEN o_orderstatus = 'O' THEN 'HASH' WHEN o_orderpriority = '1-URGENT' THEN 'LIST' ELSE 'RANGE' END
    AS PARTITIONING_TYPE,
  o_custkey % 10 + 1 AS PARTITION_COUNT
FROM orders""",
    "csv_blank_ids": f"""WITH described AS (
  SELECT *, CASE WHEN l_partkey % 3 <> 0 THEN l_linenumber END AS given,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
      l_tax, l_returnflag, l_linestatus, l_shipdate) AS line
  FROM lineitem),
cat AS (
  SELECT 'SCHEMA' || (l_orderkey % 5) AS schema_name, 'T' || l_orderkey AS table_name,
    'C' || l_linenumber AS column_name,
    CAST(coalesce(given, coalesce(max(given) OVER (PARTITION BY l_orderkey), 0)
      + row_number() OVER (PARTITION BY l_orderkey, given IS NULL ORDER BY line)) AS BIGINT) AS column_id, {_DESCRIBED}
  FROM described)
SELECT {RECORD}, column_id FROM cat""",
    "expire_stored": """SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS day
FROM (SELECT * REPLACE (CASE WHEN user_id % 7 <> 0 THEN ts END AS ts) FROM events)
WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-21 00:00:00'""",
    "partition_keys": f"""WITH {DICTIONARY}
SELECT OWNER, NAME AS TABLE_NAME, COLUMN_NAME, COLUMN_POSITION FROM all_part_key_columns WHERE OBJECT_TYPE = 'TABLE'""",
    "extract_full": f"WITH {DICTIONARY} {_EXTRACT_FULL}",
    "extract_simple": f"WITH {DICTIONARY} {_EXTRACT_SIMPLE}",
    "extract_user": f"WITH {DICTIONARY} {_extract_keys(chr(39) + 'MIGRATOR' + chr(39) + ' AS OWNER', '')}",
    "extract_tables": _TABLES_OF_TWO,
    "extract_snapshots": _TABLES_OF_TWO,
    "extract_named_tables": f"""WITH {DICTIONARY} {_EXTRACT_SIMPLE}
  WHERE a.TABLE_NAME IN ('T1', 'T2', 'T33', 'T100')""",
    "type_map": f"WITH {NARROW}, {typed()} SELECT {RECORD}, column_id, target_type, type_text, spark_type FROM typed",
    "type_map_lengths": f"""WITH {NARROW}, {typed(keep_length=True)}
SELECT schema_name, table_name, column_name, char_length, target_type, type_text FROM typed""",
    "type_census": f"""WITH {NARROW}, {typed()}
SELECT schema_name, target_type, count(*) AS columns,
  count(*) FILTER (upper(data_type) LIKE 'TIMESTAMP%TIME ZONE%') AS zones_dropped,
  count(*) FILTER (base = 'NUMBER' AND spark_type = 'string') AS numbers_kept_as_text
FROM typed GROUP BY ALL""",
    "tables_per_schema": f"""WITH {NARROW}
SELECT schema_name, count(DISTINCT table_name) AS tables, count(*) AS columns FROM cat GROUP BY ALL""",
    "table_count": f"WITH {NARROW} SELECT count(DISTINCT (schema_name, table_name)) AS tables FROM cat",
    "schemas": f"WITH {NARROW} SELECT DISTINCT schema_name FROM cat WHERE schema_name <> '' ORDER BY 1",
    "catalog_dedupe": f"""WITH {NARROW}, {_folded("cat", RECORD_ORDER)}
SELECT {RECORD}, column_id FROM folded""",
    "fanout_report": f"""WITH {NARROW}
SELECT schema_name, table_name, column_name, count(*) AS copies,
  count(DISTINCT (fk_constraint_name, unique_constraint_name)) AS variants,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(
    list(DISTINCT fk_constraint_name) FILTER (fk_constraint_name <> ''),
    list(DISTINCT unique_constraint_name) FILTER (unique_constraint_name <> '')))), ','), '') AS constraint_names
FROM cat GROUP BY ALL HAVING count(*) > 1""",
    "column_definitions": f"""WITH {NARROW}, {typed()}
SELECT schema_name, table_name, column_id, column_name, {_DEFINITION} AS definition FROM typed""",
    "qualified_tables": f"""WITH {NARROW}
SELECT DISTINCT schema_name, table_name, '`your_project.' || schema_name || '.' || table_name || '`' AS full_name
FROM cat""",
    "grouped_columns": f"""WITH {WIDE}, {typed()}
SELECT schema_name, table_name, count(*) AS n_columns,
  string_agg(column_name || ' ' || type_text || ' ' || nullable, ', ' ORDER BY column_id, column_name) AS column_list
FROM typed GROUP BY ALL""",
    "partition_flags": f"""WITH {NARROW}
SELECT schema_name, table_name, bool_or(upper(partition_yn) = 'Y') AS has_partition FROM cat GROUP BY ALL""",
    "partition_clause": f"WITH {WIDE}, {typed()}, {_FIRST_PARTITION} SELECT * FROM first_partition",
    "cluster_clause": f"WITH {WIDE}, {_clusters(None)} SELECT * FROM clusters",
    "cluster_clause_top4": f"WITH {WIDE}, {_clusters(4)} SELECT * FROM clusters",
    "pk_columns": f"WITH {WIDE}, {_KEYS} SELECT * FROM keys",
    "identifier_audit": f"""WITH {WIDE}
SELECT schema_name, count(*) AS names, count(*) FILTER ({_needs_quotes("column_name")}) AS need_quotes,
  count(*) FILTER (regexp_matches(column_name, '[가-힣]')) AS hangul,
  count(*) FILTER (regexp_matches(column_name, '\\A[0-9]')) AS leading_digit,
  count(*) FILTER (regexp_matches(column_name, '[^A-Za-z0-9_]')) AS other_characters,
  count(*) FILTER (upper(column_name) IN ({_quoted(RESERVED_WORDS)})) AS reserved
FROM cat GROUP BY ALL""",
    "limit_audit": f"""WITH {WIDE}, {typed()}, {_FIRST_PARTITION},
counted AS (
  SELECT schema_name, table_name, count(*) FILTER (upper(is_primary_key) = 'Y') AS key_columns,
    count(*) FILTER (upper(cluster_yn) = 'Y') AS cluster_columns,
    count(*) FILTER (upper(partition_yn) = 'Y') AS partition_flags
  FROM typed GROUP BY ALL)
SELECT c.*, coalesce(f.target_type <> 'DATETIME', false) AS unsupported_partition
FROM counted c LEFT JOIN first_partition f ON c.schema_name = f.schema_name AND c.table_name = f.table_name
WHERE key_columns > {MAX_KEY_COLUMNS} OR cluster_columns > {MAX_CLUSTER_COLUMNS} OR partition_flags > 1
   OR coalesce(f.target_type <> 'DATETIME', false)""",
    "ddl_per_table": f"WITH {ddl(WIDE)} {_DDL_ROWS}",
    "ddl_replace_options": f"""WITH {ddl(
        WIDE, full_name="'`' || schema_name || '.' || table_name || '`'", replace=True, cluster_limit=4, expiry=90)}
{_DDL_ROWS}""",
    "merged_ddl": f"""WITH {ddl(WIDE)},
texts AS (
  SELECT '-- Table definitions' || chr(10) || '-- Generated on: 2026-01-02 03:04:05' || chr(10)
    || '-- Total tables: ' || count(*) || chr(10) AS text FROM ddl
  UNION ALL
  SELECT '{RULE}' || chr(10) || '-- Table: ' || table_name || chr(10) || '-- Schema: ' || schema_name || chr(10)
    || '{RULE}' || chr(10) || chr(10) || ddl || chr(10) FROM ddl)
{_lines_of("text")} FROM texts""",
    "ddl_files": f"""WITH {ddl(WIDE)} {_lines_of("ddl", "schema_name, table_name,")} FROM ddl""",
    "ddl_lines_huge_tables": f"WITH {ddl(HUGE)} {_lines_of('ddl', 'schema_name, table_name,')} FROM ddl",
    "csv_to_ddl": f"WITH {ddl(WIDE)} {_DDL_ROWS}",
    "catalog_to_ddl": f"WITH {ddl(EXTRACTED, keep_length=True)} {_DDL_ROWS}",
}
