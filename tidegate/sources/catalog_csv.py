"""Catalog CSV intake: encoding choice, split reading, header aliases, defaults and column positions.

A CSV file can be cut at line breaks only where they are outside quotes. One raw scan judges every file by its
lines. A ``plain`` file, all of whose lines are whole records, is read by Spark's CSV source in splits. In a
``quoted`` file some fields hold line breaks: whether a line begins inside quotes follows from the number of
quotes before it, as sums over blocks of the file and over lines of a block; the lines of a record are then put
together and parsed. Files that break the rules of quoting (``odd``) are left to the multi-line reader, one task
each, whose rows are the same in all three cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.functions.text import first_text
from tidegate.functions.types import parse_int
from tidegate.operators.positions import dense_positions
from tidegate.session import shared_dir

# Headers that feed each field, in order of preference.
HEADERS = {
    "schema_name": ("OWNER", "SCHEMA_NAME", "TABLE_SCHEMA"),
    "table_name": ("TABLE_NAME",),
    "column_name": ("COLUMN_NAME",),
    "data_type": ("DATA_TYPE",),
    "data_precision": ("DATA_PRECISION",),
    "data_scale": ("DATA_SCALE",),
    "char_length": ("CHAR_LENGTH", "DATA_LENGTH"),
    "data_length": ("DATA_LENGTH",),
    "nullable": ("NULLABLE",),
    "is_primary_key": ("IS_PRIMARY_KEY",),
    "fk_constraint_name": ("FK_CONSTRAINT_NAME",),
    "unique_constraint_name": ("UNIQUE_CONSTRAINT_NAME", "UK_CONSTRAINT_NAME"),
    "default_value": ("DEFAULT_VALUE", "DATA_DEFAULT"),
    "data_default": ("DATA_DEFAULT",),
    "column_comment": ("COLUMN_COMMENT", "COMMENTS"),
    "partition_yn": ("PARTITION_YN",),
    "cluster_yn": ("CLUSTER_YN",),
}
# What a field holds when none of its headers exists; the others hold ''.
DEFAULTS = {"nullable": "Y", "is_primary_key": "N", "partition_yn": "N", "cluster_yn": "N"}
# Encodings tried for a file, as Java names. The second covers the older Korean sets.
UTF8, KOREAN = "UTF-8", "x-windows-949"

RECORD_FIELDS = tuple(HEADERS)


# How bytes of the older Korean sets follow each other; accented Western letters break it.
_KOREAN_BYTES = r"\A(?:[\x00-\x7F]|[\x81-\xC6][\x41-\x5A\x61-\x7A\x81-\xFE]|[\x81-\xFE][\xA1-\xFE])*+\z"

PLAIN, QUOTED, ODD = "plain", "quoted", "odd"
#: Where a row comes from: file, block of the file, and an order within the block.
SOURCE = ["_file", "_block", "_row"]
_ORDER_BITS = 12


def _well_formed(breaks: str) -> str:
    """A pattern for records whose quotes open and close at the ends of fields; ``breaks`` may be inside quotes only."""
    field = rf'(?:"(?:[^"{breaks}]++|"")*+"|[^",\r\n][^,\r\n]*+|)'
    return rf"\A{field}(?:,{field})*+\z"


_BLANK = r"\A[\x00-\x20]+\z"


def _raw_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Lines as their bytes, one character per byte, without the line feed; large files are split over tasks."""
    bytes_ = F.col("value").cast("binary")
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.is_valid_utf8("value").alias("valid"),
        F.decode(bytes_, "ISO-8859-1").alias("line"),
    )


def judged_files(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """One row per file: path, encoding (NULL for bytes of neither), size, and ``plain``: whether any line may end a split.

    One flag per file and task is all that is shuffled.
    """
    ends = F.col("line").endswith("\r")
    body = F.when(ends, F.col("line").substr(F.lit(1), F.length("line") - 1)).otherwise(F.col("line"))
    lines = _raw_lines(spark, paths).select("*", ends.alias("ends"), body.alias("body"))
    simple = ~F.col("body").contains('"') & ~F.col("body").contains("\r")
    whole = (simple | F.col("body").rlike(_well_formed(r"\r"))) & ~F.col("body").rlike(_BLANK)
    korean = F.when(F.bool_and(F.col("line").rlike(_KOREAN_BYTES)), KOREAN)
    return lines.groupBy("path").agg(
        F.max("size").alias("size"),
        F.when(F.bool_and("valid"), UTF8).otherwise(korean).alias("encoding"),
        (F.bool_and(whole) & (F.bool_and("ends") | ~F.bool_or("ends"))).alias("plain"),
    )


def file_encodings(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """One row per file: path and encoding, judged on the whole file; NULL for bytes of neither."""
    return judged_files(spark, paths).select("path", "encoding")


def quoted_records(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """``path, block, row, text, ends``: the records of files with line breaks in quotes, from split scans.

    Block and row are those of a record's first line. ``ends`` tells whether the record ends with a carriage
    return, which is not part of ``text``; the text has one character per byte. Sums run within a block of a
    file, and over the blocks of a file.
    """
    lines = _raw_lines(spark, paths).drop("valid", "size").withColumn("at", F.monotonically_increasing_id())
    lines = lines.withColumn("quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))))
    place = Window.partitionBy("path", "block").orderBy("at")
    behind = place.rowsBetween(Window.unboundedPreceding, -1)
    numbered = lines.select(
        "path",
        "block",
        "line",
        "quotes",
        F.row_number().over(place).cast("long").alias("row"),
        F.coalesce(F.sum("quotes").over(behind), F.lit(0)).alias("before"),
    )
    blocks = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = lines.groupBy("path", "block").agg(F.sum("quotes").alias("quotes"))
    sums = sums.select("path", "block", F.coalesce(F.sum("quotes").over(blocks), F.lit(0)).alias("open"))
    known = numbered.join(sums, ["path", "block"])
    known = known.withColumn("starts", (F.col("open") + F.col("before")) % 2 == 0)
    start = F.when(F.col("starts"), F.struct("block", "row"))
    upto = Window.partitionBy("path", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = known.select("path", "block", "row", "line", F.last(start, ignorenulls=True).over(upto).alias("own"))
    lasts = known.groupBy("path", "block").agg(F.max(start).alias("last"))
    lasts = lasts.select("path", "block", F.last("last", ignorenulls=True).over(blocks).alias("carried"))
    placed = own.join(lasts, ["path", "block"]).withColumn("record", F.coalesce("own", "carried"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "row", "line")))
    whole = placed.groupBy("path", "record").agg(pieces.alias("pieces"))
    text = F.array_join(F.col("pieces.line"), "\n")
    found = whole.select("path", "record.block", "record.row", text.alias("text"))
    ends = F.col("text").endswith("\r")
    # As in the multi-line reader, breaks inside fields are line feeds in files whose lines end with both characters.
    body = F.replace(F.col("text").substr(F.lit(1), F.length("text") - 1), F.lit("\r\n"), F.lit("\n"))
    body = F.when(ends, body).otherwise(F.col("text"))
    return found.select("path", "block", "row", body.alias("text"), ends.alias("ends"))


def well_formed_files(records: DataFrame) -> DataFrame:
    """Of ``quoted_records`` the paths whose records all keep the rules of quoting, with one kind of line end."""
    ok = F.col("text").rlike(_well_formed(""))
    return (
        records.groupBy("path")
        .agg((F.bool_and(ok) & (F.bool_and("ends") | ~F.bool_or("ends"))).alias("ok"))
        .filter("ok")
        .select("path")
    )


def need_java_charsets(spark: SparkSession) -> None:
    """Encodings other than UTF-8 need a setting that ``session.build_session`` makes."""
    if spark.conf.get("spark.sql.legacy.javaCharsets", "false").lower() != "true":
        raise ValueError("set spark.sql.legacy.javaCharsets to true for files that are not UTF-8")


def _csv_options(encoding: str, multi_line: bool) -> dict[str, object]:
    return {
        "header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "encoding": encoding, "enforceSchema": False,
    }


def read_csv_text(
    spark: SparkSession,
    paths: Sequence[str] | str,
    encoding: str = UTF8,
    multi_line: bool = True,
    source: bool = False,
) -> DataFrame:
    """CSV files that share one header, every field a string, blanks as ''.

    ``multi_line=False`` lets Spark split a huge file whose fields hold no line breaks. ``source`` adds the
    columns of ``SOURCE``, which order the rows of a file alike however it is split.
    """
    if encoding.upper() != UTF8:
        need_java_charsets(spark)
    frame = spark.read.options(**_csv_options(encoding, multi_line)).csv(paths)
    fields = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in frame.columns]
    if not source:
        return frame.select(*fields)
    origin = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return frame.select(*fields, *[value.alias(name) for value, name in zip(origin, SOURCE, strict=True)])


def parse_records(records: DataFrame, paths: Sequence[str], encoding: str = UTF8) -> DataFrame:
    """The rows of ``read_csv_text`` with ``source``, from the records of some files that share one header."""
    spark = records.sparkSession
    if encoding.upper() != UTF8:
        need_java_charsets(spark)
    columns = spark.read.options(**_csv_options(encoding, True)).csv(paths[0]).columns
    some = records.join(spark.createDataFrame([(p,) for p in paths], "path string"), "path", "left_semi")
    some = some.filter(F.col("text") != "")
    heads = some.groupBy("path").agg(
        F.min(F.struct("block", "row")).alias("first"), F.min_by("text", F.struct("block", "row")).alias("header")
    )
    if heads.select("header").distinct().count() > 1:
        raise ValueError(f"files do not share one header: {', '.join(paths)}")
    body = some.join(heads.select("path", "first"), "path").filter(F.struct("block", "row") != F.col("first"))
    places = {c: f"c{i}" for i, c in enumerate(columns)}
    text = F.decode(F.encode("text", "ISO-8859-1"), encoding)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    parsed = body.select(
        F.from_csv(text, ", ".join(f"{name} string" for name in places.values()), options).alias("fields"),
        F.col("path").alias("_file"),
        F.col("block").alias("_block"),
        F.col("row").alias("_row"),
    )
    fields = [F.coalesce(F.col(f"fields.{name}"), F.lit("")).alias(c) for c, name in places.items()]
    return parsed.select(*fields, *SOURCE)


def read_catalog_csv(
    spark: SparkSession,
    paths: Sequence[str] | str,
    encoding: str | None = None,
    input_order: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """Catalog records from CSV files; each is judged by one raw scan and parsed once.

    Without ``encoding`` each file's own is found by that scan, too. A file that is not plain, but no larger than
    ``split_bytes`` (by default what a task of the session reads), goes to the multi-line reader, as one task would read
    it anyway. The parsed rows are staged in the shared folder,
    so that what follows reads no CSV. The driver gets one path, encoding and shape per file, no more than the
    file listing it holds anyway.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = judged_files(spark, paths).collect()
    if not files:
        raise ValueError(f"no lines in {paths}")
    unknown = sorted(f["path"] for f in files if not (encoding or f["encoding"]))
    if unknown:
        raise ValueError(f"neither UTF-8 nor Korean, name the encoding: {', '.join(unknown)}")
    stage = shared_dir(spark, "csv-stage")
    if split_bytes is None:
        split_bytes = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    rest = sorted(f["path"] for f in files if not f["plain"] and f["size"] > split_bytes)
    records, formed = None, set()
    if rest:
        quoted_records(spark, rest).write.parquet(f"{stage}/records")
        records = spark.read.parquet(f"{stage}/records")
        formed = {r["path"] for r in well_formed_files(records).collect()}
    groups: dict[tuple[str, str], list[str]] = {}
    for f in files:
        shape = PLAIN if f["plain"] else QUOTED if f["path"] in formed else ODD
        groups.setdefault((encoding or f["encoding"], shape), []).append(f["path"])
    raw = None
    for (name, shape), some in sorted(groups.items()):
        some = sorted(some)
        if shape == QUOTED:
            part = parse_records(records, some, name)
        else:
            part = read_csv_text(spark, some, name, multi_line=shape == ODD, source=True)
        raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    raw.write.parquet(f"{stage}/rows")
    return catalog_records(spark.read.parquet(f"{stage}/rows"), input_order)


def catalog_records(raw: DataFrame, input_order: bool = False, numbered: bool = False) -> DataFrame:
    """The 17 record fields plus ``column_id``, from a frame with any of the known headers.

    Rows without a table name are skipped. ``column_id`` is COLUMN_ID where the header exists, else, or with
    ``input_order``, the row's place within its table in the order of the input. Rows whose COLUMN_ID is blank or
    no number are numbered on from the greatest one of their table, in the order of the input. ``numbered`` tells
    that there are none, as in a dictionary, and saves the passes that look for them; one is then an error.

    The order of the input is that of the ``SOURCE`` columns (file, block, row), the same for any split of the
    same files; a frame without them is numbered as it comes.
    """
    present = {name.upper(): name for name in raw.columns}

    def field(name: str):
        found = [F.col(f"`{present[h]}`").cast("string") for h in HEADERS[name] if h in present]
        if not found:
            return F.lit(DEFAULTS.get(name, "")).alias(name)
        return first_text(*found).alias(name)

    table = ["schema_name", "table_name"]
    fields = [field(name) for name in RECORD_FIELDS]
    given = "COLUMN_ID" in present and not input_order
    place = parse_int(F.col(f"`{present['COLUMN_ID']}`").cast("string")) if given else F.lit(None).cast("long")
    if given and numbered:
        stop = F.raise_error(F.concat(F.lit("no COLUMN_ID: "), F.col("table_name"), F.lit("."), F.col("column_name")))
        rows = raw.select(*fields, place.alias("_place")).filter(F.col("table_name") != "")
        return rows.select(*RECORD_FIELDS, F.coalesce("_place", stop.cast("long")).alias("column_id"))
    sourced = all(c in raw.columns for c in SOURCE)
    origin = [F.col(c) for c in SOURCE] if sourced else [F.lit(""), F.lit(0), F.monotonically_increasing_id()]
    order = F.struct(*[value.alias(c) for value, c in zip(origin, SOURCE, strict=True)]).alias("_at")
    rows = raw.select(*fields, place.alias("column_id"), order).filter(F.col("table_name") != "")
    part = F.struct("_at._file", "_at._block", F.shiftright("_at._row", _ORDER_BITS).alias("_part"))
    gaps = dense_positions(
        rows.filter(F.col("column_id").isNull()).drop("column_id"), group=table, order=["_at"], bucket=part, name="column_id"
    ).drop("_at")
    if not given:
        return gaps.select(*RECORD_FIELDS, "column_id")
    numbers = rows.filter(F.col("column_id").isNotNull()).drop("_at")
    most = numbers.groupBy(*table).agg(F.max("column_id").alias("_most"))
    after = gaps.join(most, table, "left")
    after = after.select(*RECORD_FIELDS, (F.col("column_id") + F.coalesce("_most", F.lit(0))).alias("column_id"))
    return numbers.select(*RECORD_FIELDS, "column_id").unionByName(after)
