"""Helpers of the training-data operators: tables, splits, work folders, Arrow columns."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import ship_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the input folder; the workers get this package, which their functions come from."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_fold(id_column: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold; a null id falls into none."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == fold, F.lit(False))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; nulls are empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def work_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, for data that later steps read again.

    Where the setting is absent, a master of one process (tests on one machine) uses a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^,\]]*(,\d+)?\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidegate-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def cut(rows: DataFrame, folder: str, name: str) -> DataFrame:
    """Write rows below the work folder and read them back: lineage ends here, work is done once."""
    rows.write.parquet(f"{folder}/{name}")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{name}")


def remove(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete written intermediates that no later step reads."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hash_sample(rows: DataFrame, by: str, id_column: str, per_value: int, seed: int, most_values: int = 1000) -> DataFrame:
    """A sample of about per_value rows for each value of a column, chosen by a hash of the id.

    Of more than most_values values the most frequent ones are sampled.

    The counts per value come from all rows; each value then keeps the share of the hash range that gives
    per_value rows on average. The same rows are chosen wherever they lie, and values with fewer rows keep
    all of them.
    """
    steps = 1 << 40
    counts = rows.groupBy(F.col(by).alias("sample_value")).agg(F.count(F.lit(1)).alias("sample_rows"))
    counts = counts.orderBy(F.desc("sample_rows"), "sample_value").limit(most_values)
    limits = {r["sample_value"]: min(steps, steps * per_value // r["sample_rows"]) for r in counts.collect()}
    if not limits:
        return rows.limit(0)
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col(by)]
    return rows.where(F.pmod(F.xxhash64(F.col(id_column), F.lit(seed)), F.lit(steps)) < limit)


def batched(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about most_bytes at most; a longer row is a batch by itself."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, int(batch.num_rows * most_bytes / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
