"""Day-partitioned, clustered tables: write, replace, expire and read them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

DAY = "day"
PARTITIONS_PER_STATEMENT = 500


def refuse_clash(df: DataFrame, name: str) -> None:
    """A helper column must not replace one of the data; names differ in more than case."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the data has a column {name}; choose another name for the helper column")


def with_day(df: DataFrame, ts: str, name: str = DAY) -> DataFrame:
    """Add the day of ``ts``, the column the files are partitioned by; ``name`` must be free."""
    refuse_clash(df, name)
    return df.withColumn(name, F.to_date(F.col(f"`{ts}`")))


def row_spread(df: DataFrame) -> Column:
    """A hash of the whole row: splits equal sort keys in the same way on every attempt."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


@dataclass(frozen=True)
class DayFolders:
    """A table of day folders whose days are replaced together.

    New days are written to a staging folder first. A manifest that names it, made by one rename, is the commit;
    then folders are renamed day by day, and the manifest goes last. A driver that is lost before the commit leaves
    the old days; one that is lost after it leaves a manifest, and whoever opens the table next carries on. So the
    days are all old or all new, for readers that open the table here. Names that begin with ``_`` are hidden from
    Spark. It needs a file system with atomic renames; the driver holds one name per replaced day.
    """

    spark: SparkSession
    path: str

    def _at(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path.rstrip("/"), *names]))

    @property
    def _files(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *folder: str) -> list[str]:
        files, at = self._files, self._at(*folder)
        return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []

    def stage(self, rows: DataFrame, day: str) -> str:
        """Write rows as day folders that nobody sees yet; return the name of the change."""
        change = uuid.uuid4().hex
        rows.write.partitionBy(day).parquet(f"{self.path.rstrip('/')}/_staged-{change}")
        return change

    def commit(self, change: str) -> None:
        """From here on the staged days are the table's."""
        temporary, manifest = self._at(f"_draft-{change}"), self._at(f"_replace-{change}")
        self._files.create(temporary, True).close()
        if not self._files.rename(temporary, manifest):
            raise OSError(f"could not commit {manifest}")

    def finish(self) -> None:
        """Carry out whatever is committed; renames that were made before are left out."""
        for name in self._names():
            if not name.startswith("_replace-"):
                continue
            change = name.removeprefix("_replace-")
            staged, old = f"_staged-{change}", f"_old-{change}"
            self._files.mkdirs(self._at(old))
            for folder in self._names(staged):
                if "=" not in folder:
                    continue
                # A day that was moved away, but not replaced yet, is found under the old ones.
                if self._files.exists(self._at(folder)):
                    self._move(self._at(folder), self._at(old, folder))
                self._move(self._at(staged, folder), self._at(folder))
            for done in (staged, old, name):
                self._files.delete(self._at(done), True)

    def _move(self, source, target) -> None:
        if not self._files.rename(source, target):
            raise OSError(f"could not move {source} to {target}")

    def open(self) -> DataFrame:
        self.finish()
        return self.spark.read.parquet(self.path)


def replace_day_folders(rows: DataFrame, path: str, day: str = DAY) -> None:
    """Replace the days present in ``rows``, all or none of them (see ``DayFolders``)."""
    table = DayFolders(rows.sparkSession, path)
    table.finish()
    table.commit(table.stage(rows, day))
    table.finish()


def day_writer(rows: DataFrame, mode: str) -> DataFrameWriter:
    """A writer for ``errorifexists``, ``overwrite`` or ``append``; the session's own overwrite mode plays no part."""
    return rows.write.mode(mode).option("partitionOverwriteMode", "static")


def write_day_folders(rows: DataFrame, path: str, mode: str, day: str) -> None:
    """Write rows that have a day; ``replace_days`` replaces only the days present in them, all or none."""
    if mode == "replace_days":
        replace_day_folders(rows, path, day)
    else:
        day_writer(rows, mode).partitionBy(day).parquet(path)


def write_by_day(df: DataFrame, ts: str, path: str, mode: str = "errorifexists", day: str = DAY) -> None:
    """Write Parquet partitioned by day, in a column of the name ``day``.

    ``mode``: ``errorifexists`` creates, ``overwrite`` replaces the whole table, ``replace_days``
    replaces only the days present in ``df``, ``append`` adds. Rows are rebalanced by day first:
    few files per day, and a day that holds much of the table is split over several tasks.
    """
    rows = with_day(df, ts, day).hint("rebalance", F.col(day))
    write_day_folders(rows, path, mode, day)


def cluster_layout(
    df: DataFrame, cluster_by: Sequence[str], ts: str | None = None, partitions: int | None = None, day: str = DAY
) -> DataFrame:
    """Co-locate rows by the clustering columns, within each day when ``ts`` is given.

    Range partitioning with the row's hash as the last key: a key or day that holds a third of all
    rows is cut into neighbouring partitions instead of one. ``partitions`` is the number of ranges
    (for about 1 GB each); by default the session's shuffle partitions, merged where small.
    """
    keys = [*([day] if ts else []), *cluster_by]
    rows = with_day(df, ts, day) if ts else df
    count = [partitions] if partitions else []
    named = [F.col(f"`{key}`") for key in keys]
    return rows.repartitionByRange(*count, *named, row_spread(df)).sortWithinPartitions(*named)


def write_clustered(
    df: DataFrame,
    cluster_by: Sequence[str],
    path: str,
    ts: str | None = None,
    mode: str = "errorifexists",
    partitions: int | None = None,
    day: str = DAY,
) -> None:
    """Write a clustered table: row groups then carry narrow min/max values of the keys.

    ``replace_days`` needs ``ts``: it replaces the days present in ``df`` and leaves the others.
    """
    if mode == "replace_days" and not ts:
        raise ValueError("days can only be replaced in a table that is partitioned by day")
    rows = cluster_layout(df, cluster_by, ts, partitions, day)
    if ts:
        write_day_folders(rows, path, mode, day)
    else:
        day_writer(rows, mode).parquet(path)


def _at(day: date, df: DataFrame, ts: str) -> Column:
    """Midnight of ``day`` in the column's own type, so that the comparison reaches the scan."""
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz").cast(df.schema[ts].dataType)


def expire_partitions(df: DataFrame, ts: str, as_of: date, days: int) -> DataFrame:
    """Keep days from ``as_of - days`` on. Rows without a timestamp have no day and never expire."""
    cutoff = as_of - timedelta(days=days)
    moment = F.col(f"`{ts}`")
    kept = (moment >= _at(cutoff, df, ts)) | moment.isNull()
    if DAY in df.columns:
        kept = kept & ((F.col(DAY) >= F.lit(cutoff)) | F.col(DAY).isNull())
    return df.filter(kept)


def expired_days(df: DataFrame, ts: str, as_of: date, days: int) -> DataFrame:
    """The days that ``expire_partitions`` drops, with their rows."""
    cutoff = as_of - timedelta(days=days)
    gone = df.filter(F.col(f"`{ts}`") < _at(cutoff, df, ts))
    return gone.groupBy(F.to_date(F.col(f"`{ts}`")).alias(DAY)).agg(F.count("*").alias("rows"))


def partition_days(spark: SparkSession, name: str, day: str = DAY) -> list[date]:
    """The days that a stored table has, from its list of partitions; rows without a day are in none of them."""
    values = [row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    return sorted(date.fromisoformat(v) for v in values if re.fullmatch(r"\d{4}-\d{2}-\d{2}", v))


def drop_expired(spark: SparkSession, name: str, as_of: date, days: int, day: str = DAY) -> list[date]:
    """Drop the days before ``as_of - days`` of a stored table that is partitioned by ``day``; return them.

    Partitions go as a whole, from the table's list of them: no data file is opened. The partition of rows
    without a timestamp stays. Dropping a partition of an external table leaves its files, so those are deleted
    after the table has forgotten them; a driver that is lost in between leaves files that no query reads, and
    the next run, which looks at the folders too, removes them. Driver memory holds one date per day.
    """
    cutoff = as_of - timedelta(days=days)
    gone = [found for found in partition_days(spark, name, day) if found < cutoff]
    for start in range(0, len(gone), PARTITIONS_PER_STATEMENT):
        some = ", ".join(f"PARTITION ({day} = DATE '{d.isoformat()}')" for d in gone[start : start + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {some}")
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    root = spark._jvm.org.apache.hadoop.fs.Path(about["Location"])
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    left = [status.getPath() for status in files.listStatus(root) if status.isDirectory()]
    for folder in left:
        found = re.fullmatch(rf"{re.escape(day)}=(\d{{4}}-\d{{2}}-\d{{2}})", folder.getName())
        if found and date.fromisoformat(found[1]) < cutoff:
            files.delete(folder, True)
            gone.append(date.fromisoformat(found[1]))
    spark.catalog.refreshTable(name)
    return sorted(set(gone))


def read_days(spark: SparkSession, path: str, ts: str, start: date, end: date) -> DataFrame:
    """Rows of the days ``start`` to ``end`` (both included) of a table from ``write_by_day``.

    The day condition prunes folders and the timestamp condition prunes row groups; a timestamp
    condition alone would open every folder. A replacement that a lost driver left half done is finished first.
    """
    df = DayFolders(spark, path).open()
    moment = F.col(f"`{ts}`")
    return df.filter(
        (F.col(DAY) >= F.lit(start))
        & (F.col(DAY) <= F.lit(end))
        & (moment >= _at(start, df, ts))
        & (moment < _at(end + timedelta(days=1), df, ts))
    )


def save_table(
    df: DataFrame,
    name: str,
    create_or_replace: bool = False,
    drop_first: bool = False,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    buckets: int = 0,
    path: str | None = None,
) -> None:
    """Create, create-or-replace, or drop-then-create a catalog table.

    Like the definitions, a drop happens only for a replaced table that is partitioned.
    ``path`` keeps the data outside the warehouse. ``buckets`` with ``cluster_by`` buckets and sorts the table, so later joins on those columns
    need no shuffle.
    """
    if create_or_replace and drop_first and partition_by:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.format("parquet").mode("overwrite" if create_or_replace else "errorifexists")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if cluster_by and buckets:
        writer = writer.bucketBy(buckets, *cluster_by).sortBy(*cluster_by)
    writer.saveAsTable(name)
