"""Written tables whose rows later steps find by bucket, without moving them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm.common import remove


class Bucketed:
    """Tables below a folder, bucketed and sorted by one column; they are known to the session until dropped."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int) -> None:
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self._prefix, self._known = f"tidegate_{uuid.uuid4().hex[:12]}", []

    def rows(self, name: str) -> DataFrame:
        return self.spark.table(f"{self._prefix}_{name}")

    def write(self, rows: DataFrame, name: str, by: str, parts: str | None = None, codec: str = "snappy") -> DataFrame:
        """Write a table and read it back. A task writes one file for every bucket that its rows are in."""
        table = f"{self._prefix}_{name}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, by).sortBy(by)
        if parts:
            writer = writer.partitionBy(parts)
        writer.options(path=f"{self.folder}/{name}", compression=codec).saveAsTable(table)
        self._known.append(name)
        return self.rows(name)

    def drop(self, name: str) -> None:
        """Forget the table and delete its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._prefix}_{name}")
        self._known.remove(name)
        self.delete(name)

    def delete(self, name: str) -> None:
        """Delete what is under a name below the folder."""
        remove(self.spark, self.folder, name)

    def drop_all(self) -> None:
        for name in list(self._known):
            self.drop(name)
