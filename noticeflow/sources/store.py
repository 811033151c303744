"""Tables as Parquet snapshots that are swapped, never overwritten in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noticeflow.schemas import TABLES, conform, enforce
from noticeflow.storage import done, fs_path, mark_done


class Store:
    """A folder of tables; each table has numbered versions, the highest marked one is in force.

    A reader holds the version it planned with; a writer that dies leaves the
    version before its own in force. Append-only tables add parts to one folder.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, *parts: str):
        return fs_path(self.spark, "/".join((self.folder, *parts)))

    def version(self, table: str) -> int:
        return done(self.spark, f"{self.folder}/{table}")

    def read(self, table: str) -> DataFrame:
        """The table, empty before its first version."""
        v = self.version(table)
        if v < 0:
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.folder}/{table}/v{v}")

    def replace(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Write the next version, checked row by row, then mark it as the one in force."""
        v = self.version(table) + 1
        enforce(conform(df, table), table).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.folder}/{table}/v{v}")
        mark_done(self.spark, f"{self.folder}/{table}", v)
        return v

    def append(self, table: str, df: DataFrame, part: str) -> None:
        """Add a named part to an append-only table; the same part again replaces itself."""
        enforce(conform(df, table), table).write.mode("overwrite").parquet(f"{self.folder}/{table}/part={part}")

    def read_appended(self, table: str) -> DataFrame:
        p, fs = self._path(table)
        if not fs.exists(p):
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(str(p)).drop("part")
