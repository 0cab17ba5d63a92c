"""Keyed tables: writes touch only the partitions whose keys they have.

A table's rows are dealt by a hash of the key into a fixed number of partitions, which its folders' names tell.
A write reads the partitions of its own keys (pruned by their numbers), merges, and overwrites just those
(dynamic partition overwrite: files are staged, and moved when all tasks have ended). So a write
costs what it touches, and a job that dies before its commit leaves the table as it was.

Cases: rows with one key in a write must be one (sync.latest makes them so); columns that only the table or only
the rows have are null in the other; writing no rows changes nothing; null keys are a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "bucket_of_"


class KeyedTable:
    """A folder of Parquet partitions by a hash of ``key``; ``buckets`` counts for a new table only."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.key = spark, path.rstrip("/"), list(key)
        parts = self._parts()
        self.bucket = parts[0].partition("=")[0] if parts else f"{PREFIX}{buckets}"
        self.buckets = int(self.bucket.removeprefix(PREFIX))

    def _parts(self) -> list[str]:
        """The folders of the partitions that have rows: ``buckets`` at most."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        parts = sorted(n for n in names if n.startswith(PREFIX))
        if not parts and any(not n.startswith(("_", ".")) for n in names):
            raise ValueError(f"{self.path} isn't a keyed table")
        return parts

    def exists(self) -> bool:
        return bool(self._parts())

    def _whole(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(self.path)

    def read(self) -> DataFrame:
        return self._whole().drop(self.bucket)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.bucket, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame) -> None:
        # a partition's rows come together, so it has few files
        out = rows.repartition(self.bucket).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(self.bucket).parquet(self.path)

    def merge(self, rows: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Writes ``how(what the touched partitions have, rows)``; gives the numbers of those partitions. ``how`` must
        leave other keys as they are; partitions that it empties keep their rows, so it mustn't take any out."""
        dealt = self._dealt(rows)
        if not self.exists():
            self._write(dealt)
            return list(range(self.buckets))
        touched = sorted(r[0] for r in dealt.select(self.bucket).distinct().collect())  # ``buckets`` numbers at most
        if touched:
            held = self._whole().where(F.col(self.bucket).isin(*touched)).drop(self.bucket)
            self._write(self._dealt(how(held, rows)))
        return touched

    def put(self, rows: DataFrame) -> list[int]:
        """Rows in place of those with their keys, and beside all others."""
        return self.merge(rows, lambda held, new: self._without(held, new).unionByName(new, allowMissingColumns=True))

    def add(self, rows: DataFrame) -> list[int]:
        """Rows whose keys the table doesn't have."""
        return self.merge(rows, lambda held, new: held.unionByName(self._without(new, held), allowMissingColumns=True))

    def _without(self, rows: DataFrame, others: DataFrame) -> DataFrame:
        keys = others.select(*[F.col(k).alias(f"__{k}") for k in self.key]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.key]
        return rows.join(keys, same, "left_anti")
