"""Shared folder, written tables and small helpers of the corpus operators."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.session import shared_root, ship

#: Rows of one Arrow batch: texts of 100,000 characters then stay under some 50 MB.
BATCH_ROWS = 256
#: The white space that words and lines are told by.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Bits of a filter: so many for each key, within these bounds (64 MB at most).
FILTER_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 29
#: Keys that hold more than 1 / HEAVY of all rows are joined by broadcast: there are HEAVY of them at most.
HEAVY = 10_000
#: Documents of the first batch of an index, at most; each later batch has as many as all before it.
FIRST_BATCH, LEAST_BATCHES = 1 << 20, 3


class Shelf:
    """Tables of one call, in a folder of their own under the shared folder.

    A written table cuts the lineage: when an executor is lost, only what reads the
    table runs again. The folder goes when the application ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.tables: dict[str, str] = {}
        self.names: set[str] = set()
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)

    def put(self, df: DataFrame, name: str, parts: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.path}/{name}"
        self.names.add(name)
        out = df.write.option("compression", "zstd")
        (out.partitionBy(*parts) if parts else out).parquet(path)
        return self.get(df, name)

    def get(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def run(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """A sorted run: a table in buckets by ``key``, each sorted by it. There are as many buckets as a
        shuffle has partitions, so merge joins of runs with each other and with what was grouped by the
        key need no exchange. The catalogue's entry goes with ``drop``, or at exit."""
        table = f"lexiloom_{uuid.uuid4().hex}_{name}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        out = df.write.format("parquet").option("path", f"{self.path}/{name}").option("compression", "zstd")
        out.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        if not self.tables:
            atexit.register(self._forget)
        self.tables[name] = table
        return self.spark.table(table)

    def _forget(self) -> None:
        if self.spark.sparkContext._jsc is not None:
            for name in list(self.tables):
                self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(name)}")

    def drop(self, name: str) -> None:
        """Deletes a table that no later step reads."""
        if name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(name)}")
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Readies a session for the Python operators: ships the package, and bounds what a
    Python worker holds: fewer rows to an Arrow batch, never more."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def trimmed(batches: Iterator[pa.RecordBatch], every: int = 4) -> Iterator[pa.RecordBatch]:
    """The batches of a Python worker's task. What was freed, by other operators in this worker too, goes back
    to the system before the first and then every few batches, so that it isn't the executor's any longer."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    for k, batch in enumerate(batches):
        if k % every == 0:
            pa.default_memory_pool().release_unused()
            if trim is not None:
                trim(0)
        yield batch


def whole_text(text: Column) -> Column:
    """The text for a Python operator: null is the empty text, and bytes that aren't UTF-8 are U+FFFD
    (Python can't take them)."""
    return F.make_valid_utf8(F.coalesce(text.cast("string"), F.lit("")))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def is_set(bits: Column, position: Column) -> Column:
    """Whether a bitmap (of bitmap_construct_agg) has the bit."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def filter_bits(n: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (FILTER_BITS * max(1, n) - 1).bit_length()))


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def build_filter(rows: DataFrame, bits: int, key: str = "digest") -> DataFrame:
    """(bucket, bits): a bitmap over the hashed keys, of bits / 8 bytes in all."""
    at = _place(F.col(key), bits)
    return rows.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def passing(rows: DataFrame, filters: DataFrame, bits: int, key: str = "digest", how: str = "left_semi") -> DataFrame:
    """The rows whose key's bit is set (left_anti: is not). The filter has bits / 8 bytes,
    MOST_BITS / 8 at most, so it is broadcast."""
    at = _place(rows[key], bits)
    f = F.broadcast(filters.toDF("__bucket", "__bits"))
    return rows.join(f, (F.bitmap_bucket_number(at) == f["__bucket"]) & is_set(f["__bits"], F.bitmap_bit_position(at)), how)


def narrowed(rows: DataFrame, keys: DataFrame, n: int, shelf: Shelf, name: str, key: str = "digest") -> tuple[DataFrame, DataFrame | None]:
    """(rows whose key may be one of the ``n`` keys, rows whose key is none of them). Where a filter of
    bounded size would let most rows pass (fewer than 8 bits a key), all rows may and the second is None.
    The filter is written as ``name``, once."""
    if n * FILTER_BITS > 2 * MOST_BITS:
        return rows, None
    bits = filter_bits(n)
    made = build_filter(keys, bits, key)
    filters = shelf.get(made, name) if name in shelf.names else shelf.put(made, name)
    return passing(rows, filters, bits, key), passing(rows, filters, bits, key, "left_anti")


def batches_for(n: int) -> int:
    """How many batches ``n`` rows make, where each batch is as large as all before it: merging every batch
    with all that came before then reads twice the index in all, whatever its size."""
    return max(LEAST_BATCHES, (max(1, n) // FIRST_BATCH).bit_length() + 1)


def batch_of(row_id: Column, batches: int) -> Column:
    """The batch (from 0) of a row: shares 1 : 1 : 2 : 4 ... by a hash of its id."""
    at = F.pmod(F.xxhash64(row_id), F.lit(1 << (batches - 1)))
    return F.when(at == 0, 0).otherwise(F.length(F.bin(at))).cast("int")


def looked_up(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has a row for a key at most and tells in ``count`` how many
    of the ``total`` rows have it (a left join). Keys of more than 1 / HEAVY of all rows are broadcast, and
    there are HEAVY of them at most; the others are merge-joined."""
    limit = max(1, total // HEAVY)
    heavy = F.broadcast(table.where(F.col(count) > limit))
    light = table.where(F.col(count) <= limit)
    return rows.join(heavy, key).unionByName(rows.join(heavy, key, "left_anti").join(light.hint("merge"), key, "left"))
