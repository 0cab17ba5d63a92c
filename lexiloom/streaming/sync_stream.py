"""Version sync as a stream: an extension, for the reference syncs in batches only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexiloom.operators.sync import latest, version_sync


def sync_stream(stream: DataFrame, table: str, out: str, checkpoint: str, key: str = "page_id", version: str = "version") -> StreamingQuery:
    """Appends each batch's created and updated rows to ``out``, against ``table`` and what was appended before."""

    def batch(rows: DataFrame, number: int) -> None:
        spark: SparkSession = rows.sparkSession
        new = latest(rows, [key], [F.desc(version)])
        cached = spark.read.parquet(table).select(key, version)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            before = spark.read.parquet(out).where(F.col("batch") != number)  # a batch that runs again replaces itself
            cached = latest(cached.unionByName(before.select(key, version)), [key], [F.desc(version)])
        changed = version_sync(new, cached, key, version).where("change <> 'unchanged'").withColumn("batch", F.lit(number))
        changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
