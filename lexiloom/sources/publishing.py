"""Publishing of changed rows through a data source writer, with any ``publish`` function.

``publish_changed`` compares content hashes with the stored ones and writes only rows that are new or
changed. A writing task calls ``publish(row)`` for each of its rows, with retries; a row that can't be
published fails the task, and Spark tries the task again. Hashes are stored after the commit, so a
broken run publishes its rows again and none is left out: publishing must be repeatable by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from lexiloom.operators import sync as sy
from lexiloom.session import written
from lexiloom.sources.readers import loaded, retried


@dataclass
class Published(WriterCommitMessage):
    """What a task has published."""

    rows: int


class PublishingSink(DataSource):
    """df.write.format("publish").option("publish", "module:function").mode("append").save(): the function takes a row as
    a dict. Options: finish and failed, functions of the number of rows published, called once in the driver
    when all tasks have ended well, or when the write is given up."""

    @classmethod
    def name(cls) -> str:
        return "publish"

    def writer(self, schema: Any, overwrite: bool) -> DataSourceWriter:
        return _PublishingWriter(dict(self.options))


class _PublishingWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.options = options

    def write(self, iterator: Iterator[Any]) -> WriterCommitMessage:
        publish, n = loaded(self.options["publish"]), 0
        for row in iterator:
            retried(lambda one, _: (publish(one), None), row.asDict(recursive=True), None)
            n += 1
        return Published(n)

    def _tell(self, option: str, messages: list[WriterCommitMessage | None]) -> None:
        if option in self.options:
            loaded(self.options[option])(sum(m.rows for m in messages if m is not None))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._tell("finish", messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._tell("failed", messages)


def publish_changed(rows: DataFrame, publish: str, stored: DataFrame | None, store: str, key: str = "page_id", content: Column | None = None, **options: str) -> DataFrame:
    """Publishes rows whose hash isn't stored, and appends their hashes (key, hash, at) to the table ``store``. Gives
    a row of counts (new, changed, same). stored: hashes that the table has, None if there is none yet."""
    spark = rows.sparkSession
    spark.dataSource.register(PublishingSink)
    hashed = rows.withColumn("hash", sy.content_hash(F.col("title"), F.col("body")) if content is None else content)
    none = hashed.select(key, "hash").limit(0)
    last = none if stored is None else sy.latest(stored, [key], [F.desc("at")]).select(key, "hash")
    state = written(spark)(sy.changed_content(hashed, last, key), "state")
    changed = state.where("state <> 'same'")
    changed.drop("state", "hash").write.format("publish").options(publish=publish, **options).mode("append").save()
    changed.select(key, "hash", F.current_timestamp().alias("at")).write.mode("append").parquet(store)
    return state.agg(*[F.count_if(F.col("state") == k).alias(k) for k in ("new", "changed", "same")])
