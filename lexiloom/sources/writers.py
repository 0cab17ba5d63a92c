"""Sinks: tables, dictionary and sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Fixed names: the fields of a run's record.
RUN_FIELDS = (
    "run_id string", "started_at timestamp", "completed_at timestamp", "status string", "document_count long", "changed_document_count long",
    "sentence_count long", "phrase_count long", "vocabulary_size long", "term_count long", "candidate_count long", "validated_count long",
    "active_relation_count long", "review_relation_count long", "rejected_relation_count long", "error_count long", "duration_seconds double", "message string",
)
#: Which of a build's counts a field has.
RUN_COUNTS = {
    "document_count": "pages", "changed_document_count": "changed", "sentence_count": "sentences", "phrase_count": "phrases", "vocabulary_size": "vocabulary",
    "term_count": "terms", "candidate_count": "candidates", "validated_count": "validated", "active_relation_count": "active",
    "review_relation_count": "review", "rejected_relation_count": "rejected", "error_count": "failed",
}


def write_table(df: DataFrame, path: str, mode: str = "overwrite", cluster: list[str] | None = None) -> None:
    """A Parquet table; clustered by columns, if given, so that readers can skip."""
    (df.sortWithinPartitions(*cluster) if cluster else df).write.mode(mode).parquet(path)


def evolve(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Both, with columns that only one of them has as nulls in the other."""
    return table.unionByName(rows, allowMissingColumns=True)


def errors(rows: DataFrame, key: str, message: str = "error") -> DataFrame:
    """The error log of rows that failed."""
    return rows.where(F.col(message).isNotNull()).select(F.col(key).cast("string").alias("key"), F.substring(message, 1, 2000).alias("message"))


def write_dictionary(entries: DataFrame, path: str) -> None:
    entries.write.mode("overwrite").json(path)


def write_review_queue(queue: DataFrame, path: str) -> None:
    queue.write.mode("overwrite").json(path)


def write_user_dictionary(phrases: DataFrame, path: str, phrase: str = "phrase") -> None:
    """Phrases for the next round's dictionary, tab separated."""
    phrases.select(F.replace(F.col(phrase), F.lit("_"), F.lit(" ")), F.lit("NNP")).write.mode("overwrite").option("sep", "\t").csv(path)


def write_corpus(rows: DataFrame, path: str, tokens: str = "tokens") -> None:
    rows.select(F.array_join(tokens, " ")).write.mode("overwrite").text(path)


def write_sheet(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A CSV sheet; mode errorifexists guards what people have filled in."""
    rows.write.mode(mode).option("header", True).csv(path)


def append_new(lines: DataFrame, spark: SparkSession, path: str) -> None:
    """Appends lines (value) that the text doesn't have."""
    new = lines.select("value").distinct()
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        new = new.join(spark.read.text(path), "value", "left_anti")
    new.write.mode("append").text(path)


def run_record(run_id: str, counts: dict[str, Column], frames: dict[str, DataFrame], status: str = "COMPLETED") -> DataFrame:
    """One row of a run's metrics: a count of each frame, and scalars."""
    names = list(frames)
    one = frames[names[0]].agg(F.count(F.lit(1)).alias(names[0]))
    for n in names[1:]:
        one = one.crossJoin(frames[n].agg(F.count(F.lit(1)).alias(n)))  # one row each
    return one.select(F.lit(run_id).alias("run_id"), F.lit(status).alias("status"), *names, *[c.alias(k) for k, c in counts.items()])
