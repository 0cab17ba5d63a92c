"""A pipeline over ``documents``: quality rules, line dedup, near dedup, personal data, packing.

Every stage takes all that its predecessor kept and gives the columns of documents,
but for the last, which gives the packed pieces. Cases: as in the operators; a text
that line dedup empties stays as an empty document, for the stages behind it judge
near copies and pieces, not quality; rows with one id share the verdict on near copies;
a null id is never taken for a copy. n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.line_dedup import line_dedup
from lexiloom.llm.packing import pack_documents
from lexiloom.llm.pii import redacted
from lexiloom.llm.pretok import vocab_path
from lexiloom.llm.quality import accepted
from lexiloom.llm.simhash import near_dedup
from lexiloom.llm.store import Shelf, narrowed, small_batches


def _with_text(docs: DataFrame, text: object, columns: list[str]) -> DataFrame:
    """The columns of documents with a new text, and n_chars after it."""
    out = docs.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return accepted(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are common to documents stay in one of them."""
    out = "__lines"
    while out in docs.columns:
        out += "_"
    return _with_text(line_dedup(docs, out=out), F.col(out).getField("text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id: an id's rows share the verdict."""
    shelf = Shelf(spark, "copies")
    go = near_dedup(docs).where(F.col("id") != F.col("component_id")).select(F.col("id").alias("doc_id")).distinct()
    go = shelf.put(go, "go")
    # only documents that a filter says may go are shuffled; the others stay where they are
    may, stay = narrowed(docs, go, go.count(), shelf, "may_go", "doc_id")
    kept = may.join(go, "doc_id", "left_anti")
    return (kept if stay is None else kept.unionByName(stay)).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    small_batches(spark)
    return _with_text(docs, redacted(F.col("text")), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences of 2048 tokens at most."""
    return pack_documents(docs, vocab_path(), end_id=0, capacity=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_lines),
    ("near_dedup", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packing),
]
#: SQL can't express the fingerprints' hash, the random field or the tokens: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to the documents, each stage's rows written and read again."""
    shelf = Shelf(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shelf.put(stage(spark, docs, sf_dir), name)
    return docs
