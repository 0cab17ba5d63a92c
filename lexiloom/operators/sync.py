"""Change detection and keyed writes: union or join, then one row for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def version_sync(incoming: DataFrame, cached: DataFrame, key: str = "page_id", version: str = "version") -> DataFrame:
    """Adds change: created, unchanged (the same version) or updated (any other)."""
    old = cached.select(key, F.col(version).alias("__old"), F.lit(True).alias("__there"))
    kind = F.when(F.col("__there").isNull(), "created").when(F.col(version).eqNullSafe(F.col("__old")), "unchanged").otherwise("updated")
    return incoming.join(old, key, "left").withColumn("change", kind).drop("__old", "__there")


def sync_counts(synced: DataFrame) -> DataFrame:
    kinds = ("created", "updated", "unchanged", "failed")
    counts = [F.count_if(F.col("change") == k).alias(k) for k in kinds]
    return synced.agg(F.count(F.lit(1)).alias("seen"), *counts).withColumn("changed", F.col("created") + F.col("updated"))


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def content_hash(title: Column, body: Column) -> Column:
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.substring(F.sha2(F.concat(blank(title), F.lit(" "), blank(body)), 256), 1, 16)


def changed_content(rows: DataFrame, stored: DataFrame, key: str, hashed: str = "hash") -> DataFrame:
    """Rows with state new, same or changed against stored hashes."""
    old = stored.select(key, F.col(hashed).alias("__h"))
    state = F.when(F.col("__h").isNull(), "new").when(F.col("__h") == F.col(hashed), "same").otherwise("changed")
    return rows.join(old, key, "left").withColumn("state", state).drop("__h")


def retain_only(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows with a key that is still there; all rows if no key is given at all."""
    return table if keys.isEmpty() else table.join(keys.select(key).distinct(), key, "left_semi")


def merge_status(candidates: DataFrame, outcomes: DataFrame, key: str, status: str = "status") -> DataFrame:
    new = outcomes.select(key, F.col(status).alias("__s"))
    return candidates.join(new, key, "left").withColumn(status, F.coalesce("__s", status)).drop("__s")


def upsert(table: DataFrame, rows: DataFrame, key: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The table with rows put over it; columns of ``keep`` stay as the table has them."""
    old = table.select(*key, *[F.col(c).alias(f"__{c}") for c in table.columns if c not in key], F.lit(True).alias("__old"))
    new = rows.withColumn("__new", F.lit(True))
    joined = old.join(new, list(key), "full")
    pick = lambda c: F.when(F.col("__old").isNotNull() & (F.lit(c in keep) | F.col("__new").isNull()), F.col(f"__{c}")).otherwise(F.col(c))
    return joined.select(*[c if c in key else pick(c).alias(c) for c in table.columns])


def upsert_max(rows: DataFrame, key: Sequence[str], best: str, order: str, rest: Sequence[str]) -> DataFrame:
    """One row for each key: the largest ``best``, and the rest of the last row."""
    return rows.groupBy(*key).agg(F.max(best).alias(best), *[F.max_by(c, order).alias(c) for c in rest])


def insert_new(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows to append: the first of each key that the table doesn't have."""
    return rows.dropDuplicates(list(key)).join(table.select(*key), list(key), "left_anti")


def deactivated(terms: DataFrame, gone: DataFrame) -> DataFrame:
    """The catalogue with active = false for terms that are gone (term); none is taken out."""
    marks = gone.select("term", F.lit(True).alias("__gone")).distinct()
    active = F.coalesce(F.col("active"), F.lit(True)) if "active" in terms.columns else F.lit(True)
    return terms.join(marks, "term", "left").withColumn("active", active & F.col("__gone").isNull()).drop("__gone")


def save_relations(rows: DataFrame, terms: DataFrame, key: Sequence[str] = ("source", "target", "relation_type"), order: str = "seq") -> DataFrame:
    """The last row of each relation whose ends are both in the catalogue."""
    known = terms.select(F.col("term"))
    for side in ("source", "target"):
        rows = rows.join(known.withColumnRenamed("term", side), side, "left_semi")
    return latest(rows, key, [F.desc(order)])


def relation_id() -> Column:
    """The id of a relation: of its ends and type, so that every run gives it the same."""
    return F.md5(F.concat_ws("||", "source", "target", "relation_type"))


def save_evidence(rows: DataFrame, terms: DataFrame, stored: DataFrame | None = None, evidence: str = "evidence") -> DataFrame:
    """(relation_id, context_id), once each, of relations whose ends are both in the catalogue, beside what is stored.
    A relation's evidence is that of all its rows, though its values are the last row's. No list, or one without
    ids, gives no row; ids that are null are left out."""
    known = terms.select(F.col("term")).distinct()
    for side in ("source", "target"):
        rows = rows.join(known.withColumnRenamed("term", side), side, "left_semi")
    found = rows.select(relation_id().alias("relation_id"), F.explode(evidence).alias("context_id")).where("context_id IS NOT NULL")
    return (found.union(stored.select("relation_id", "context_id")) if stored is not None else found).distinct()


def without_terms(relations: DataFrame, terms: DataFrame, pairs: DataFrame) -> DataFrame:
    """Relations with neither end removed nor the pair."""
    for side in ("source", "target"):
        relations = relations.join(terms.select(F.col("term").alias(side)), side, "left_anti")
    keyed = relations.withColumn("__k", F.concat_ws("||", F.least("source", "target"), F.greatest("source", "target")))
    return keyed.join(pairs.select(F.col("pair_key").alias("__k")), "__k", "left_anti").drop("__k")


def removal_impact(relations: DataFrame, terms: DataFrame, pairs: DataFrame) -> DataFrame:
    """Counts of what a removal would take: by term, by pair only, and what remains."""
    gone = terms.select("term", F.lit(True).alias("__t")).distinct()
    rows = relations.join(gone.toDF("source", "__s"), "source", "left").join(gone.toDF("target", "__d"), "target", "left")
    rows = rows.withColumn("pair_key", F.concat_ws("||", F.least("source", "target"), F.greatest("source", "target"))).join(pairs.select("pair_key", F.lit(True).alias("__p")).distinct(), "pair_key", "left")
    by_term = F.coalesce("__s", "__d", F.lit(False))
    by_pair = ~by_term & F.coalesce("__p", F.lit(False))
    return rows.agg(F.count_if(by_term).alias("by_term"), F.count_if(by_pair).alias("by_pair"), F.count_if(~by_term & ~by_pair).alias("remaining"))
