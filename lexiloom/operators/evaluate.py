"""Review sheets, samples, evaluation against labels, and checks of a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions import policy as po
from lexiloom.functions import text as tx


def involvement(pairs: DataFrame) -> DataFrame:
    """(term, pairs): in how many candidate pairs a term is."""
    return pairs.select(F.explode(F.array("a", "b")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("pairs"))


def terms_sheet(terms: DataFrame, pairs: DataFrame, patterns: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """A row for each term to review: kinds, counts, hint, pairs, and two shortened contexts. Kinds that aren't known are empty."""
    rows = terms.join(involvement(pairs), "term", "left").join(patterns, "term", "left").fillna(0, ["pairs", "patterns"])
    kinds = [F.coalesce(F.col(c) if c in terms.columns else F.lit(None), F.lit("")).alias(c) for c in ("term_type", "entity_type")]
    hint = po.removal_hint(F.col("term"), F.col("patterns"), F.col("frequency"))
    out = rows.select(
        F.lit("").alias("remove"), "term", tx.display_term(F.col("term")).alias("display"), *kinds, "frequency", "document_frequency", "sentence_ratio", "excluded_reason", "pairs", "patterns", hint.alias("hint")
    )
    if contexts is None:
        return out
    shown = contexts.where("rank < 2").groupBy("term").agg(F.array_sort(F.collect_list(F.struct("rank", F.substring(F.btrim("sentence"), 1, 70).alias("s")))).alias("c"))
    return out.join(shown.select("term", F.concat_ws(" / ", F.transform("c", lambda x: x["s"])).alias("contexts")), "term", "left")


def relations_sheet(pairs: DataFrame, relations: DataFrame, terms: DataFrame) -> DataFrame:
    """A row for each candidate pair with its relation, if any (state UNJUDGED, if none), whether it may expand
    a search, a hint where it was rejected, and both ends' names and counts."""
    safe = F.col("safe_expansion") if "safe_expansion" in relations.columns else F.lit(False)
    rel = relations.select(F.col("source").alias("a"), F.col("target").alias("b"), "relation_type", "confidence", "status", F.when(safe, "yes").otherwise("").alias("expandable"), F.substring("reason", 1, 160).alias("reason"))
    own = pairs.withColumnRenamed("status", "candidate_status") if "status" in pairs.columns else pairs
    out = own.join(rel, ["a", "b"], "left")
    for side in ("a", "b"):
        out = out.join(terms.select(F.col("term").alias(side), F.col("frequency").alias(f"frequency_{side}")), side, "left")
    out = out.withColumn("state", F.coalesce("status", F.lit("UNJUDGED"))).withColumn("hint", F.when(F.col("status") == "REJECTED", "judged unrelated").otherwise(""))
    out = out.withColumns({f"display_{side}": tx.display_term(F.col(side)) for side in ("a", "b")}).fillna("", ["relation_type", "confidence", "expandable", "reason"])
    return out.withColumn("pair_key", tx.pair_key(F.col("a"), F.col("b"))).withColumn("sources", F.array_join("sources", ",")).withColumn("remove", F.lit(""))


def stratified_sample(rows: DataFrame, stratum: Column, size: int, key: Sequence[str], seed: int = 7, order: Sequence[Column] | None = None) -> DataFrame:
    """``size`` rows: an equal share of each stratum, then the rest from what is left. The order of a
    stratum is a hash of the key and the seed, or the order given."""
    strata = rows.select(stratum.alias("s")).distinct().count()
    share = size // max(1, strata)
    by = list(order) if order else [F.xxhash64(F.lit(seed), *key), *map(F.col, key)]
    ranked = rows.withColumn("stratum", stratum).withColumn("__n", F.row_number().over(Window.partitionBy("stratum").orderBy(*by)))
    first = (F.col("__n") <= share).cast("int")
    return ranked.orderBy(F.desc(first), *by).limit(size).drop("__n")


def gold_figures(pairs: DataFrame) -> DataFrame:
    """Recall of positives, precision of ACTIVE, and positives in REVIEW of labelled pairs (positive, found, status)."""
    ratio = lambda a, b: F.round(F.try_divide(a, b), 4)
    pos = F.col("positive")
    c = [F.count_if(pos).alias("positives"), F.count_if(pos & F.col("found")).alias("found"), F.count_if(F.col("status") == "ACTIVE").alias("active"), F.count_if(pos & (F.col("status") == "ACTIVE")).alias("active_right"), F.count_if(pos & (F.col("status") == "REVIEW")).alias("in_review")]
    out = pairs.agg(*c)
    return out.select("*", ratio(F.col("found"), F.col("positives")).alias("recall"), ratio(F.col("active_right"), F.col("active")).alias("precision"))


def share_by(rows: DataFrame, group: Column, positive: Column) -> DataFrame:
    """(stratum, n, positives, share)."""
    return rows.groupBy(group.alias("stratum")).agg(F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("positives")).withColumn("share", F.round(F.col("positives") / F.col("n"), 4))


def threshold_shares(rows: DataFrame, value: str, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, n, share) of values at or above each threshold, in one pass."""
    sums = rows.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col(value) >= t).alias(f"t{k}") for k, t in enumerate(thresholds)])
    each = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{k}").alias("n")) for k, t in enumerate(thresholds)])
    return sums.select("all", F.explode(each).alias("e")).select("e.threshold", "e.n", F.round(F.try_divide(F.col("e.n"), F.col("all")), 4).alias("share"))


def grid_counts(neighbors: DataFrame, frequency: DataFrame, grid: Sequence[tuple[float, int, int]]) -> DataFrame:
    """Candidate pairs for each (least similarity, least frequency, per term): one pass over ranked neighbours."""
    rows = neighbors.join(frequency.select("term", F.col("n").alias("n_term")), "term").join(frequency.select(F.col("term").alias("other"), F.col("n").alias("n_other")), "other")
    pairs = rows.withColumn("a", F.least("term", "other")).withColumn("b", F.greatest("term", "other"))
    ok = lambda g: (F.col("similarity") >= g[0]) & (F.col("n_term") >= g[1]) & (F.col("n_other") >= g[1]) & (F.col("rank") <= g[2])
    flags = pairs.groupBy("a", "b").agg(*[F.bool_or(ok(g)).alias(f"g{k}") for k, g in enumerate(grid)])
    sums = flags.agg(*[F.count_if(f"g{k}").alias(f"g{k}") for k in range(len(grid))])
    each = F.array(*[F.struct(F.lit(float(s)).alias("min_similarity"), F.lit(f).alias("min_frequency"), F.lit(p).alias("per_term"), F.col(f"g{k}").alias("pairs")) for k, (s, f, p) in enumerate(grid)])
    return sums.select(F.explode(each).alias("e")).select("e.*")


# ---------------------------------------------------------------- corpus
def length_buckets(docs: DataFrame, length: Column, edges: Sequence[int]) -> DataFrame:
    bucket = F.lit(None)
    name = F.when(length < edges[0], f"<{edges[0]}")
    for a, b in zip(edges, edges[1:], strict=False):
        name = name.when(length < b, f"{a}-{b - 1}")
    bucket = name.otherwise(f">={edges[-1]}")
    return docs.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def missing_ids(docs: DataFrame, key: str) -> DataFrame:
    """Ids between the smallest and the largest that no row has: gaps between neighbours in each range
    of ids, so that no task sees all."""
    ids = docs.select(F.col(key).alias("id")).where("id is not null").distinct()
    span = ids.agg(F.min("id").alias("lo"), F.max("id").alias("hi"))  # one row
    every = span.where("lo is not null").select(F.explode(F.sequence(F.floor(F.col("lo") / 65536), F.floor(F.col("hi") / 65536))).alias("block"), "lo", "hi")
    wanted = every.select(F.explode(F.sequence(F.greatest("lo", F.col("block") * 65536), F.least("hi", F.col("block") * 65536 + 65535))).alias("id"))
    return wanted.join(ids, "id", "left_anti")


def duplicates(docs: DataFrame, key: Column) -> DataFrame:
    return docs.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def category_counts(docs: DataFrame, category: str, targets: dict[str, int]) -> DataFrame:
    """(category, n, target, missing); unknown categories have no target."""
    spark = docs.sparkSession
    goal = spark.createDataFrame(list(targets.items()), "category string, target int")
    counts = docs.groupBy(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    out = counts.join(F.broadcast(goal), "category", "full")
    return out.select("category", F.coalesce("n", F.lit(0)).alias("n"), "target", F.when(F.col("target").isNotNull(), F.greatest(F.col("target") - F.coalesce("n", F.lit(0)), F.lit(0))).alias("missing"))


def unlisted_mentions(docs: DataFrame, body: str, names: Sequence[str], listed: str, key: str) -> DataFrame:
    """(key, name) of names that a body has and the list column hasn't."""
    found = F.filter(F.array(*map(F.lit, names)), lambda n: F.contains(F.col(body), n) & ~F.array_contains(F.coalesce(F.col(listed), F.array().cast("array<string>")), n))
    return docs.select(F.col(key).alias("key"), F.explode(found).alias("name"))


def ground_truth(truth: DataFrame, published: DataFrame, key: str = "id") -> DataFrame:
    """Labelled documents with the page that each was published as; null where it wasn't."""
    return truth.join(published.select(key, "page_id"), key, "left")


def registry(parts: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """The union of a corpus's modules, in the order of their ids."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.orderBy(key)


def share_present(docs: DataFrame, column: str) -> DataFrame:
    """(n, present, share): documents whose list column isn't empty."""
    has = F.coalesce(F.size(column), F.lit(0)) > 0
    return docs.agg(F.count(F.lit(1)).alias("n"), F.count_if(has).alias("present")).withColumn("share", F.round(F.try_divide("present", "n"), 4))
