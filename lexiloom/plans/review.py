"""What people do over a build's folder: apply marked sheets, label samples, compare settings, check a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions import policy as po
from lexiloom.functions import text as tx
from lexiloom.functions import variants as va
from lexiloom.operators import candidates as ca
from lexiloom.operators import evaluate as ev
from lexiloom.operators import sync as sy
from lexiloom.plans.build import Build
from lexiloom.sources import readers as rd
from lexiloom.sources import writers as wr

#: Least similarity, least frequency and pairs of a term that ``tune`` compares.
GRID = tuple((s, f, p) for s in (0.3, 0.5, 0.7) for f in (1, 5, 10) for p in (3, 10))
THRESHOLDS = (0.96, 0.95, 0.94, 0.92, 0.9, 0.85, 0.8, 0.7)


def marked(build: Build, terms: str | None, relations: str | None) -> tuple[DataFrame, DataFrame]:
    """(term) and (pair_key) that the sheets mark for removal."""
    none = build.spark.createDataFrame([], "value string")
    gone = rd.read_marked(build.spark, terms, "remove").select(F.btrim("term").alias("term")) if terms else none.toDF("term")
    pairs = rd.read_marked(build.spark, relations, "remove").select(F.btrim("pair_key").alias("pair_key")) if relations else none.toDF("pair_key")
    return gone.distinct(), pairs.distinct()


def apply_sheets(build: Build, terms: str | None = None, relations: str | None = None, dry_run: bool = False) -> DataFrame:
    """What a removal takes (by term, by pair, what stays). Unless dry_run: terms go to the list of stopwords
    and are no longer active, pairs go to the excluded ones, and their relations go."""
    gone, pairs = marked(build, terms, relations)
    gone, pairs = build.put(gone, "review/terms"), build.put(pairs, "review/pairs")
    impact = build.put(sy.removal_impact(build.get("relations"), gone, pairs), "review/impact")
    if not dry_run:
        wr.append_new(gone.select(F.col("term").alias("value")), build.spark, f"{build.folder}/stopwords")
        wr.append_new(pairs.select(F.col("pair_key").alias("value")), build.spark, f"{build.folder}/excluded_pairs")
        for name, rows in (("relations", sy.without_terms(build.get("relations"), gone, pairs)), ("typed_terms", sy.deactivated(build.get("typed_terms"), gone))):
            build.put(build.put(rows, f"review/{name}"), name)  # a table isn't written while it is read
        build.cascade()
    return impact


def gold_sample(build: Build, size: int, path: str, seed: int = 7) -> DataFrame:
    """A sheet of candidate pairs to label, of all paths alike."""
    pairs = build.get("candidates")
    rows = ev.stratified_sample(pairs, po.stratum(F.col("sources")), size, ["a", "b"], seed)
    sheet = rows.select("stratum", "a", "b", tx.pair_key(F.col("a"), F.col("b")).alias("pair_key"), F.array_join("sources", ",").alias("sources"), "priority", F.lit("").alias("label"))
    wr.write_sheet(sheet, path, "errorifexists")
    return sheet


def gold_figures(build: Build, labels: str) -> DataFrame:
    """Recall of labelled positives (Y) among the candidates, precision of ACTIVE, positives in REVIEW."""
    rows = rd.read_labels(build.spark, labels).select("pair_key", (F.col("label") == "Y").alias("positive"))
    found = build.get("candidates").select(tx.pair_key(F.col("a"), F.col("b")).alias("pair_key"), F.lit(True).alias("f"))
    status = build.get("relations").where("source <= target").select(tx.pair_key(F.col("source"), F.col("target")).alias("pair_key"), "status")
    rows = rows.join(found, "pair_key", "left").join(status, "pair_key", "left")
    return ev.gold_figures(rows.withColumn("found", F.coalesce("f", F.lit(False))))


def tune(build: Build, neighbors: DataFrame, grid: Sequence[tuple[float, int, int]] = GRID) -> tuple[DataFrame, DataFrame]:
    """Shares of similarities at thresholds among frequent terms' neighbours, and pairs for each setting."""
    terms = build.get("terms")
    near = ca.probe(terms, neighbors)
    return ev.threshold_shares(near, "similarity", THRESHOLDS), ev.grid_counts(neighbors, terms.select("term", F.col("frequency").alias("n")), grid)


def vary(docs: DataFrame, path: str, rules: list[va.Variant], column: str = "body") -> DataFrame:
    """Writes documents with spelling variants in place of canonical terms; gives what each rule has changed."""
    va.with_variants(docs, rules, column).write.mode("errorifexists").parquet(path)
    return va.variant_counts(docs.sparkSession.read.parquet(path))


def validate(docs: DataFrame, key: str = "doc_id", title: str | None = None, category: str | None = None, targets: dict[str, int] | None = None) -> DataFrame:
    """(problem, value, n) of a corpus: repeated and missing ids, repeated titles, categories off their targets."""
    problem = lambda name, rows, value, n: rows.select(F.lit(name).alias("problem"), F.col(value).cast("string").alias("value"), F.col(n).cast("long").alias("n"))
    out = problem("repeated id", ev.duplicates(docs, F.col(key)), "key", "n")
    if dict(docs.dtypes)[key] in ("int", "bigint", "smallint"):
        out = out.union(problem("missing id", ev.missing_ids(docs, key).withColumn("n", F.lit(1)), "id", "n"))
    if title:
        out = out.union(problem("repeated title", ev.duplicates(docs, F.col(title)), "key", "n"))
    if category:
        counts = ev.category_counts(docs, category, targets or {})
        out = out.union(problem("unknown category", counts.where("target IS NULL"), "category", "n"))
        out = out.union(problem("category short of its target", counts.where("missing > 0"), "category", "missing"))
    return out
