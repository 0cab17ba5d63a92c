"""Candidate pairs of terms: lexical rules, co-occurrence profiles, vectors, fusion and selection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions import text as tx
from lexiloom.operators import blocks as bl
from lexiloom.session import written

ACRONYM = "^[A-Z][A-Z0-9]{1,7}$"
DISTRIBUTIONAL = ("FASTTEXT", "CONTEXT_PROFILE")
#: Weights of the priority: proposals, lexical rules, ranks, similarity, both ranks, each further source.
WEIGHTS = (0.80, 0.45, 0.30, 0.10, 0.15, 0.15)


def _bucket_pairs(terms: DataFrame, key: Column, score: float) -> DataFrame:
    """All pairs of terms with one key: what the rule asks for."""
    own = terms.select("term", key.alias("k")).where("k is not null").distinct()
    a, b = own.select("k", F.col("term").alias("a")), own.select("k", F.col("term").alias("b"))
    return a.join(b, "k").where("a < b").select("a", "b", F.lit(score).alias("score")).distinct()


def word_order_pairs(terms: DataFrame) -> DataFrame:
    """Terms of the same words in another order."""
    parts = F.transform(tx.parts_of(F.col("term")), F.lower)
    return _bucket_pairs(terms, F.when(F.size(parts) >= 2, F.array_join(F.array_sort(F.array_distinct(parts)), "\x01")), 1.0)


def squash_pairs(terms: DataFrame) -> DataFrame:
    """Terms that differ in blanks, marks or case only. Terms of marks alone have no key (they are never eligible)."""
    key = tx.squashed(F.col("term"))
    return _bucket_pairs(terms, F.when(key != "", key), 1.0)


def acronym_pairs(terms: DataFrame, score: float = 0.9) -> DataFrame:
    """Acronyms and the terms that have their initials."""
    parts = tx.parts_of(F.col("term"))
    initials = F.upper(F.array_join(F.transform(parts, lambda p: F.left(p, F.lit(1))), ""))
    long = terms.where(F.size(parts) >= 2).select(F.col("term").alias("x"), initials.alias("k"))
    bare = F.replace(F.col("term"), F.lit("_"), F.lit(""))
    short = terms.where(F.regexp_like(bare, F.lit(ACRONYM))).select(F.col("term").alias("y"), F.upper(bare).alias("k"))
    return long.join(short, "k").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit(score).alias("score")).where("a <> b").distinct()


def containment_pairs(terms: DataFrame) -> DataFrame:
    """One-word terms and the terms that contain them as a word; score 1 / number of words."""
    parts = tx.parts_of(F.col("term"))
    low = F.transform(parts, F.lower)
    single = terms.where((F.size(parts) == 1) & (F.length(parts[0]) >= 2)).select(F.col("term").alias("x"), low[0].alias("k"))
    many = terms.where(F.size(parts) >= 2).select(F.col("term").alias("y"), F.round(1 / F.size(parts), 4).alias("score"), F.explode(F.array_distinct(low)).alias("k"))
    pairs = single.join(many, "k").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "score")
    return pairs.groupBy("a", "b").agg(F.max("score").alias("score"))


def lexical_pairs(terms: DataFrame) -> DataFrame:
    """(a, b, sources, score) of all lexical rules."""
    rules = [(word_order_pairs, "LEXICAL"), (squash_pairs, "LEXICAL"), (acronym_pairs, "LEXICAL"), (containment_pairs, "CONTAINMENT")]
    every = reduce(DataFrame.unionByName, [rule(terms).withColumn("source", F.lit(s)) for rule, s in rules])
    return every.groupBy("a", "b").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.max("score").alias("score"))


# ---------------------------------------------------------------- co-occurrence
def cooccurrence(rows: DataFrame, tokens: str = "tokens", window: int = 5) -> DataFrame:
    """(term, ctx, n): tokens within ``window`` places of each other, by place, in a sentence.
    Narrow until the count: each place sends its own slice."""
    at = rows.select(F.col(tokens).alias("all"), F.posexplode(tokens).alias("pos", "term"))
    left = F.slice("all", F.greatest(F.col("pos") - window, F.lit(0)) + 1, F.least(F.col("pos"), F.lit(window)))
    right = F.slice("all", F.col("pos") + 2, F.lit(window))
    return at.select("term", F.explode(F.concat(left, right)).alias("ctx")).groupBy("term", "ctx").agg(F.count(F.lit(1)).alias("n"))


def ppmi(counts: DataFrame, frequency: DataFrame, min_count: int = 1) -> DataFrame:
    """(term, ctx, weight > 0) of terms found min_count times. Column and grand totals are of those
    terms' rows only; the row total is of all contexts."""
    rows = counts.join(frequency.where(F.col("n") >= min_count).select("term"), "term", "left_semi")
    rows = written(counts.sparkSession)(rows, "counts")  # read four times
    by_row = rows.groupBy("term").agg(F.sum("n").alias("row"))
    by_ctx = rows.groupBy("ctx").agg(F.sum("n").alias("col"))
    total = rows.agg(F.sum("n").alias("total"))  # one row
    joined = rows.join(by_row, "term").join(by_ctx, "ctx").crossJoin(F.broadcast(total))
    weight = F.log(F.col("n").cast("double") * F.col("total") / (F.col("row").cast("double") * F.col("col")) + F.lit(1e-12))
    return joined.select("term", "ctx", weight.alias("weight")).where("weight > 0")


#: Terms that a context may have before it is a heavy one; terms of a heavy context that meet a task's probes at once.
LIGHT, SALT_TERMS = 512, 4096
#: What rounding of sums may hide.
SLACK = 2e-6


def profile_neighbors(weights: DataFrame, top: int = 10, rounded: int = 6, light: int = LIGHT) -> DataFrame:
    """(term, other, similarity, rank) by cosine of sparse profiles, without pairing all terms of a frequent context.

    Weights are positive, so the sum over the light contexts (of ``light`` terms at most) is a lower
    bound of a cosine: the top-th best of them is a term's floor. With h the length of what a profile has in
    heavy contexts, a cosine is at most that sum and h of one end times h of the other. Pairs under
    the floor go. Pairs that share heavy contexts only are looked for from the heaviest weights of a
    term on, as long as what is left can reach its floor, and among other ends whose h can reach it;
    a heavy context's terms are dealt into parts, so no task has all of them. What stays is summed
    exactly."""
    put = written(weights.sparkSession)
    weights = put(weights, "weights")
    norm = weights.groupBy("term").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    sizes = weights.groupBy("ctx").agg(F.count(F.lit(1)).alias("terms"))
    unit = put(weights.join(norm, "term").join(sizes, "ctx").select("term", "ctx", (F.col("weight") / F.col("norm")).alias("u"), "terms"), "unit")
    some, heavy = unit.where(F.col("terms") <= light), unit.where(F.col("terms") > light)
    other = some.select(F.col("term").alias("other"), "ctx", F.col("u").alias("v"))
    shared = some.join(other, "ctx").where("term <> other").groupBy("term", "other").agg(F.sum(F.col("u") * F.col("v")).alias("part"))
    if heavy.isEmpty():
        return top_neighbors(shared.select("term", "other", F.round("part", rounded).alias("similarity")), top)
    shared, heavy = put(shared, "shared"), put(heavy, "heavy")
    best = shared.withColumn("n", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("part")))).where(F.col("n") <= top)
    floors = best.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("floor")).select("term", F.when(F.col("n") >= top, F.col("floor")).otherwise(0.0).alias("floor"))
    lengths = heavy.groupBy("term").agg(F.sqrt(F.sum(F.col("u") ** 2)).alias("h"))
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    ends = put(unit.select("term").distinct().join(floors, "term", "left").join(lengths, "term", "left").select("term", zero("floor"), zero("h")), "ends")
    far = ends.select(F.col("term").alias("other"), F.col("h").alias("g"))
    near = shared.join(ends, "term").join(far, "other").where(F.col("part") + F.col("h") * F.col("g") + SLACK >= F.col("floor")).select("term", "other", "part")
    met = _heavy_pairs(heavy, ends).select("term", "other", F.lit(0.0).alias("part"))
    pairs = put(near.unionByName(met).groupBy("term", "other").agg(F.max("part").alias("part")), "pairs")
    rest = pairs.join(heavy.select("term", "ctx", "u"), "term").join(heavy.select(F.col("term").alias("other"), "ctx", F.col("u").alias("v")), ["other", "ctx"])
    rest = rest.groupBy("term", "other").agg(F.sum(F.col("u") * F.col("v")).alias("rest"))
    total = F.round(F.col("part") + F.coalesce("rest", F.lit(0.0)), rounded).alias("similarity")
    return top_neighbors(pairs.join(rest, ["term", "other"], "left").select("term", "other", total), top)


def _heavy_pairs(heavy: DataFrame, ends: DataFrame) -> DataFrame:
    """(term, other) that share a heavy context and may reach the term's floor by heavy contexts alone."""
    rows = heavy.join(ends, "term")
    tail = Window.partitionBy("term").orderBy("u", F.desc("ctx")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("left", F.sqrt(F.sum(F.col("u") ** 2).over(tail)))  # the length from here on to the lightest
    parts = F.ceil(F.col("terms") / SALT_TERMS).cast("int")
    probes = rows.where(F.col("left") + SLACK >= F.col("floor")).select("term", "ctx", "floor", "h", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    held = rows.select(F.col("term").alias("other"), "ctx", F.col("h").alias("g"), F.pmod(F.xxhash64("term"), parts).cast("int").alias("part"))
    return probes.join(held, ["ctx", "part"]).where((F.col("term") != F.col("other")) & (F.col("h") * F.col("g") + SLACK >= F.col("floor"))).select("term", "other").distinct()


def top_neighbors(pairs: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("term").orderBy(F.desc("similarity"), "other")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def vector_neighbors(vectors: DataFrame, key: str = "term", vector: str = "vector", top: int = 10, block: int = 2048, rounded: int = 6, asked: DataFrame | None = None) -> DataFrame:
    """(term, other, similarity, rank): exact cosine, blocks of terms against blocks of terms.

    A task has a block of terms and reads all blocks one after another (blocks.py), so what is shuffled is the vectors once and
    ``top`` rows for each term. Products are made in short floats first; what can't be among the best by their
    error's bound goes, the rest is scored in doubles. Zero vectors have similarity 0. asked: a table of the terms to answer
    for, if not for all."""
    put = written(vectors.sparkSession)
    rows = vectors.select(F.col(key).alias("term"), F.col(vector).alias("v")).where("term is not null")
    table = put(bl.packed(rows, rows.count(), block, "term"), "blocks")
    queries, parts = table, 1
    if asked is not None:
        own = put(rows.join(asked.select(F.col(asked.columns[0]).alias("term")), "term", "left_semi"), "asked")
        queries = put(bl.packed(own, own.count(), block, "term"), "queries")
        parts = max(1, 2 * vectors.sparkSession.sparkContext.defaultParallelism // max(1, queries.count()))
    scale = 10.0**rounded

    def look(a: bl.Block, b: bl.Block, best: bl.Best) -> None:
        slack = 0.5 / scale + (a.unit.shape[1] + 8) * 2.0**-23  # of rounding, and of sums in short floats
        same_row, same_col = bl.own_places(a, b)
        for k in range(0, len(a.terms), bl.STRIP):
            own = slice(*np.searchsorted(same_row, [k, k + bl.STRIP]))
            s = a.short[k : k + bl.STRIP] @ b.short.T
            s[same_row[own] - k, same_col[own]] = -np.inf
            row, col, many = bl.hits_in(s >= (best.score[k : k + bl.STRIP, -1:] - slack).astype(np.float32))
            score = np.rint(bl.dots(a.unit, b.unit, row + k, col) * scale) / scale
            score[s[row, col] == -np.inf] = -np.inf
            if many.size:
                whole = np.rint(a.unit[many + k] @ b.unit.T * scale)
                whole[s[many] == -np.inf] = -np.inf
                n = min(top, whole.shape[1])
                at = np.argpartition(np.arange(whole.shape[1]) - whole * whole.shape[1], n - 1, axis=1)[:, :n]  # of equal ones the first
                row, col = np.concatenate([row, np.repeat(many, n)]), np.concatenate([col, at.ravel()])
                score = np.concatenate([score, np.take_along_axis(whole, at, axis=1).ravel() / scale])
            row = row + k
            good = np.isfinite(score) & best.enters(row, score, b.no[col])
            if good.any():
                best.add(row[good], score[good], b.no[col[good]], b.terms[col[good]])

    def told(best: bl.Best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, place = np.nonzero(np.isfinite(best.score))
        return row, best.more[0][row, place], best.score[row, place]

    return top_neighbors(bl.swept(table, queries, lambda a: bl.Best(len(a.terms), top, a.terms.dtype), look, told, parts), top)


# ---------------------------------------------------------------- neighbours to pairs
def valid_neighbors(neighbors: DataFrame, terms: DataFrame, min_frequency: int = 1) -> DataFrame:
    """Neighbours whose other end is an eligible term of the catalogue, frequent enough and no other
    spelling of the same; ranks are counted anew."""
    good = terms.where((F.col("frequency") >= min_frequency) & (F.col("excluded_reason") == "")).select(F.col("term").alias("other"))
    bare = lambda c: F.replace(c, F.lit("_"), F.lit(""))
    kept = neighbors.drop("rank").where((F.col("term") != F.col("other")) & (bare(F.col("term")) != bare(F.col("other")))).join(good, "other", "left_semi")
    w = Window.partitionBy("term").orderBy(F.desc("similarity"), "other")
    return kept.withColumn("rank", F.row_number().over(w))


def neighbor_pairs(neighbors: DataFrame, source: str, min_similarity: float) -> DataFrame:
    """Directed neighbours as rows of fuse(): canonical pair, source, similarity and rank of a direction."""
    a, b = F.least("term", "other"), F.greatest("term", "other")
    forth = F.col("term") == a
    return neighbors.where(F.col("similarity") >= min_similarity).select(a.alias("a"), b.alias("b"), F.lit(source).alias("source"), F.when(F.lit(source == "FASTTEXT"), F.col("similarity")).alias("similarity"), F.lit(None).cast("double").alias("lexical"), F.lit(None).cast("double").alias("llm"), F.when(forth, F.col("rank")).alias("rank_ab"), F.when(~forth, F.col("rank")).alias("rank_ba"))


def passes_rank(rank_ab: Column, rank_ba: Column, mutual: int, strong: int) -> Column:
    """Both ranks within ``mutual``, or the better one within ``strong``."""
    both = F.coalesce((rank_ab <= mutual) & (rank_ba <= mutual), F.lit(False))
    return both | (F.least(rank_ab, rank_ba) <= strong)


def mutual_pairs(rows: DataFrame, mutual: int, strong: int) -> DataFrame:
    """Rows of neighbor_pairs whose pair's ranks pass."""
    ranks = rows.groupBy("a", "b").agg(F.min("rank_ab").alias("ab"), F.min("rank_ba").alias("ba")).where(passes_rank(F.col("ab"), F.col("ba"), mutual, strong))
    return rows.join(ranks.select("a", "b"), ["a", "b"], "left_semi")


def scored_pairs(pairs: DataFrame, source: str, column: str) -> DataFrame:
    """(a, b, score) as rows of fuse(): column is lexical or llm."""
    none = F.lit(None).cast("double")
    values = {"lexical": none, "llm": none} | {column: F.col("score").cast("double")}
    return pairs.select("a", "b", F.lit(source).alias("source"), none.alias("similarity"), values["lexical"].alias("lexical"), values["llm"].alias("llm"), F.lit(None).cast("int").alias("rank_ab"), F.lit(None).cast("int").alias("rank_ba"))


def fuse(paths: Sequence[DataFrame]) -> DataFrame:
    """One row for each pair: all sources, best scores, best rank of each direction, priority."""
    every = reduce(DataFrame.unionByName, paths)
    zero = lambda c: F.coalesce(F.max(c), F.lit(0.0))
    pairs = every.groupBy("a", "b").agg(F.array_sort(F.collect_set("source")).alias("sources"), zero("similarity").alias("similarity"), zero("lexical").alias("lexical"), zero("llm").alias("llm"), F.min("rank_ab").alias("rank_ab"), F.min("rank_ba").alias("rank_ba"))
    return pairs.withColumn("priority", priority())


def priority() -> Column:
    llm, lex, rank, sim, both, more = map(F.lit, WEIGHTS)
    ab, ba = F.col("rank_ab"), F.col("rank_ba")
    ranks = (F.coalesce(1 / ab, F.lit(0.0)) + F.coalesce(1 / ba, F.lit(0.0))) / 2
    two = F.when(ab.isNotNull() & ba.isNotNull(), both).otherwise(0.0)
    return F.round(llm * F.col("llm") + lex * F.col("lexical") + rank * ranks + sim * F.col("similarity") + two + more * (F.size("sources") - 1), 6)


def corroborated(pairs: DataFrame) -> DataFrame:
    """Pairs with a source that isn't distributional."""
    return pairs.where(F.size(F.array_except("sources", F.array(*map(F.lit, DISTRIBUTIONAL)))) > 0)


def without_excluded(pairs: DataFrame, excluded: DataFrame) -> DataFrame:
    """excluded: (pair_key)."""
    return pairs.withColumn("pair_key", tx.pair_key(F.col("a"), F.col("b"))).join(excluded.select("pair_key"), "pair_key", "left_anti")


def source_counts(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode("sources").alias("source")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def top_pairs(pairs: DataFrame, limit: int) -> DataFrame:
    """The feature is the limit: the best pairs of all."""
    return pairs.orderBy(F.desc("priority"), "a", "b").limit(limit)


def most_frequent(terms: DataFrame, most: int) -> DataFrame:
    """(term) of the most frequent eligible terms."""
    return terms.where("excluded_reason = ''").orderBy(F.desc("frequency"), "term").limit(most).select("term")


def probe(terms: DataFrame, neighbors: DataFrame, most: int = 400, top: int = 10) -> DataFrame:
    """(term, other, similarity, rank): the nearest eligible neighbours of the most frequent eligible terms,
    for looking at how similarities are spread. The limits are the feature. Neighbours of other terms aren't needed."""
    good = terms.where("excluded_reason = ''")
    first = most_frequent(terms, most)
    return neighbors.where(F.col("rank") <= top).join(first, "term", "left_semi").join(good.select(F.col("term").alias("other")), "other", "left_semi").select("term", "other", "similarity", "rank")


#: Pairs that one task scans at the end of degree_capped, at most.
SCANNED = 1 << 20


def degree_capped(pairs: DataFrame, cap: int, put, score: str = "priority", scanned: int = SCANNED) -> DataFrame:
    """What a scan from the best pair down accepts, if no end may have more than ``cap`` pairs.

    In rounds: a pair whose rank is within the capacity left at both ends must be accepted by
    the scan, for fewer better pairs than places are left at either; then capacities fall and pairs at full
    ends go. Each round accepts the best pair left at least, mostly far more. When no more than ``scanned`` pairs
    are left, one task scans them, so a chain of pairs that each wait for the one before takes no round
    for each. ``put(df, name)`` writes a round's tables."""
    if cap <= 0:
        return pairs
    order = (F.desc(score), F.col("a"), F.col("b"))
    rest = put(pairs.select("a", "b", score, F.lit(cap).alias("left_a"), F.lit(cap).alias("left_b")), "rest0")
    taken, step = [], 0
    while (n := rest.count()) > scanned:
        step += 1
        ends = rest.select("a", "b", score, F.explode(F.array(F.struct(F.col("a").alias("end"), F.col("left_a").alias("left")), F.struct(F.col("b").alias("end"), F.col("left_b").alias("left")))).alias("e")).select("a", "b", score, "e.end", "e.left")
        ranked = ends.withColumn("ok", F.row_number().over(Window.partitionBy("end").orderBy(*order)) <= F.col("left"))
        good = put(ranked.groupBy("a", "b", score).agg(F.bool_and("ok").alias("ok")).where("ok").select("a", "b"), f"taken{step}")
        taken.append(good)
        used = good.select(F.explode(F.array("a", "b")).alias("end")).groupBy("end").agg(F.count(F.lit(1)).cast("int").alias("used"))
        rest = rest.join(good, ["a", "b"], "left_anti")
        for side in ("a", "b"):
            own = used.select(F.col("end").alias(side), F.col("used").alias(f"used_{side}"))
            rest = rest.join(own, side, "left").withColumn(f"left_{side}", F.col(f"left_{side}") - F.coalesce(f"used_{side}", F.lit(0))).drop(f"used_{side}")
        rest = put(rest.where("left_a > 0 and left_b > 0").select("a", "b", score, "left_a", "left_b"), f"rest{step}")
    if n:
        taken.append(put(_scanned(rest.repartition(1).sortWithinPartitions(*order)), "scanned"))
    if not taken:
        return pairs.limit(0)
    return pairs.join(reduce(DataFrame.union, taken), ["a", "b"], "left_semi")


def _scanned(rest: DataFrame) -> DataFrame:
    """(a, b) that a scan in the rows' order accepts; rows: (a, b, ..., left_a, left_b), in one partition."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left: dict[object, int] = {}
        for f in frames:
            keep = []
            for a, b, of_a, of_b in zip(f["a"], f["b"], f["left_a"], f["left_b"], strict=True):
                x, y = left.setdefault(a, of_a), left.setdefault(b, of_b)
                keep.append(x > 0 and y > 0)
                if keep[-1]:
                    left[a] -= 1
                    left[b] -= 1
            yield f.loc[keep, ["a", "b"]]

    kinds = dict(rest.dtypes)
    return rest.mapInPandas(scan, f"a {kinds['a']}, b {kinds['b']}")
