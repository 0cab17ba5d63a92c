"""A sentence splitter that learns from the texts which words with a full stop don't end a sentence.

Two counts over all texts, summed by grouped aggregation, are all it takes (Kiss and Strunk 2006): an
abbreviation is a word that nearly always has its full stop (log-likelihood ratio against the usual
share), short words and words with inner full stops more so; a starter is a word found behind
sentence ends more often than elsewhere. A piece that ends in an abbreviation is put back to the
next one, unless a starter with a capital begins that. Everything is column expressions.

Bounds: ``most`` abbreviations and starters, by score, go into the plan as sets.

Cases: null and empty texts have no words; words are compared in lower case; only words of
letters and inner full stops can be either; equal scores are ordered by the word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions import text as tx

#: Fixed values of the method: the share of full stops that an abbreviation has, and both thresholds.
ALWAYS, LEAST_ABBREVIATION, LEAST_STARTER = 0.99, 0.3, 30.0
WORD, ENDED = r"^\p{L}+(\.\p{L}+)*\.?$", r"[.!?…]$"


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: x != "")


def abbreviation_scores(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n, stopped, score) of the words that have a full stop behind them at times, without it."""
    each = docs.select(F.explode(_tokens(F.col(text_col))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))  # summed by token first
    each = each.select(F.lower(F.regexp_replace("t", r"\.$", "")).alias("word"), F.endswith("t", F.lit(".")).alias("stop"), "n", F.regexp_like("t", F.lit(WORD)).alias("fine"))
    totals = each.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("stop"), F.col("n")).otherwise(0)).alias("stops"))  # one row
    words = each.where("fine").groupBy("word").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("stop"), F.col("n")).otherwise(0)).alias("stopped")).where("stopped > 0 and word <> ''")
    usual, open_ = F.col("stops") / F.col("all"), F.col("n") - F.col("stopped")
    log = lambda p: F.log(F.greatest(p, F.lit(1e-12)))
    plain = F.col("stopped") * log(usual) + open_ * log(1 - usual)
    always = F.col("stopped") * log(F.lit(ALWAYS)) + open_ * log(F.lit(1 - ALWAYS))
    inner = F.length(F.regexp_replace("word", r"[^.]", ""))
    length = F.length("word") - inner
    score = -2 * (plain - always) * F.exp(-length.cast("double")) * (inner + 1) * F.pow(length.cast("double"), -open_.cast("double"))
    return words.crossJoin(F.broadcast(totals)).select("word", "n", "stopped", score.alias("score"))


def starter_scores(docs: DataFrame, abbreviations: Sequence[str], text_col: str = "text") -> DataFrame:
    """(word, n, started, score) of words behind sentence ends that are no abbreviations."""
    tokens = _tokens(F.col(text_col))
    pairs = F.transform(tokens, lambda x, i: F.struct(x.alias("t"), F.get(tokens, i - 1).alias("before")))
    each = docs.select(F.explode(pairs).alias("p")).select("p.t", (F.regexp_like("p.before", F.lit(ENDED)) & ~_is_abbreviation(F.col("p.before"), abbreviations)).alias("ended"))
    each = each.select(F.lower(F.regexp_replace("t", r"[.,;:!?…]+$", "")).alias("word"), F.coalesce("ended", F.lit(False)).alias("ended")).groupBy("word", "ended").agg(F.count(F.lit(1)).alias("n"))
    started = F.sum(F.when(F.col("ended"), F.col("n")).otherwise(0))
    totals = each.agg(F.sum("n").alias("all"), started.alias("ends"))
    words = each.groupBy("word").agg(F.sum("n").alias("n"), started.alias("started")).where(F.regexp_like("word", F.lit(WORD)) & (F.col("started") > 0))
    log = lambda k, n, p: k * F.log(F.greatest(p, F.lit(1e-12))) + (n - k) * F.log(F.greatest(1 - p, F.lit(1e-12)))
    k, n, rest, others = F.col("started"), F.col("ends"), F.col("n") - F.col("started"), F.col("all") - F.col("ends")
    usual, first, second = F.col("n") / F.col("all"), k / n, rest / F.greatest(others, F.lit(1))
    score = 2 * (log(k, n, first) + log(rest, others, second) - log(k, n, usual) - log(rest, others, usual))
    return words.crossJoin(F.broadcast(totals)).where(first > usual).select("word", "n", "started", score.alias("score"))


def trained(docs: DataFrame, text_col: str = "text", most: int = 2000) -> tuple[list[str], list[str]]:
    """(abbreviations, starters) of texts."""
    best = lambda rows, least: [r["word"] for r in rows.where(F.col("score") >= least).orderBy(F.desc("score"), "word").limit(most).collect()]
    short = best(abbreviation_scores(docs, text_col), LEAST_ABBREVIATION)
    return short, best(starter_scores(docs, short, text_col), LEAST_STARTER)


def _is_abbreviation(token: Column, abbreviations: Sequence[str]) -> Column:
    if not abbreviations:
        return F.lit(False)
    bare = F.lower(F.regexp_replace(token, r"^[^\p{L}]+", ""))
    return F.endswith(bare, F.lit(".")) & F.regexp_replace(bare, r"\.$", "").isin(*abbreviations)


def split_trained(text: Column, abbreviations: Sequence[str], starters: Sequence[str] = (), min_length: int = 4, max_length: int = 400) -> Column:
    """The valid sentences of a line of text, as text.split_sentences, by learned words."""

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        first = F.split_part(x, F.lit(" "), F.lit(1))
        plain = F.lower(F.regexp_replace(first, r"[^\p{L}]+$", ""))
        begins = plain.isin(*starters) & F.regexp_like(first, F.lit(r"^\p{Lu}")) if starters else F.lit(False)
        joins = _is_abbreviation(F.regexp_extract(last, r"(\S+)$", 1), abbreviations) & ~begins
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.concat_ws(" ", last, x)))
        return F.when((F.size(acc) > 0) & joins, joined).otherwise(F.concat(acc, F.array(x)))

    return tx.split_sentences(text, min_length, max_length, lambda pieces: F.aggregate(pieces, F.array().cast("array<string>"), step))
