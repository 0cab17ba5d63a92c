"""Vector models of terms: factors of the PPMI table, and vectors of character n-grams for spelling.

A model is a table (term, vector); candidates.vector_neighbors makes neighbours of it.

The factors are a truncated singular value decomposition by block power iteration. The
table of weights stays a table: a product with it is a join and a grouped sum of
``size`` columns. The driver sees only size x size matrices (inner products of columns),
from which it makes the factors that orthogonalise a block, and the rotation at the end.
The start is a hash of the contexts and a seed, so that a model can be made again.

An n-gram's vector is the mean of those of the terms that have it, weighed by the root of
their frequency; a term's is its own and the mean of its n-grams. A term that the model
doesn't know has the latter only, so a new spelling lies near the known ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.session import written


def start_vector(key: Column, size: int, seed: int) -> Column:
    """Numbers from -1 to 1 by a hash of the key and the place."""
    number = lambda k: F.pmod(F.xxhash64(key, F.lit(seed), k), F.lit(1 << 20)).cast("double") / (1 << 19) - 1
    return F.transform(F.sequence(F.lit(1), F.lit(size)), number)


def _summed(rows: DataFrame, key: str, weight: Column, size: int) -> DataFrame:
    """(key, v): weighted sums of vectors ``v`` by key, summed in tasks first."""
    each = rows.select(key, *[(weight * F.get("v", F.lit(k))).alias(f"v{k}") for k in range(size)])
    return each.groupBy(key).agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(size)]).select(key, F.array(*[f"v{k}" for k in range(size)]).alias("v"))


def inner_products(rows: DataFrame, size: int) -> np.ndarray:
    """The size x size inner products of the columns of ``v``: each task sums its own rows."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((size, size))
        for b in batches:
            m = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            out += m.T @ m
        i, j = np.divmod(np.arange(size * size), size)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(out.ravel())], ["i", "j", "x"])

    out = np.zeros((size, size))
    for r in rows.select("v").mapInArrow(part, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        out[r["i"], r["j"]] = r["x"]
    return out


def multiplied(rows: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """(key, v) with v times a matrix."""

    @F.arrow_udf("array<double>")
    def times(v: pa.Array) -> pa.Array:
        m = v.flatten().to_numpy(zero_copy_only=False).reshape(-1, matrix.shape[0]) @ matrix
        return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, matrix.shape[1]), pa.int32()), pa.array(m.ravel()))

    return rows.select(key, times("v").alias("v"))


def orthogonal(rows: DataFrame, key: str, size: int, put: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """The same span with orthogonal columns of length 1; columns that depend on others become 0."""
    rows = put(rows, name)
    values, turn = np.linalg.eigh(inner_products(rows, size))
    keep = values > 1e-10 * max(values.max(), 1e-300)
    return multiplied(rows, key, turn * np.where(keep, 1 / np.sqrt(np.where(keep, values, 1)), 0))


def factors(weights: DataFrame, size: int = 32, more: int = 8, rounds: int = 3, power: float = 0.5, seed: int = 42) -> DataFrame:
    """(term, vector) of weights (term, ctx, weight): the terms' ``size`` first left singular vectors, times
    the singular values to ``power``. ``more`` columns are carried along, which makes few rounds enough."""
    put, wide = written(weights.sparkSession), size + more
    weights = put(weights.select("term", "ctx", "weight"), "weights")
    block = weights.select("ctx").distinct().select("ctx", start_vector(F.col("ctx"), wide, seed).alias("v"))
    for k in range(rounds):
        left = orthogonal(_summed(weights.join(block, "ctx"), "term", F.col("weight"), wide), "term", wide, put, f"left{k}")
        block = put(_summed(weights.join(left, "term"), "ctx", F.col("weight"), wide), f"right{k}")
        if k < rounds - 1:
            block = orthogonal(block, "ctx", wide, put, f"even{k}")
    values, turn = np.linalg.eigh(inner_products(block, wide))  # of the table seen from the left block
    first = np.argsort(-values)[:size]
    single = np.sqrt(np.maximum(values[first], 0))
    return multiplied(left, "term", turn[:, first] * np.where(single > 0, single, 1) ** power * (single > 0)).withColumnRenamed("v", "vector")


def grams(term: Column, shortest: int, longest: int) -> Column:
    """The distinct character n-grams of a term between marks for its ends."""
    marked = F.concat(F.lit("<"), F.lower(term), F.lit(">"))
    cut = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))), lambda i: F.substr(marked, i, n))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(shortest), F.lit(longest)), cut)))


def with_subwords(vectors: DataFrame, terms: DataFrame, shortest: int = 3, longest: int = 5, share: float = 0.5) -> DataFrame:
    """(term, vector) of all ``terms`` (term, frequency): the model's vector and the mean of its n-grams', each brought
    to length 1, the latter times ``share``. A term without either has a vector of zeros."""
    put = written(vectors.sparkSession)
    vectors = put(vectors.select("term", F.col("vector").alias("v")), "vectors")
    one = vectors.first()
    size = len(one["v"]) if one else 0
    zeros = F.array_repeat(F.lit(0.0), size)
    if not size:
        return terms.select("term", zeros.alias("vector"))
    cut = put(terms.select("term", F.sqrt(F.col("frequency").cast("double")).alias("w"), F.explode(grams(F.col("term"), shortest, longest)).alias("gram")), "grams")
    by_gram = _summed(cut.join(vectors, "term"), "gram", F.col("w"), size)
    mean = cut.join(vectors.select("term"), "term", "left_semi").groupBy("gram").agg(F.sum("w").alias("n")).join(by_gram, "gram")
    spelled = _summed(cut.join(mean.select("gram", F.transform("v", lambda x: x / F.col("n")).alias("v")), "gram"), "term", F.lit(1.0), size)
    length = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    even = lambda c: F.when(length(c) > 0, F.transform(c, lambda x: x / length(c))).otherwise(zeros)
    both = terms.select("term").join(vectors.select("term", even(F.col("v")).alias("own")), "term", "left").join(spelled.select("term", even(F.col("v")).alias("gram")), "term", "left")
    return both.select("term", F.zip_with(F.coalesce("own", zeros), F.coalesce("gram", zeros), lambda a, b: a + share * b).alias("vector"))


def no_neighbors(terms: DataFrame) -> DataFrame:
    """The neighbours of no model at all."""
    return terms.select("term", F.col("term").alias("other"), F.lit(0.0).alias("similarity"), F.lit(1).alias("rank")).limit(0)
