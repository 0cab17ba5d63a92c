"""Nearest vectors by an index: k-means cells, product-quantised residuals, exact re-ranking.

The index is fitted on a bounded sample (``sample`` vectors, by a hash of their key) and holds
every vector: a row has its cell and a code of ``parts`` bytes for what the cell's centre
leaves. A query looks into its ``probes`` nearest cells, scores their rows by its inner products
with what their codes stand for, keeps the best ``kept`` of all of them, and scores
those exactly from the vectors themselves. So an answer's similarity is exact; only who is
among the answers is approximate, and recall is measured against the exact way.

The index is a table of blocks of a bounded number of rows, by cell, so one large cell is many blocks.
A task has a block of queries and reads the index block by block (blocks.py); vectors stand beside
their codes, so what comes among a query's best is scored exactly where it is found. What is sent on is
``top`` rows for each query, whatever the number of cells that it looks into.

Cases: vectors that are null, empty or hold a null or a component that isn't finite have no
neighbours and are none; vectors of another length than most of the sample are left out of
the index the same way; zero vectors have similarity 0; keys are unique; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.operators import blocks as bl
from lexiloom.operators.candidates import top_neighbors
from lexiloom.session import written

#: Rows of a block at most, on average; code words of a part; rounds of k-means; points that are held against all centres at once.
PART_ROWS, WORDS, ROUNDS, SLICE = 8192, 256, 8, 1024


def k_means(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of points by Lloyd's rounds; a centre that loses all its points takes the farthest one."""
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        at, far = nearest(points, centres)
        size = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, points)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        lonely = np.flatnonzero(size == 0)
        if lonely.size:
            rest = far + (points * points).sum(axis=1)
            centres[lonely] = points[np.argsort(-rest, kind="stable")[: lonely.size]]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the nearest centre of each point, its squared distance less the point's own square)."""
    at, far = np.zeros(len(points), int), np.zeros(len(points))
    for k in range(0, len(points), SLICE):
        own = (centres * centres).sum(axis=1) - 2 * points[k : k + SLICE] @ centres.T
        at[k : k + SLICE], far[k : k + SLICE] = own.argmin(axis=1), own.min(axis=1)
    return at, far


class Quantiser:
    """Centres of cells, and code words of the parts of residuals."""

    def __init__(self, points: np.ndarray, cells: int, parts: int, seed: int):
        rng = np.random.default_rng(seed)
        self.dims = points.shape[1]
        self.centres = k_means(points, cells, rng)
        self.edges = np.linspace(0, self.dims, min(parts, self.dims) + 1).astype(int)
        rest = points - self.centres[nearest(points, self.centres)[0]]
        self.words = [k_means(rest[:, a:b], WORDS, rng) for a, b in zip(self.edges[:-1], self.edges[1:], strict=True)]

    def probed(self, points: np.ndarray, n: int) -> np.ndarray:
        """Whether a cell (column) is among the n nearest of a point (row)."""
        out = np.zeros((len(points), len(self.centres)), bool)
        for k in range(0, len(points), SLICE):
            far = (self.centres * self.centres).sum(axis=1) - 2 * points[k : k + SLICE] @ self.centres.T
            np.put_along_axis(out[k : k + SLICE], np.argsort(far, axis=1, kind="stable")[:, :n], True, axis=1)
        return out

    def codes(self, points: np.ndarray, cells: np.ndarray) -> np.ndarray:
        rest = points - self.centres[cells]
        out = np.zeros((len(points), len(self.words)), np.uint8)
        for k, (a, words) in enumerate(zip(self.edges, self.words, strict=False)):
            out[:, k] = nearest(rest[:, a : a + words.shape[1]], words)[0]
        return out

    def decoded(self, cells: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What codes stand for: an inner product with it is the sum of those with the cell's centre and the code words."""
        out = self.centres[cells]
        for k, (a, words) in enumerate(zip(self.edges, self.words, strict=False)):
            out[:, a : a + words.shape[1]] += words[codes[:, k]]
        return out


def unit_rows(column: pa.Array | pd.Series) -> np.ndarray:
    m = np.array(column.to_pylist() if isinstance(column, pa.Array) else column.tolist(), float)
    m = m.reshape(len(column), -1)
    size = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(size == 0, 1, size)


def indexed_neighbors(
    vectors: DataFrame, key: str = "term", vector: str = "vector", top: int = 10, cells: int | None = None, probes: int | None = None, parts: int = 32,
    kept: int | None = None, sample: int = 32_768, seed: int = 42, rounded: int = 6,
) -> DataFrame:
    """(term, other, similarity, rank) by cosine, as candidates.vector_neighbors, from an index.

    cells: by the root of the number of vectors, if not given; probes: half of the cells up to 16 of them, which
    vectors without any structure need (clustered ones need a few); kept: 10 * top."""
    spark, kind = vectors.sparkSession, dict(vectors.dtypes)[key]
    put = written(spark)
    v = F.col(vector) if dict(vectors.dtypes)[vector] == "array<float>" else F.col(vector).cast("array<double>")
    fine = F.coalesce(F.size(v) > 0, F.lit(False)) & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = put(vectors.select(F.col(key).alias("term"), v.alias("v")).where(fine & F.col("term").isNotNull()), "vectors")
    none = rows.select("term", F.col("term").alias("other"), F.lit(0.0).alias("similarity"), F.lit(1).alias("rank")).limit(0)
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").first()
    if lengths is None:
        return none
    rows = rows.where(F.size("v") == lengths["dims"])
    first = rows.orderBy(F.xxhash64("term", F.lit(seed)), "term").limit(sample).select("v").toPandas()
    cells = cells or max(1, min(4096, round(lengths["n"] ** 0.5)))
    probes, kept = probes or max(1, min(cells, max(16, cells // 2))), kept or 10 * top
    told = Quantiser(unit_rows(first["v"]), cells, parts, seed)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                points = unit_rows(b.column(1))
                cell = nearest(points, told.centres)[0]
                codes = told.codes(points, cell)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes])], ["term", "v", "cell", "code"])

    placed = rows.mapInArrow(place, f"term {kind}, v {dict(rows.dtypes)['v']}, cell int, code binary")
    index = put(bl.packed(placed, lengths["n"], PART_ROWS, "cell", "term"), "index")

    def began(a: bl.Block) -> bl.Best:
        a.probed = told.probed(a.unit, probes)
        return bl.Best(len(a.terms), kept, a.terms.dtype, float)

    def look(a: bl.Block, b: bl.Block, best: bl.Best) -> None:
        if not hasattr(b, "decoded"):
            cell = b.columns["cell"]
            b.decoded = told.decoded(cell, np.stack([np.frombuffer(c, np.uint8) for c in b.columns["code"]])).astype(np.float32)
            b.cells = np.split(np.arange(cell.size), np.flatnonzero(np.diff(cell)) + 1)
        for k in range(0, len(a.terms), bl.STRIP):
            found = []
            for places in b.cells:
                own = k + np.flatnonzero(a.probed[k : k + bl.STRIP, b.columns["cell"][places[0]]])
                s = a.short[own] @ b.decoded[places].T
                row, col, many = bl.hits_in(s >= best.score[own, -1:].astype(np.float32))
                if many.size:
                    n = min(kept + 1, s.shape[1])  # the query itself may be one
                    at = np.argpartition(-s[many], n - 1, axis=1)[:, :n]
                    row, col = np.concatenate([row, np.repeat(many, n)]), np.concatenate([col, at.ravel()])
                found.append((own[row], places[col], s[row, col].astype(float)))
            row, col, score = map(np.concatenate, zip(*found, strict=True))
            good = best.enters(row, score, b.no[col]) & (a.terms[row] != b.terms[col])
            if good.any():
                row, col, score = row[good], col[good], score[good]
                best.add(row, score, b.no[col], b.terms[col], np.round(bl.dots(a.unit, b.unit, row, col), rounded))

    def best_of(best: bl.Best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, place = np.nonzero(np.isfinite(best.score))
        other, similarity = (x[row, place] for x in best.more)
        order = pd.DataFrame({"row": row, "less": -similarity, "other": other}).sort_values(["row", "less", "other"], kind="stable")
        at = order.groupby("row", sort=False).head(top).index.to_numpy()
        return row[at], other[at], similarity[at]

    return top_neighbors(bl.swept(index, index, began, look, best_of), top)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (asked, hits, recall): how many of a term's exact neighbours the found ones are worth. A found one
    counts if it is as similar as the last of the exact ones, so ties count."""
    last = exact.groupBy("term").agg(F.min("similarity").alias("least"), F.count(F.lit(1)).alias("n"))
    own = found.select("term", F.col("similarity").alias("s"))
    hits = last.join(own, "term", "left").groupBy("term", "n").agg(F.count_if(F.col("s") >= F.col("least")).alias("hits"))
    out = hits.agg(F.sum("n").alias("asked"), F.sum(F.least("hits", "n")).alias("hits"))
    return out.withColumn("recall", F.round(F.try_divide("hits", "asked"), 4))


def overlap(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (asked, hits, recall): how many of the exact neighbours are among the found ones."""
    both = exact.select("term", "other").join(found.select("term", "other", F.lit(1).alias("hit")), ["term", "other"], "left")
    return both.agg(F.count(F.lit(1)).alias("asked"), F.count("hit").alias("hits")).withColumn("recall", F.round(F.try_divide("hits", "asked"), 4))
