"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

A vector's components become integers, floor(``scale`` * x). Vectors are held in shards of
``SHARD``; for every dimension a shard has posting segments: the vectors whose component
falls in one of ``LEVELS`` ranges of impact, with the range's ends. The index is a written
table with one row for each shard.

A query's own order of a shard's segments is by falling contribution, component times
impact, counted from the dimension's least so that it is never negative. Segments are
processed in rounds. A vector that the processed segments don't name in a dimension can
get the next segment's contribution there at most, so after each round there is an upper
bound for every vector. Vectors whose bound is under the k-th best exact score so far can't
be among the answers. When few others are left, or all segments are done, those are scored
exactly; that is the only end of a search. The k-th best score goes with the query from
shard to shard.

Queries stand against all shards in a grid of cells: a cell has some shards and some
blocks of queries, reads the queries first and the shards one by one, and gives the
k best of each query. A window ranks what the cells give. A cell's memory is bounded by
CELL_BLOCKS and one shard; the size of a shard's row is bounded by SHARD.

Arithmetic: exact scores are sums in doubles where no sum can pass 2^53, else integers
of any size; bounds have a slack for rounding.

Cases: vectors that are null or hold a null or a component that isn't finite (also after
scaling) take no part; vectors of another length count as if filled up with zeros, so an empty one
scores 0; scores beyond a long stand at its end; a row without an id is a candidate
(smaller than all ids in ties) and no query; rows with one id are rows of their own, so each is
a query and a candidate of the others; with fewer candidates than k all are answers; an
empty table, or one without a query, gives an empty result; further columns don't
matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.store import Shelf, small_batches

#: Vectors of a shard, its levels of impact, queries of a block, blocks of a cell and shards of a cell at most.
SHARD, LEVELS, BLOCK, CELL_BLOCKS, CELL_SHARDS = 2048, 16, 512, 16, 32
#: Rounds in which a query goes through a shard's postings, and the share of a shard that is scored rather than bounded on.
ROUNDS, FEW = 12, 32
#: Bytes of one Arrow batch at most, for rows are as large as shards.
BATCH_BYTES = 1 << 25
#: Doubles are exact up to here, longs up to here.
EXACT, LONG = 1 << 53, (1 << 63) - 1

PACKED = "block long, dims int, ids binary, known binary, vectors binary, places binary"
CELLED = f"cell long, kind int, {PACKED}"
FOUND = "query long, query_id long, vec_id long, score long"


def integers(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(places of the vectors that take part, their integers as doubles, filled up with zeros)."""
    lengths = np.array([-1 if n is None else n for n in pc.list_value_length(vectors).to_pylist()], np.int64)
    flat = vectors.flatten()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    values = np.floor(flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) * scale)
    owner = np.repeat(np.arange(lengths.size), np.maximum(lengths, 0))
    bad = np.zeros(lengths.size, bool)
    bad[owner[~known | ~np.isfinite(values)]] = True
    out = np.zeros((lengths.size, max(lengths.max(initial=0), 0)))
    start = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    out[owner, np.arange(values.size) - start[owner]] = np.where(known & np.isfinite(values), values, 0)
    take = np.flatnonzero((lengths >= 0) & ~bad)
    return take, out[take]


class Block:
    """Some vectors as a row of PACKED: a shard, or a block of queries."""

    def __init__(self, block: int, ids: np.ndarray, known: np.ndarray, vectors: np.ndarray, places: np.ndarray):
        self.block, self.ids, self.known, self.vectors, self.places = block, ids, known, vectors, places

    def row(self) -> list:
        parts = (self.ids.astype(np.int64), self.known.astype(bool), self.vectors.astype(float), self.places.astype(np.int64))
        return [self.block, self.vectors.shape[1], *(np.ascontiguousarray(p).tobytes() for p in parts)]

    @classmethod
    def of(cls, row: dict) -> Block:
        ids = np.frombuffer(row["ids"], np.int64)
        vectors = np.frombuffer(row["vectors"], float).reshape(ids.size, row["dims"])
        return cls(row["block"], ids, np.frombuffer(row["known"], bool), vectors, np.frombuffer(row["places"], np.int64))

    def widened(self, dims: int) -> np.ndarray:
        return np.pad(self.vectors, ((0, 0), (0, max(0, dims - self.vectors.shape[1]))))


def exact_scores(query: np.ndarray, vectors: np.ndarray, safe: bool) -> list[int]:
    if safe:
        return (vectors @ query).astype(np.int64).tolist()
    q = [int(x) for x in query]
    return [sum(a * int(b) for a, b in zip(q, v, strict=True)) for v in vectors]


class Shard:
    """A shard's posting segments: per dimension the vectors by rising component, cut into levels of impact."""

    def __init__(self, block: Block, dims: int):
        self.block = block
        self.vectors = block.widened(dims)
        n, self.dims = self.vectors.shape
        columns = self.vectors.T
        low, high = columns.min(axis=1, keepdims=True), columns.max(axis=1, keepdims=True)
        width = np.maximum(high - low, 1) / LEVELS
        level = np.minimum((columns - low) // width, LEVELS - 1).astype(np.int64)
        self.postings = np.argsort(columns, axis=1, kind="stable")
        level = np.take_along_axis(level, self.postings, axis=1)
        values = np.take_along_axis(columns, self.postings, axis=1)
        self.postings = self.postings.ravel()
        change = np.ones(level.shape, bool)
        change[:, 1:] = level[:, 1:] != level[:, :-1]
        self.start = np.flatnonzero(change.ravel())
        self.stop = np.append(self.start[1:], level.size)
        self.dim = self.start // n
        values = values.ravel()
        self.low, self.high = values[self.start], values[self.stop - 1]
        self.first = np.searchsorted(self.dim, np.arange(self.dims))
        self.largest = np.abs(columns).max(axis=1, initial=0)

    def search(self, query: np.ndarray, k: int, own: int, best: list[int]) -> tuple[list[int], list[int]]:
        """(places, exact scores) of the vectors that may be among the k best, given the best scores so far
        (falling, k at most). own: the query's own place here, or -1."""
        n = self.vectors.shape[0]
        with np.errstate(over="ignore"):
            scale = float(np.abs(query) @ self.largest)
        safe = scale < EXACT
        if not self.dims or not np.isfinite(scale):  # nothing to bound, or no double can: all are scored
            places = np.delete(np.arange(n), [own] if own >= 0 else [])
            return places.tolist(), exact_scores(query, self.vectors[places], safe)
        most = np.maximum(query[self.dim] * self.low, query[self.dim] * self.high)
        least = np.minimum(query[self.dim] * self.low, query[self.dim] * self.high)
        floor = np.minimum.reduceat(least, self.first)
        gain = most - floor[self.dim]
        top = np.maximum.reduceat(gain, self.first)
        order = np.argsort(-gain, kind="stable")
        size = (self.stop - self.start)[order]
        done = np.cumsum(size)
        ends = np.unique(np.searchsorted(done, done[-1] * np.arange(1, ROUNDS + 1) / ROUNDS) + 1).clip(max=order.size)
        got, seen = np.full(n, floor.sum() + 1e-9 * scale), np.zeros(n)
        few = max(4 * k, n // FEW)
        at = 0
        for end in ends.tolist():
            part = order[at:end]
            lengths = size[at:end]
            begin = np.cumsum(lengths) - lengths
            named = self.postings[np.repeat(self.start[part] - begin, lengths) + np.arange(lengths.sum())]
            got += np.bincount(named, np.repeat(gain[part], lengths), n)
            seen += np.bincount(named, minlength=n)
            at = end
            following = gain[order[at]] if at < order.size else 0.0
            begun = top >= following
            bound = got + following * (begun.sum() - seen) + top[~begun].sum()
            if own >= 0:
                bound[own] = -np.inf
            head = np.argpartition(-bound, min(k, n - 1))[:k]
            head = head[bound[head] > -np.inf]
            so_far = sorted([*best, *exact_scores(query, self.vectors[head], safe)], reverse=True)[:k]
            limit = min(so_far[-1], LONG) if len(so_far) == k else -np.inf  # all beyond LONG are ties
            alive = np.flatnonzero((bound >= limit) & (bound > -np.inf))
            if alive.size <= few:
                break
        scores = exact_scores(query, self.vectors[alive], safe)
        return alive.tolist(), scores


def packed(rows: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """The vectors that take part, in shards: rows of PACKED. places: of the rows in their shard."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def given(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, made
            while sum(h[0].size for h in held) >= least and held and sum(h[0].size for h in held):
                dims = max(h[2].shape[1] for h in held)
                ids, known = (np.concatenate([h[k] for h in held]) for k in range(2))
                vectors = np.concatenate([np.pad(h[2], ((0, 0), (0, dims - h[2].shape[1]))) for h in held])
                yield as_batch([Block((task << 24) + made, ids[:SHARD], known[:SHARD], vectors[:SHARD], np.arange(ids[:SHARD].size)).row()])
                made += 1
                held = [(ids[SHARD:], known[SHARD:], vectors[SHARD:])]

        for b in batches:
            take, vectors = integers(b.column(1), scale)
            ids = b.column(0).take(pa.array(take))
            held.append((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False), vectors))
            yield from given(SHARD)
        yield from given(1)

    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(pack, PACKED)


def as_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
    names = [c.split()[0] for c in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def query_blocks(index: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, in blocks: rows of PACKED. places: shard * SHARD + place."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Block] = []

        def given() -> pa.RecordBatch:
            dims = max(b.vectors.shape[1] for b in held)
            out = Block(held[0].block, *(np.concatenate(x) for x in ([b.ids for b in held], [b.known for b in held], [b.widened(dims) for b in held], [b.places for b in held])))
            held.clear()
            return as_batch([out.row()])

        for b in batches:
            for row in b.to_pylist():
                shard = Block.of(row)
                take = shard.known & (shard.ids % every == 0)
                if take.any():
                    held.append(Block(shard.block, shard.ids[take], shard.known[take], shard.vectors[take], shard.block * SHARD + shard.places[take]))
                if sum(x.ids.size for x in held) >= BLOCK:
                    yield given()
        if held:
            yield given()

    return index.mapInArrow(pick, PACKED)


def search_cells(rows: DataFrame, k: int) -> DataFrame:
    """rows: CELLED, a cell's rows one after another, its queries (kind 0) before its shards. Gives FOUND."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries, best = None, [], []

        def given() -> Iterator[pa.RecordBatch]:
            out = [(int(b.places[i]), int(b.ids[i]), x if known else None, -s) for b, found in zip(queries, best, strict=True) for i, own in enumerate(found) for s, known, x in own]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)], [c.split()[0] for c in FOUND.split(", ")])

        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell:
                    yield from given()
                    cell, queries, best = row["cell"], [], []
                if row["kind"] == 0:
                    queries.append(Block.of(row))
                    best.append([[] for _ in range(queries[-1].ids.size)])
                    continue
                shard = Shard(Block.of(row), row["dims"])
                for block, found in zip(queries, best, strict=True):
                    vectors = block.widened(shard.dims)[:, : shard.dims]
                    for i, own in enumerate(found):
                        home, place = divmod(int(block.places[i]), SHARD)
                        at, scores = shard.search(vectors[i], k, place if home == shard.block.block else -1, [-s for s, *_ in own])
                        told = ((-max(-LONG - 1, min(LONG, s)), bool(shard.block.known[a]), int(shard.block.ids[a])) for a, s in zip(at, scores, strict=True))
                        found[i] = sorted([*own, *told])[:k]
        yield from given()

    return rows.mapInArrow(search, FOUND)


def top_k(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, every: int = 100, scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id is divisible by ``every``: the k other rows with the
    highest integer inner products, ties to smaller ids."""
    spark = rows.sparkSession
    small_batches(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    shelf = Shelf(spark, "topk")
    index = shelf.put(packed(rows, id_col, vec_col, scale), "index")
    queries = shelf.put(query_blocks(index, every), "queries")
    shards, blocks = index.count(), queries.count()
    down = max(1, ceil(2 * blocks / CELL_BLOCKS))
    wide = max(1, ceil(shards / max(1, min(CELL_SHARDS, shards * down // (4 * spark.sparkContext.defaultParallelism)))))
    of = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n))
    row, line = of("block", wide), of("block", down)
    each = lambda table, n: table.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("to"), "*")
    grid = each(queries, wide).select((F.col("to") * down + line).alias("cell"), F.lit(0).alias("kind"), *queries.columns)
    grid = grid.unionByName(each(index, down).select((row * down + F.col("to")).alias("cell"), F.lit(1).alias("kind"), *index.columns))
    cells = grid.repartition(wide * down, "cell").sortWithinPartitions("cell", "kind")
    found = search_cells(cells, k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
