"""Vectors in blocks, and every block of queries against every block: what all-pairs operators share.

A block is a row of a written table: some terms, and their vectors as bytes. Blocks of queries are dealt into tasks of
about one block each, and a task reads all blocks one after another. So nothing is copied for a pair of blocks: on
disk are the table, the queries' blocks once more by their shuffle, and what the tasks give, a few rows for each
query. A task holds two blocks and the best of each of its queries so far.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block at least, where there are few of them; blocks for each core then; queries that are scored at once.
LEAST_ROWS, TASKS, STRIP = 64, 4, 512
#: A query with more hits in a block has its whole row scored; components that are taken out for single hits at once.
MANY, AT_ONCE = 256, 1 << 21
LAST = np.iinfo(np.int64).max


def packed(rows: DataFrame, n: int, size: int, *order: str) -> DataFrame:
    """The n rows (term, v, further columns) in blocks of about ``size`` at most, ranged by the order: (block, dims, vectors, and
    an array for every other column). block is the number of its first row; numbers rise with the order."""
    size = max(1, min(size, max(LEAST_ROWS, -(-n // (TASKS * rows.sparkSession.sparkContext.defaultParallelism)))))
    kinds = dict(rows.dtypes)
    named = [c for c in rows.columns if c != "v"]
    v = F.col("v") if kinds["v"] == "array<float>" else F.col("v").cast("array<double>")
    ranged = rows.select(*named, v.alias("v")).repartitionByRange(max(1, -(-n // size)), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def given(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal held
            while (left := sum(b.num_rows for b in held)) >= least:
                every = pa.concat_batches(held)
                own, held = every.slice(0, size), [every.slice(size)] if left > size else []
                vectors = own.column("v")
                flat = vectors.flatten()
                dims = len(flat) // own.num_rows
                if vectors.null_count or any(x != dims for x in vectors.value_lengths().unique().to_pylist()):
                    raise ValueError("vectors that are compared have one length, and none is null")
                lists = {c: pa.ListArray.from_arrays(pa.array([0, own.num_rows], pa.int32()), own.column(c)) for c in named}
                data = flat.to_numpy(zero_copy_only=False).tobytes()
                yield pa.RecordBatch.from_arrays([own.column("no").slice(0, 1), pa.array([dims], pa.int32()), pa.array([data], pa.binary()), *lists.values()], ["block", "dims", "vectors", *lists])

        for b in batches:
            if b.num_rows:
                held.append(b)
                yield from given(size + size // 2)
        yield from given(1)

    lists = ", ".join(f"{c} array<{kinds[c]}>" for c in named)
    return ranged.withColumn("no", F.monotonically_increasing_id()).mapInArrow(pack, f"block long, dims int, vectors binary, {lists}")


class Block:
    """A block's terms, numbers and further columns. unit: its vectors at length 1, zero vectors as they are; short: the same in
    half the bytes."""

    def __init__(self, row: dict[str, pa.Scalar]):
        self.block = row["block"].as_py()
        columns = {c: x.values for c, x in row.items() if c not in ("block", "dims", "vectors")}
        self.kind = columns["term"].type
        self.columns = {c: np.array(x.to_numpy(zero_copy_only=False)) for c, x in columns.items()}
        self.terms = self.columns["term"]
        n, dims, data = len(self.terms), row["dims"].as_py(), row["vectors"].as_buffer()
        self.no = self.block + np.arange(n)
        m = np.frombuffer(data, np.float32 if data.size == 4 * n * dims else np.float64).astype(float).reshape(n, dims)
        with np.errstate(over="ignore", invalid="ignore"):
            size = np.sqrt((m * m).sum(axis=1, keepdims=True))
            self.unit = m / np.where(size == 0, 1, size)
        self.short = self.unit.astype(np.float32)


class Best:
    """The best rows for each of n queries so far: by falling score, then by number. more: kinds of what goes with them."""

    def __init__(self, n: int, top: int, *more: np.dtype):
        self.top = top
        self.score, self.no = np.full((n, top), -np.inf), np.full((n, top), LAST)
        self.more = [np.zeros((n, top), kind) for kind in more]

    def enters(self, row: np.ndarray, score: np.ndarray, no: np.ndarray) -> np.ndarray:
        """Whether these are better than the last of their query's best."""
        last = self.score[row, -1]
        return (score > last) | ((score == last) & (no < self.no[row, -1]))

    def add(self, row: np.ndarray, score: np.ndarray, no: np.ndarray, *more: np.ndarray) -> None:
        rows = np.unique(row)
        held = (self.score, self.no, *self.more)
        every = [np.concatenate([h[rows].ravel(), x]) for h, x in zip(held, (score, no, *more), strict=True)]
        at = np.concatenate([np.repeat(rows, self.top), row])
        order = np.lexsort((every[1], -every[0], at))
        pick = order[np.searchsorted(at[order], rows)[:, None] + np.arange(self.top)]  # with the held ones a query has enough
        for h, x in zip(held, every, strict=True):
            h[rows] = x[pick]


def own_places(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(places in a, places in b) of equal terms; b is ordered by term."""
    low, high = np.searchsorted(b.terms, a.terms, "left"), np.searchsorted(b.terms, a.terms, "right")
    size = high - low
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(row.size) - np.repeat(np.cumsum(size) - size - low, size)


def dots(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Inner products of rows of a with rows of b."""
    step = max(1, AT_ONCE // max(1, a.shape[1]))
    return np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", a[row[k : k + step]], b[col[k : k + step]]) for k in range(0, row.size, step))])


def hits_in(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, rows with more than MANY of them) of what is true; rows and columns without those of the latter."""
    row, col = np.divmod(np.flatnonzero(scores), scores.shape[1])
    many = np.flatnonzero(np.bincount(row, minlength=scores.shape[0]) > MANY)
    if many.size:
        few = ~np.isin(row, many)
        row, col = row[few], col[few]
    return row, col, many


def swept(blocks: DataFrame, queries: DataFrame, began: Callable[[Block], Best], look: Callable[[Block, Block, Best], None], told: Callable[[Best], tuple[np.ndarray, np.ndarray, np.ndarray]], parts: int = 1) -> DataFrame:
    """(term, other, similarity): every block of the queries against every block, both written tables of packed(). look(a, b, best)
    adds what b has for the queries of a; told(best) gives places of queries, others and similarities. parts: of the blocks, each
    looked through by tasks of its own, so a query has an answer of each."""
    tasks, kind = max(1, queries.count()), dict(blocks.dtypes)["term"].removeprefix("array<")[:-1]
    asked = queries.repartitionByRange(tasks, "block").select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    # the first table of a product is read row by row, the second is held: a task's queries
    pairs = blocks.coalesce(parts).hint("shuffle_replicate_nl").crossJoin(asked)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[Block, Best]] = {}
        b = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                own = {c: x for c, x in row.items() if not c.startswith("q_")}
                if (at := row["q_block"].as_py()) not in held:
                    a = Block({c.removeprefix("q_"): x for c, x in row.items() if c.startswith("q_")})
                    held[at] = a, began(a)
                b = b if b and b.block == own["block"].as_py() else Block(own)
                look(held[at][0], b, held[at][1])
        for a, best in held.values():
            row, other, similarity = told(best)
            yield pa.RecordBatch.from_arrays([pa.array(a.terms[row], a.kind), pa.array(other, a.kind), pa.array(similarity, pa.float64())], ["term", "other", "similarity"])

    return pairs.mapInArrow(sweep, f"term {kind}, other {kind}, similarity double")
