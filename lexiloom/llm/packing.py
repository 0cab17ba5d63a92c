"""Packing of token sequences by a grouping genetic algorithm on islands.

Documents become pieces: token ids, then an end id; only a document longer than the
capacity is cut, into full pieces after a first one that may be shorter. A full piece
is a sequence. All others are dealt by hash into shards of a bounded number of items.
A shard starts with best-fit decreasing. Its bins that are not well filled go on to the
next level: whole bins are dealt into fewer shards, which start from them, so a level
never takes more bins than it got. Levels end when one shard holds all that is left, or
when another level would have as many shards.

The last level's shards that have more bins than their items need at least are evolved
on several islands: a solution is a set of bins; crossover injects whole well-filled
bins of one parent into the other and takes out the bins that hold any of their items;
mutation empties the emptiest bins and some others. Either way the displaced items are
first exchanged for items of the bins left, where that fills a bin better, and then put
back best-fit, largest first. After each epoch the islands' elites are written and the
next island takes each in. The best island's solution stands.

Cases: a null or empty text is one piece with the end id only; bytes that aren't UTF-8
are encoded as U+FFFD; ids may be of any type; rows with one id are documents of their
own; ids and texts don't matter for where a piece goes, only lengths; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.pretok import library_memo
from lexiloom.llm.store import Shelf, small_batches, trimmed, whole_text

#: Items of a shard (on average), islands, epochs, and the population and generations of an epoch.
SHARD, ISLANDS, EPOCHS, POPULATION, GENERATIONS = 4096, 2, 2, 6, 10
#: A bin of at least this share of the capacity is well filled; those below go on to the next level.
WELL = 0.9995
#: Passes of the exchange over the bins.
PASSES = 2
PIECES = "slot long, doc_id {id}, piece int, start long, length long, ids_crc32 long"


class Bins:
    """A solution: bins of items, and what each holds."""

    def __init__(self, sizes: list[int], capacity: int, bins: list[list[int]] | None = None):
        self.sizes, self.capacity = sizes, capacity
        self.bins = [b for b in bins or [] if b]

    def loads(self) -> list[int]:
        return [sum(self.sizes[i] for i in b) for b in self.bins]

    def fitness(self) -> tuple[int, float]:
        """Fewer bins are better; among as many, those that are filled unevenly."""
        return len(self.bins), -sum((x / self.capacity) ** 2 for x in self.loads())

    def put(self, items: list[int]) -> Bins:
        """Puts items into the bins in the order given, each where it leaves least room."""
        room = sorted((self.capacity - x, k) for k, x in enumerate(self.loads()))
        for i in items:
            size = self.sizes[i]
            at = bisect_left(room, (size, -1))
            if at < len(room):
                left, k = room.pop(at)
                self.bins[k].append(i)
            else:
                left, k = self.capacity, len(self.bins)
                self.bins.append([i])
            if left > size:
                insort(room, (left - size, k))
        return self

    def decreasing(self, items: list[int]) -> Bins:
        return self.put(sorted(items, key=lambda i: -self.sizes[i]))

    def exchange(self, items: list[int]) -> list[int]:
        """Exchanges one or two items of a bin for a larger one of ``items`` that fits, or one for two
        of them, whatever fills the bin best; what is then without a place is given back."""
        sizes, free = self.sizes, sorted((self.sizes[i], i) for i in items)
        for _ in range(PASSES):
            changed = False
            for own, load in zip(self.bins, self.loads(), strict=True):
                gap = self.capacity - load
                if not gap or not free:
                    continue
                # sets of one or two items that may go, none first; what comes in may be larger by the gap
                out = [(), *((i,) for i in own), *combinations(own, 2)]
                best: tuple[int, tuple[int, ...], tuple[int, ...]] | None = None
                for gone in out:
                    had = sum(sizes[i] for i in gone)
                    at = bisect_left(free, (had + gap + 1, -1)) - 1
                    if at < 0:
                        continue
                    gain = free[at][0] - had
                    if gain > (best[0] if best else 0):
                        best = (gain, gone, (at,))
                    if len(gone) == 1 and at and gain < gap:  # two for one: the largest few, each with its best partner
                        for top in range(at, max(0, at - 6), -1):
                            low = bisect_left(free, (had + gap - free[top][0] + 1, -1)) - 1
                            low = min(low, top - 1)
                            if low >= 0 and (gain := free[top][0] + free[low][0] - had) > (best[0] if best else 0):
                                best = (gain, gone, (top, low))
                    if best and best[0] == gap:
                        break
                if best is None:
                    continue
                changed = True
                for at in sorted(best[2], reverse=True):
                    own.append(free.pop(at)[1])
                for i in best[1]:
                    own.remove(i)
                    insort(free, (sizes[i], i))
            if not changed:
                break
        return [i for _, i in free]

    def settle(self, items: list[int]) -> Bins:
        return self.decreasing(self.exchange(items))


def crossover(a: Bins, b: Bins, rng: random.Random, well: float = WELL) -> Bins:
    """Some well-filled bins of b, whole; a's bins without their items; the rest exchanged and best-fit."""
    loads = b.loads()
    good = [k for k, x in enumerate(loads) if x >= well * b.capacity]
    if len(good) < 2:
        good = sorted(range(len(loads)), key=lambda k: -loads[k])[: max(1, len(loads) // 4)]
    chosen = rng.sample(good, max(1, len(good) // rng.choice((2, 4, 8))))
    injected = [list(b.bins[k]) for k in chosen]
    inside = {i for own in injected for i in own}
    kept = [list(own) for own in a.bins if inside.isdisjoint(own)]
    displaced = [i for own in a.bins if not inside.isdisjoint(own) for i in own if i not in inside]
    return Bins(a.sizes, a.capacity, injected + kept).settle(displaced)


def mutate(a: Bins, rng: random.Random) -> Bins:
    """The emptiest bins and some others are emptied; their items are exchanged and put back best-fit."""
    loads = a.loads()
    n = min(len(loads), rng.choice((1, 2, 3, max(3, len(loads) // 50))))
    out = set(sorted(range(len(loads)), key=loads.__getitem__)[:n]) | set(rng.sample(range(len(loads)), n))
    items = [i for k in out for i in a.bins[k]]
    kept = [list(own) for k, own in enumerate(a.bins) if k not in out]
    rng.shuffle(kept)
    return Bins(a.sizes, a.capacity, kept).settle(items)


def evolve(sizes: list[int], capacity: int, seed: int, elites: list[Bins] | None = None, population: int = POPULATION, generations: int = GENERATIONS) -> Bins:
    """The best solution found; it stops where no solution can have fewer bins. A child takes the place
    of the worst of the pool if it is fitter and new."""
    rng, every = random.Random(seed), list(range(len(sizes)))
    least = -(-sum(sizes) // capacity)
    pool = list(elites or [])
    if not pool or min(len(p.bins) for p in pool) > least:
        pool.append(Bins(sizes, capacity).decreasing(every))
    if min(len(p.bins) for p in pool) > least:
        while len(pool) < population:
            jitter = [s * rng.uniform(0.8, 1.2) for s in sizes]
            pool.append(Bins(sizes, capacity).put(sorted(every, key=lambda i, j=jitter: -j[i])))
    ranked = sorted(((p.fitness(), k, p) for k, p in enumerate(pool)), key=lambda t: t[:2])
    made = len(ranked)
    for _ in range(generations):
        if ranked[0][0][0] <= least:
            break
        a, b = ranked[0][2], rng.choice(ranked[1:] or ranked)[2]
        for child in (crossover(a, b, rng), crossover(b, a, rng), mutate(a, rng), mutate(ranked[0][2], rng)):
            fitness = child.fitness()
            if all(fitness != f for f, _, _ in ranked):
                insort(ranked, (fitness, made, child), key=lambda t: t[:2])
                made += 1
        del ranked[population:]
    return ranked[0][2]


def pieces_of(docs: DataFrame, vocab: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """PIECES of documents (with_ids: and the ids); slot is unique once the result is written."""
    small_batches(docs.sparkSession)
    form = PIECES.format(id=docs.schema[id_col].dataType.simpleString()) + ", ids array<int>" * with_ids
    names = [x.strip().split()[0] for x in form.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slot = TaskContext.get().partitionId() << 36
        for b in trimmed(batches):
            flat, counts = library_memo(vocab)(b.column(1).to_pylist())
            flat = flat.astype("<u4")
            rows, parts, places, at = [], [], [], 0
            for k, n in enumerate(counts.tolist()):
                ids = np.concatenate([flat[at : at + n], np.array([end_id], "<u4")])
                at += n
                begin, stop = 0, (n % capacity) + 1  # n + 1 ids: the first piece has what full ones leave
                piece = 0
                while begin < n + 1:
                    own = ids[begin:stop]
                    rows.append((slot, piece, begin, len(own), zlib.crc32(own.tobytes())))
                    places.append(k)
                    if with_ids:
                        parts.append(own.astype(np.int32))
                    slot, piece, begin, stop = slot + 1, piece + 1, stop, stop + capacity
            columns = list(zip(*rows, strict=True)) or [()] * 5
            arrays = [pa.array(c, pa.int32() if k == 1 else pa.int64()) for k, c in enumerate(columns)]
            arrays.insert(1, b.column(0).take(pa.array(places, pa.int64())))
            yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(parts, pa.list_(pa.int32()))] if with_ids else [])], names)

    return docs.select(F.col(id_col).alias("doc_id"), whole_text(F.col(text_col)).alias("text")).mapInArrow(cut, form)


#: What a shard's island gives: each item's bin, the bin's load and the item's place in it, the number of bins, and the
#: least that there can be.
PLACED = "slot long, length long, shard long, island long, bin long, load long, offset long, bins long, least long"


def _island(capacity: int, generations: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(key[0]), int(key[1])
        rows = rows.sort_values(["role", "slot"], kind="stable")
        own = rows[rows["role"] == rows["role"].iloc[0]]
        place = {s: i for i, s in enumerate(own["slot"].tolist())}
        sizes, elites = own["length"].tolist(), []
        for _, part in rows[rows["bin"] >= 0].groupby("role", sort=True):
            bins: dict[int, list[int]] = {}
            for s, k in zip(part["slot"].tolist(), part["bin"].tolist(), strict=True):
                bins.setdefault(k, []).append(place[s])
            elites.append(Bins(sizes, capacity, list(bins.values())))
        best = evolve(sizes, capacity, shard * 1009 + island + 7919 * len(elites), elites, POPULATION if generations else 1, generations)
        of, load, offset = (np.zeros(len(sizes), np.int64) for _ in range(3))
        for k, items in enumerate(best.bins):
            ends = np.cumsum([sizes[i] for i in items])
            of[items], load[items], offset[items] = k, ends[-1], ends - [sizes[i] for i in items]
        return pd.DataFrame({"slot": own["slot"].to_numpy(), "length": own["length"].to_numpy(), "shard": shard, "island": island, "bin": of, "load": load, "offset": offset, "bins": len(best.bins), "least": -(-sum(sizes) // capacity)})

    return run


def _started(items: DataFrame, shards: int, shelf: Shelf, capacity: int, level: int) -> DataFrame:
    """PLACED of items (slot, length, bin): best-fit decreasing, or the bins that came where they are no more;
    bin is a sequence that the item is in already, -1 if in none. The items of a sequence go to one shard."""
    key = F.when(F.col("bin") < 0, F.col("slot")).otherwise(F.col("bin"))
    shard = F.pmod(F.xxhash64(key, F.lit(level)), F.lit(shards)).cast("long").alias("shard")
    dealt = items.select("slot", "length", "bin", shard, F.lit(0).cast("long").alias("island"), F.lit(0).alias("role"))
    return shelf.put(dealt.groupBy("shard", "island").applyInPandas(_island(capacity, 0), PLACED).select("*", _sequence(level)), f"level{level}")


def _sequence(level: int) -> Column:
    return (F.lit(level << 56) + F.shiftleft("shard", 16) + F.col("bin")).alias("sequence_id")


def _evolved(started: DataFrame, shelf: Shelf, capacity: int, level: int) -> DataFrame:
    """(slot, sequence_id, offset) after the search: of the shards with more bins than the least; the others
    stay as they are."""
    rows = started.where("bins > least").select("slot", "length", "bin", "shard", F.lit(0).alias("role"))
    rows = rows.withColumn("island", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ISLANDS - 1).cast("long"))))
    for epoch in range(EPOCHS):
        done = shelf.put(rows.groupBy("shard", "island").applyInPandas(_island(capacity, GENERATIONS), PLACED), f"epoch{epoch}")
        resident = done.select("slot", "length", "shard", "island", "bin", F.lit(0).alias("role"))
        migrant = done.select("slot", "length", "shard", ((F.col("island") + 1) % ISLANDS).alias("island"), "bin", F.lit(1).alias("role"))
        rows = resident.unionByName(migrant)
        if epoch:
            shelf.drop(f"epoch{epoch - 1}")
    best = done.groupBy("shard").agg(F.min(F.struct("bins", "island")).alias("best")).select("shard", F.col("best.island").alias("island"))
    found = done.join(best, ["shard", "island"]).select("slot", _sequence(level), "offset")
    return started.where("bins <= least").select("slot", "sequence_id", "offset").unionByName(found)


def pack(items: DataFrame, shelf: Shelf, capacity: int = 2048) -> DataFrame:
    """(slot, sequence_id, offset) of items (slot unique, length from 1 to capacity)."""
    full = items.where(F.col("length") >= capacity).select("slot", (-1 - F.col("slot")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rows = items.where(F.col("length") < capacity).select("slot", "length", F.lit(-1).cast("long").alias("bin"))
    shards, level = max(1, -(-rows.count() // SHARD)), 0
    parts = [full]
    while True:
        started = _started(rows, shards, shelf, capacity, level)
        low = started.where(F.col("load") < WELL * capacity)
        fewer = -(-low.count() // SHARD) if shards > 1 else 0
        if not 0 < fewer < shards:  # one shard saw all that was left, or another level would see no more at once
            parts.append(_evolved(started, shelf, capacity, level))
            return reduce(DataFrame.unionByName, parts)
        parts.append(started.where(F.col("load") >= WELL * capacity).select("slot", "sequence_id", "offset"))
        rows = low.select("slot", "length", F.col("sequence_id").alias("bin"))
        shards, level = fewer, level + 1


def pack_documents(docs: DataFrame, vocab: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """PIECES without slot (with_ids: and the ids), sequence_id and offset."""
    shelf = Shelf(docs.sparkSession, "packing")
    pieces = shelf.put(pieces_of(docs, vocab, end_id, capacity, id_col, text_col, with_ids), "pieces")
    return pieces.join(pack(pieces, shelf, capacity), "slot").drop("slot")
