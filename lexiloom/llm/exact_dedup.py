"""Exact deduplication over a log-structured merge index of text digests.

Documents arrive in memtables, each as large as all before it. A memtable is grouped by
digest and flushed as a sorted run (digest, keep_id, n) with a filter (a bitmap over
hashed digests). Rows of the flush that an older run's filter lets pass are merge-joined
with that run; what is found there, and what the memtable holds twice, is a hit. When a
level has ``fanout`` runs and more memtables come, they are compacted into one run of
the next level, which keeps one identifier and the count of each digest. At last the
runs are looked up for the hits: their identifier and count are the answer. The texts of
hits are compared byte for byte; texts that share a digest only are told apart by their
bytes. All of it is DataFrame operations.

Digests of very many rows (store.HEAVY) are looked up by a broadcast of bounded size,
so no task has all rows of such a group; the others by a merge join.

Cases: a null text is the empty text; rows with the same id and text count one by
one and share the verdict; ids may be of any type that has an order; a null id never
stays while its group has another id (if all are null, all stay); an empty table gives
an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.store import Shelf, ascii_lower, batch_of, batches_for, looked_up, narrowed


def text_digest(normal: Column) -> Column:
    return F.unhex(F.sha2(normal, 256))


class DigestIndex:
    """Levels of sorted runs (digest, keep_id, n)."""

    def __init__(self, shelf: Shelf, keep: str = "largest", fanout: int = 2):
        if keep not in ("largest", "smallest"):
            raise ValueError("keep: largest or smallest")
        self.shelf, self.fanout = shelf, fanout
        self.best = F.max if keep == "largest" else F.min
        self.levels: list[list[str]] = []
        self.tables: dict[str, DataFrame] = {}
        self.sizes: dict[str, int] = {}
        self.made = 0

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def merged(self, rows: DataFrame) -> DataFrame:
        """Rows (digest, keep_id, n), one for each digest."""
        return rows.groupBy("digest").agg(self.best("keep_id").alias("keep_id"), F.sum("n").alias("n"))

    def flush(self, memtable: DataFrame, more: bool = True) -> DataFrame:
        """Flushes rows (id, digest) and gives the digests that are hits. more: whether another memtable will come."""
        own = self._run(self.merged(memtable.select("digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"))))
        new = self.tables[own]
        found = [new.where("n > 1").select("digest")]
        for name in self.runs():
            old = self.tables[name]
            rows, _ = narrowed(new.where("n = 1").select("digest"), old, self.sizes[name], self.shelf, f"filter_{name}")
            found.append(rows.join(old.select("digest").hint("merge"), "digest", "left_semi"))
        hits = self.shelf.put(reduce(DataFrame.union, found), f"hits_{own}")
        self._add(own, 0, more)
        return hits

    def _run(self, rows: DataFrame) -> str:
        self.made += 1
        name = f"run{self.made}"
        self.tables[name] = self.shelf.run(rows, name, "digest")
        self.sizes[name] = self.tables[name].count()
        return name

    def _add(self, name: str, level: int, more: bool) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if more and len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._add(self._run(self.merged(reduce(DataFrame.union, [self.tables[n] for n in old]))), level + 1, more)
            for n in old:
                self.shelf.drop(n)
                del self.tables[n]

    def look_up(self, hits: DataFrame) -> DataFrame:
        """(digest, keep_id, n) of the hits, from all runs."""
        own = [self.tables[n].join(hits.hint("merge"), "digest", "left_semi") for n in self.runs()]
        return self.merged(reduce(DataFrame.union, own))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", memtables: int | None = None, fanout: int = 2,
    normal: Callable[[Column], Column] = ascii_lower, digest: Callable[[Column], Column] = text_digest,
) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) of each row of ``docs``.

    ``normal`` is what makes texts equal; ``digest`` may be as weak as one likes, for
    texts with one digest are told apart by their bytes. ``memtables``: by the number of
    documents, if it isn't given."""
    shelf = Shelf(docs.sparkSession, "exact")
    memtables = memtables or batches_for(docs.count())
    texts = docs.select(F.col(id_col).alias("id"), normal(F.col(text_col)).alias("normal"))
    texts = texts.select("id", "normal", digest(F.col("normal")).alias("digest"))
    rows = shelf.put(texts.select("id", "digest", batch_of(F.col("id"), memtables).alias("memtable")), "digests", ("memtable",))
    index = DigestIndex(shelf, keep, fanout)
    hits = [index.flush(rows.where(F.col("memtable") == k), more=k < memtables - 1) for k in range(memtables)]
    hit = shelf.run(reduce(DataFrame.union, hits).distinct(), "hit", "digest")
    found = shelf.put(index.look_up(hit), "found")
    n_hits = found.count()
    for name in list(index.tables):
        shelf.drop(name)
    # Byte verification: texts are compared as grouping keys, map side first, so a group of copies sends one row a task
    seen, _ = narrowed(texts, hit, n_hits, shelf, "to_verify")
    spellings = seen.groupBy("digest", "normal").agg(F.count(F.lit(1)).alias("spelt")).select("digest")
    mixed = shelf.put(spellings.groupBy("digest").count().where("count > 1").select("digest"), "mixed")
    rows, alone = narrowed(rows.select("id", "digest"), hit, n_hits, shelf, "to_tell")
    parts = []
    if not mixed.isEmpty():  # one digest, several texts: these rows are joined by their bytes
        own = texts.join(mixed, "digest", "left_semi")
        each = own.groupBy("digest", "normal").agg(index.best("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        parts.append(own.join(each, ["digest", "normal"]).select("id", "digest", "keep_id", "n"))
        found, rows = found.join(mixed, "digest", "left_anti"), rows.join(mixed, "digest", "left_anti")
    parts.append(looked_up(rows, found, "digest", "n", docs.count()))
    out = reduce(DataFrame.unionByName, parts)
    if alone is not None:
        out = out.unionByName(alone, allowMissingColumns=True)
    single = F.col("n").isNull()
    keep_id = F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id")
    out = out.select("id", keep_id, F.when(single, F.lit(1)).otherwise(F.col("n")).cast("long").alias("group_size"), "digest")
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
