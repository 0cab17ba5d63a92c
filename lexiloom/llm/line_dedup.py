"""Line deduplication over levelled sorted runs of line hashes.

Documents arrive in batches, each as large as all before it. A batch's lines become
rows (hash, n_docs, last): one for each distinct hash. The batch is merge-joined
against the runs. Hashes that no run holds (the anti-join) are the batch's fresh
entries: over all runs a hash has one fresh row. Hashes that a run holds are updates of
that row. Both are written, sorted, as the batch's own run. When a level has ``fanout``
runs and more batches come, they are compacted into one of the next level. At last the
fresh entries are merged with the sums of their updates, which gives in how many
documents a line is found, and in which it stays. Only DataFrame operations are used.

A document's lines are hashed once, with their places, and the places of those that go come
back. So the work for a document grows with its lines (and their order's logarithm),
however many of them are common.

Lines in very many documents (store.HEAVY) are looked up by a broadcast of bounded size,
so no task has all documents of such a line; the others by a merge join.

Cases: a null or empty text is one empty line; a line that a document repeats counts
once for it and all its copies share the verdict; a text may have any number of common lines; documents are counted by row, so
repeated rows count; rows with one id share the verdict; ids may be of any type that has
an order; a null id is smaller than any other, and lines found under null ids only all
stay; an empty table gives an empty result; further columns stay as they are, whatever
their names, but for one named as ``out``, whose place the result takes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.store import BLANKS, HEAVY, Shelf, ascii_lower, batch_of, batches_for, narrowed

#: Bytes of SHA-256 that a line is known by.
HASH_BYTES = 16


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_hash(key: Column) -> Column:
    return F.substring(F.unhex(F.sha2(key, 256)), 1, HASH_BYTES)


def found_lines(text: Column, min_chars: int) -> Column:
    """Array of (hash, place, first) of a text's lines of ``min_chars`` and more: first in one of those with a hash."""
    keys = F.filter(F.transform(lines_of(text), lambda x, i: F.struct(line_key(x).alias("key"), i.alias("place"))), lambda x: F.length(x["key"]) >= min_chars)
    order = F.sort_array(F.transform(keys, lambda x: F.struct(line_hash(x["key"]).alias("hash"), x["place"].alias("place"))))
    mark = lambda s: F.transform(s, lambda x, i: F.struct(x["hash"], x["place"], ((i == 0) | (F.get(s, i - 1)["hash"] != x["hash"])).alias("first")))
    return F.transform(F.array(order), mark)[0]  # a variable of a lambda is made once


class LineIndex:
    """Levels of sorted runs (hash, n_docs, last, fresh)."""

    def __init__(self, shelf: Shelf, fanout: int = 2):
        self.shelf, self.fanout = shelf, fanout
        self.levels: list[list[str]] = []
        self.tables: dict[str, DataFrame] = {}
        self.made = 0

    def runs(self) -> list[DataFrame]:
        return [self.tables[name] for level in self.levels for name in level]

    def add(self, lines: DataFrame, more: bool = True) -> None:
        """lines: (id, hash), once for each document and hash. more: whether another batch will come."""
        own = lines.groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last"))
        held = F.lit(False)
        for k, run in enumerate(self.runs()):
            entries = run.where("fresh").select("hash", F.lit(True).alias(f"in{k}"))
            own = own.join(entries.hint("merge"), "hash", "left")
            held = held | F.col(f"in{k}").isNotNull()
        self._add(own.select("hash", "n_docs", "last", (~held).alias("fresh")), 0, more)

    def _add(self, rows: DataFrame, level: int, more: bool) -> None:
        self.made += 1
        name = f"run{self.made}"
        self.tables[name] = self.shelf.run(rows, name, "hash")
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if more and len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            rows = reduce(DataFrame.union, [self.tables[n] for n in old])
            merged = rows.groupBy("hash").agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"), F.bool_or("fresh").alias("fresh"))
            self._add(merged, level + 1, more)
            for n in old:
                self.shelf.drop(n)
                del self.tables[n]

    def totals(self) -> DataFrame:
        """(hash, n_docs, last) of every hash: its fresh entry and its updates."""
        runs = self.runs()
        updates = reduce(DataFrame.union, [r.where("not fresh") for r in runs])
        updates = updates.groupBy("hash").agg(F.sum("n_docs").alias("more"), F.max("last").alias("later"))
        updates = self.shelf.run(updates, "updates", "hash")
        each = [r.where("fresh").join(updates.hint("merge"), "hash", "left") for r in runs]
        total = (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs")
        return reduce(DataFrame.union, [e.select("hash", total, F.greatest("last", "later").alias("last")) for e in each])


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5,
    batches: int | None = None, fanout: int = 2, out: str = "__lines",
) -> DataFrame:
    """``docs`` with a column ``out``: struct of n_lines (before), n_dropped and text (what stays).

    A line is known by its trimmed, lower-cased text. Lines of at least ``min_chars``
    code points found in at least ``min_docs`` documents stay in the document with the
    largest id only. ``batches``: by the number of documents, if it isn't given."""
    shelf = Shelf(docs.sparkSession, "lines")
    batches = batches or batches_for(docs.count())
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = rows.select("id", "text", _row_key())  # before its lines are made rows
    found = keyed.select("id", "row", F.explode(found_lines(F.col("text"), min_chars)).alias("line"))
    found = found.select("id", "row", "line.*", batch_of(F.col("id"), batches).alias("batch"))
    found = shelf.put(found, "found", ("batch",))
    index = LineIndex(shelf, fanout)
    for k in range(batches):
        index.add(found.where((F.col("batch") == k) & F.col("first")).select("id", "hash"), more=k < batches - 1)
    common = shelf.put(index.totals().where((F.col("n_docs") >= min_docs) & F.col("last").isNotNull()), "common")
    go = shelf.put(_decisions(found.select("id", "row", "hash", "place"), common, shelf), "go")
    for name in ("found", "common", "updates", *index.tables):
        shelf.drop(name)
    # only documents that may lose a line meet their decisions; a filter lets the others pass where they are
    touched, untouched = narrowed(rows, go, go.count(), shelf, "touched", "id")
    ours = F.col("id").eqNullSafe(F.col("to_id")) & (F.col("row") == F.col("to_row"))
    result = _apply(touched.withColumn("row", _row_key()).join(go.toDF("to_id", "to_row", "go").hint("merge"), ours, "left"), out)
    if untouched is not None:
        result = result.unionByName(_apply(untouched.withColumn("go", F.lit(None).cast("array<int>")), out))
    stay = [F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() != out.lower()]
    return result.select(*stay, out)


def _row_key() -> Column:
    """Tells rows with one id apart by their texts."""
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("row")


def _decisions(found: DataFrame, common: DataFrame, shelf: Shelf) -> DataFrame:
    """(id, row, go): the places of the common lines that a document loses."""
    limit = found.count() // HEAVY
    heavy = F.broadcast(common.where(F.col("n_docs") > limit).select("hash", "last"))  # HEAVY rows at most
    light = common.where(F.col("n_docs") <= limit).select("hash", "last")
    rest, _ = narrowed(found.join(heavy, "hash", "left_anti"), light, light.count(), shelf, "light", "hash")
    each = found.join(heavy, "hash").unionByName(rest.join(light.hint("merge"), "hash"))
    each = each.where(~F.col("id").eqNullSafe(F.col("last")))
    return each.groupBy("id", "row").agg(F.collect_set("place").alias("go"))


def _apply(rows: DataFrame, out: str) -> DataFrame:
    """rows: (doc, id, text, go)."""
    size = F.size(lines_of(F.col("text")))
    left = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["go"])  # noqa: E731  by hash, in order
    both = F.array(F.struct(lines_of(F.col("text")).alias("lines"), "go"))
    stay = F.transform(both, lambda x: F.transform(left(x), lambda i: F.get(x["lines"], i)))[0]
    # every dropped line takes its \n with it; a text that loses all its lines is empty
    text = F.when(F.col("go").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(stay, "\n"))
    dropped = F.when(F.col("go").isNull(), F.lit(0)).otherwise(F.size("go"))
    made = F.struct(size.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"), text.alias("text"))
    return rows.select("doc", made.alias(out))
