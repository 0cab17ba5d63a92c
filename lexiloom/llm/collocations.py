"""Phrase collocation mining: n-grams that are found together more than their parts.

All 1..``most``-grams become DataFrame rows (lang, phrase, f), which are summed by hash
aggregation. A task sums what it has of a chunk of words before it gives rows out: words
are numbered, n-grams are numbers, and phrases are written once a chunk; numbers are
exact, so no two phrases are taken for one. Words and pairs go first. A longer phrase with
f >= ``least`` has only pairs with f >= ``least`` in it, so the second pass over the texts
leaves out, by a filter of the frequent pairs, those that have another pair. The
filter lets too much pass at times, which costs rows that the sum then drops, and never
too little; where it would be larger than store.MOST_BITS, everything passes.

Phrases cut in two are joined with the counts of both parts, scored in Decimal, and the
lowest-scoring cut counts. Phrases in a longer candidate that is nearly as frequent are
taken out by an anti-join with the candidates' one-word shorter parts: where a phrase lies
in a candidate with more words than one more, the phrases in between have at least its
frequency, so one word more is enough. Windows rank each language's rows.

Hot keys: frequent phrases are summed in tasks first, and the ranks are limited in tasks
first, so a language may hold all rows.

Cases: null and empty texts have no words; a null lang is ``und``, and so counted with a
lang of that name; bytes that aren't UTF-8 are U+FFFD; repeated rows count again; phrases
with equal scores and counts are ordered by their bytes; a language without a candidate
has no row, and so has an empty table; a text is held with its words by one task, as long as
it may be; further columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.store import FILTER_BITS, MOST_BITS, Shelf, filter_bits, small_batches, whole_text

#: What ends a piece of text, and what parts words.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: A-Z lower-cased, ends as \n and gaps as blanks.
PLAIN = bytes(10 if b in ENDS else 32 if b in GAPS else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of text that a task counts at once.
CHUNK = 1 << 23
#: Odd factors that mix word hashes.
FACTORS = tuple(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(1, 4))
COUNTED = "lang string, phrase string, f long"


class Words:
    """The words of a chunk of texts: ``dictionary`` of the distinct ones, ``ids`` in order, ``piece`` of each."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join([b"", *texts, b""]).translate(PLAIN), np.uint8)
        end = raw == 10
        gap = end | (raw == 32)
        starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        stops = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        self.piece = np.cumsum(end, dtype=np.int32)[starts]
        offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), starts.size, [None, pa.py_buffer(offsets), pa.py_buffer(raw[~gap])])
        coded = words.dictionary_encode()
        self.dictionary = coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint64)

    def places(self, n: int) -> np.ndarray:
        """Where n-grams begin: in one piece."""
        last = self.ids.size - n + 1
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1 :]) if last > 0 else np.zeros(0, np.int64)

    def hashes(self) -> np.ndarray:
        """A number for each distinct word, the same in every task."""
        import xxhash

        return np.array([xxhash.xxh64_intdigest(w) for w in self.dictionary.to_pylist()], np.uint64)

    def phrases(self, n: int, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(distinct n-grams that begin ``at``, how often)."""
        heads, columns = self.ids[at], [np.arange(len(self.dictionary))]
        count = np.bincount(heads.astype(np.int64), minlength=len(self.dictionary))
        for k in range(1, n):  # a number for each distinct n-gram so far, and its words
            key = heads << np.uint64(32) | self.ids[at + k]
            if k < n - 1:
                key, heads = np.unique(key, return_inverse=True)
                heads = heads.astype(np.uint64)
            else:
                key, count = np.unique(key, return_counts=True)
            before = (key >> np.uint64(32)).astype(np.int64)
            columns = [*(c[before] for c in columns), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        return pc.binary_join_element_wise(*[self.dictionary.take(pa.array(c)) for c in columns], pa.scalar(b" ", pa.large_binary())), count


def bits_of(lang: str, first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bit for pairs of words, given by their hashes; ``bits`` is a power of two."""
    import xxhash

    own = np.uint64(xxhash.xxh64_intdigest(lang) * FACTORS[2] % (1 << 64))
    mixed = first * np.uint64(FACTORS[0]) ^ (second * np.uint64(FACTORS[1]) + own)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(FACTORS[2])
    return (mixed >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def pair_filter(pairs: DataFrame, shelf: Shelf) -> np.ndarray | None:
    """A bitmap of the pairs (lang, phrase), of MOST_BITS at most; None where it would have to be larger."""
    import xxhash

    n = pairs.count()
    if n * FILTER_BITS > 2 * MOST_BITS:
        return None
    bits = filter_bits(n)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lang, phrase in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                first, second = (np.array([xxhash.xxh64_intdigest(w)], np.uint64) for w in phrase.split(" "))
                out.append(int(bits_of(lang, first, second, bits)[0]) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["at"])

    at = pairs.select("lang", "phrase").mapInArrow(place, "at long")
    rows = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)[: out.size]
        out[(r["bucket"] - 1) * 4096 :][: part.size] = part
    return out


def counted(docs: DataFrame, sizes: range, frequent: np.ndarray | None, lang: Column, text: Column) -> DataFrame:
    """(lang, phrase, f) of all n-grams of ``sizes`` words, but for those with a pair that the filter doesn't
    have; with words counted, a row without a phrase has the language's number of words."""

    def rows(lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        words = Words(texts)
        fine = np.ones(words.ids.size, bool)
        if frequent is not None:
            at, hashes = words.places(2), words.hashes()
            bit = bits_of(lang, hashes[words.ids[at].astype(np.int64)], hashes[words.ids[at + 1].astype(np.int64)], frequent.size * 8)
            fine[at] = frequent[bit >> 3] >> (bit & 7) & 1
        for n in sizes:
            at = words.places(n)
            for k in range(n - 1):
                at = at[fine[at + k]]
            if at.size:
                phrases, f = words.phrases(n, at)
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(phrases)), phrases.cast(pa.string()), pa.array(f, pa.int64())], ["lang", "phrase", "f"])
        if 1 in sizes and words.ids.size:
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.string()), pa.array([words.ids.size], pa.int64())], ["lang", "phrase", "f"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                held.setdefault(name, []).append(t)
                size += len(t)
                if size >= CHUNK:
                    for x, texts in held.items():
                        yield from rows(x, texts)
                    held.clear()
                    size = 0
        for x, texts in held.items():
            yield from rows(x, texts)

    small_batches(docs.sparkSession)
    each = docs.select(F.make_valid_utf8(F.coalesce(lang.cast("string"), F.lit("und"))).alias("lang"), whole_text(text).alias("text"))
    return each.mapInArrow(count, COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of phrases of two words and more, by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    cut = phrases.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    part = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cut = cut.select("lang", "phrase", "size", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    of = lambda side, f: phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    cut = cut.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    number = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"cast(2000000 as decimal(7, 0)) * {number('a')} div ({number('l')} + {number('r')})")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cut.groupBy("lang", "phrase", "size", "a").agg(least).select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = 4, least: int = 30, share: int = 80, top: int = 2000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``most`` words.

    A phrase counts ``least`` times at least; one that lies in a candidate with ``share`` percent of its
    frequency goes."""
    shelf = Shelf(docs.sparkSession, "phrases")
    lang, text = F.col(lang_col), F.col(text_col)
    short = shelf.put(counted(docs, range(1, min(most, 2) + 1), None, lang, text).where((F.col("f") >= least) | F.col("phrase").isNull()), "short")
    size = F.size(F.split("phrase", " ")).alias("size")
    phrases = short.where("phrase is not null").select("*", size)
    if most > 2:
        frequent = pair_filter(phrases.where("size = 2"), shelf)
        more = shelf.put(counted(docs, range(3, most + 1), frequent, lang, text).where(F.col("f") >= least), "long")
        phrases = phrases.unionByName(more.select("*", size))
    found = shelf.put(scored(phrases), "scored")
    words = F.split("phrase", " ")
    inner = F.explode(F.array(F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " ")))
    longer = found.where("size > 2").select("lang", "a", inner.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    lies = F.expr(f"100 * cast(longer as decimal(19, 0)) >= {share} * cast(a as decimal(19, 0))")
    kept = found.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(lies, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    kept = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = short.where("phrase is null").select("lang", F.col("f").alias("n"))
    return kept.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
