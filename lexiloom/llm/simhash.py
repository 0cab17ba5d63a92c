"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits. Every bit position gets a nonzero vector of radius + 1
bits; each nonzero vector v gives a mask of the positions whose vector has an odd
product with v. For any two fingerprints within the radius, the differing positions
are at most ``radius`` linear conditions on v, so some v has a mask without them:
the two fall into one bucket of that mask's table, with certainty.

Rows are first aggregated to distinct fingerprints, so that copies never meet each
other. Small buckets compare their members (a merge join on the bucket that keeps
only verified pairs). The members of large buckets are linked exactly without
pairs: two fingerprints within the radius r have one between them, at most r // 2 bits
from the one and r - r // 2 from the other. So each gives all fingerprints that near as
keys (65 for radius 2, which as many fingerprints can have at most), and a key links all
that have it to the smallest of its nearest. Components are found by alternating
large-star and small-star steps, each written to the shared folder.

Cases: bytes that aren't UTF-8 are U+FFFD; null, empty and blank texts have fingerprint zero and are linked like any
other; fewer words than a shingle needs are one shingle; component_id is the smallest
id that isn't null, null if there is none; rows with one id are rows of their own; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.store import Shelf, looked_up, small_batches, whole_text

SEED = 42
#: Buckets of up to so many fingerprints compare their members; larger ones go the exact other way.
SMALL = 24
#: 31 masks, and 2081 keys of a fingerprint in a large bucket.
MOST_RADIUS = 4


def fingerprint_of(raw: bytes, words: int = 3) -> int:
    """The fingerprint of a text in UTF-8, as an unsigned number."""
    from xxhash import xxh64_intdigest

    own = raw.lower().split()  # of bytes: A-Z and the six blanks
    if not own:
        return 0
    if len(own) > words:
        shingles = map(b" ".join, zip(*(own[i:] for i in range(words)), strict=False))
    else:
        shingles = iter([b" ".join(own)])
    h = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[at : at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    """The SimHash of a text column, as a signed long."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint_of(t.encode(), words) for t in texts.to_pylist()], np.uint64).view(np.int64), pa.int64())

    return of(whole_text(text))


def covering_masks(radius: int = 2, bits: int = 64) -> list[int]:
    """2 ** (radius + 1) - 1 masks, as signed longs. Position i has the vector 1 + i mod (2 ** (radius + 1) - 1)."""
    n = (1 << radius + 1) - 1
    masks = [sum(1 << i for i in range(bits) if ((1 + i % n) & v).bit_count() % 2) for v in range(1, n + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def close(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def ball(radius: int, bits: int = 64) -> list[int]:
    """What is XORed to a fingerprint to get all within ``radius`` bits, as signed longs."""
    out = [sum(1 << i for i in places) for k in range(radius + 1) for places in combinations(range(bits), k)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def near_links(prints: DataFrame, shelf: Shelf, radius: int = 2, small: int = SMALL) -> DataFrame:
    """Links (a, b), a < b, that have the components of the distinct fingerprints ``fp``."""
    if not 1 <= radius <= MOST_RADIUS:
        raise ValueError(f"radius: 1 to {MOST_RADIUS}; masks and keys grow as its powers")
    masks = F.array(*[F.struct(F.lit(i).alias("mask"), F.lit(m).alias("bits")) for i, m in enumerate(covering_masks(radius))])
    keyed = prints.select("fp", F.explode(masks).alias("m")).select("fp", "m.mask", F.col("fp").bitwiseAND(F.col("m.bits")).alias("key"))
    full = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = shelf.put(keyed.join(full, ["mask", "key"]), "members")
    few = members.where(F.col("n") <= small).select("mask", "key", "fp")
    pairs = few.select("mask", "key", F.col("fp").alias("a")).join(few.select("mask", "key", F.col("fp").alias("b")), ["mask", "key"])
    pairs = pairs.where((F.col("a") < F.col("b")) & close(F.col("a"), F.col("b"), radius)).select("a", "b")
    # a key within radius // 2 of one and within the rest of the other links both: so its nearest's smallest links all
    many = members.where(F.col("n") > small).select("fp").distinct()
    near, far = ball(radius // 2), ball(radius - radius // 2)
    marks = F.transform(F.array(*[F.lit(m).cast("long") for m in far]), lambda x: F.col("fp").bitwiseXOR(x))
    keys = many.select("fp", F.posexplode(marks).alias("at", "key")).withColumn("near", F.col("at") < len(near))
    stars = keys.groupBy("key").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("hub"), F.collect_set("fp").alias("all"))
    stars = stars.where(F.col("hub").isNotNull() & (F.size("all") > 1)).select("hub", F.explode("all").alias("fp")).where("hub <> fp")
    stars = stars.select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b"))
    links = shelf.put(pairs.unionByName(stars).distinct(), "links")
    shelf.drop("members")
    return links


def components(links: DataFrame, shelf: Shelf) -> DataFrame:
    """(node, root) of every node of the links (a, b); the root is the smallest node."""
    edges = links.select(F.col("b").alias("child"), F.col("a").alias("root"))
    n, step = edges.count(), 0
    while n:
        step += 1
        both = edges.union(edges.select("root", "child")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = shelf.put(large, f"large{step}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        little = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("child"), F.col("m").alias("root")), F.struct(F.col("v").alias("child"), F.col("m").alias("root")))).alias("e")).select("e.*").where("child > root").distinct()
        little = shelf.put(little, f"small{step}")
        shelf.drop(f"large{step}")
        now = little.count()
        same = now == n and little.join(edges, ["child", "root"], "left_anti").isEmpty()
        edges, n = little, now
        if step > 1:
            shelf.drop(f"small{step - 1}")
        if same:
            break
    return edges.select(F.col("child").alias("node"), "root")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2, small: int = SMALL) -> DataFrame:
    """(id, fp, component_id) of each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    shelf = Shelf(spark, "simhash")
    rows = shelf.put(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp")), "prints")
    prints = shelf.put(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    found = components(near_links(prints, shelf, radius, small), shelf)
    linked = prints.join(found, F.col("fp") == F.col("node"), "left").select("fp", "n", "least", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    # a root is no node of its own: it has its row by its fingerprint
    roots = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.bool_or("linked").alias("linked")).where("linked").select("root", "component_id")
    of = linked.join(roots, "root", "left").select("fp", "n", F.when(F.col("component_id").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    return looked_up(rows, shelf.put(of, "of"), "fp", "n", rows.count()).select("id", "fp", "component_id")
