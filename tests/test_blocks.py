"""All-pairs operators by blocks, and phrases: what they write to disk, and their answers against numpy."""

from collections import Counter
from functools import partial
from itertools import pairwise
from pathlib import Path

import numpy as np
import pytest

import __spark_entry__ as entry
from lexiloom.operators import candidates as ca
from lexiloom.operators import index as ix
from lexiloom.operators import terms as te


def shuffled(spark, action):
    """(bytes that an action's stages wrote for shuffles, its result)."""
    gateway = spark.sparkContext._gateway
    store = spark.sparkContext._jsc.sc().statusStore()

    def stages():
        found = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteBytes() for i in range(found.size())}

    before = set(stages())
    out = action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(n for stage, n in stages().items() if stage not in before), out


def table(spark, m, name=int, kind="long"):
    return spark.createDataFrame([(name(i), v.tolist()) for i, v in enumerate(m)], f"term {kind}, vector array<double>")


def nearest(m, top, rounded, order):
    """(row, other, similarity, rank) by numpy; order: places in the order of terms."""
    size = np.linalg.norm(m, axis=1, keepdims=True)
    u = m / np.where(size == 0, 1, size)
    s = np.round(u @ u.T, rounded)
    place = np.argsort(order)
    out = set()
    for i in range(len(m)):
        best = sorted((-s[i, j], place[j], j) for j in range(len(m)) if j != i and np.isfinite(s[i, j]))[:top]
        out |= {(i, j, -x + 0.0, k + 1) for k, (x, _, j) in enumerate(best)}
    return out


def test_the_index_copies_no_vector_for_a_cell(spark):
    m = np.random.default_rng(3).normal(size=(600, 64))
    df = table(spark, m)
    written, rows = shuffled(spark, lambda: ix.indexed_neighbors(df, top=10, cells=24, probes=12).count())
    assert rows == 6000 and written <= 4 * m.nbytes  # 12 cells are looked into


@pytest.mark.parametrize("block", [16, 300])
def test_ties_and_odd_vectors_by_blocks(spark, block):
    rng = np.random.default_rng(5)
    m = rng.integers(-1, 2, (420, 3)).astype(float)  # few directions, so most neighbours are ties; some vectors are zero
    m[7] = np.nan
    m[11] = [1e200, 0, 0]
    names = [f"t{k}" for k in rng.permutation(420)]
    df = table(spark, m, names.__getitem__, "string")
    with np.errstate(over="ignore", invalid="ignore"):
        m[11] = 0  # its square is no number of a double
        want = {(names[i], names[j], s, k) for i, j, s, k in nearest(m, 6, 4, sorted(range(420), key=names.__getitem__))}
    got = {(r["term"], r["other"], r["similarity"] + 0.0, r["rank"]) for r in ca.vector_neighbors(df, top=6, block=block, rounded=4).collect()}
    assert got == want and len(got) == 419 * 6


#: Queries of neighbours.
SOME = ["vector_neighbors", "indexed_recall", "neighbor_probe", "valid_neighbors", "degree_capped", "mutual_rank_pairs", "similarity_thresholds"]


@pytest.mark.parametrize("query", SOME)
def test_queries_copy_no_vector_for_a_block(spark, monkeypatch, query):
    monkeypatch.setattr(ca, "vector_neighbors", partial(ca.vector_neighbors, block=16))
    written, rows = shuffled(spark, lambda: entry.queries()[query](spark, "/root/testdata/sf0.01").count())
    assert rows and written <= 2_000_000  # 500 vectors of 64 floats are 128,000 bytes; 32 blocks


def test_neighbours_of_asked_terms_only(spark):
    df = table(spark, np.random.default_rng(8).normal(size=(200, 8)))
    asked = spark.createDataFrame([(3,), (77,), (999,)], "term long")
    want = [r for r in ca.vector_neighbors(df, top=4, block=16).collect() if r["term"] in (3, 77)]
    assert sorted(ca.vector_neighbors(df, top=4, block=16, asked=asked).collect()) == sorted(want) and len(want) == 8
    assert ca.vector_neighbors(df, top=4, asked=asked.where("term = 999")).count() == 0 == ca.vector_neighbors(df.limit(0), top=4).count()


def test_phrases_shuffle_no_sentence(spark):
    size = Path("/root/testdata/sf0.01/documents.parquet").stat().st_size
    written, rows = shuffled(spark, lambda: entry.queries()["phrase_merge"](spark, "/root/testdata/sf0.01").count())
    assert rows and written <= 5 * size  # the documents themselves, dealt to all cores, are one of it


def test_pairs_are_counted_by_buckets(spark, monkeypatch):
    monkeypatch.setattr(te, "BUCKET", 50)
    rng = np.random.default_rng(4)
    lists = [[["가", "b", "", "c c", "d"][k] for k in rng.integers(0, 5, n)] for n in rng.integers(0, 9, 300)]
    rows = spark.createDataFrame([(x,) for x in [*lists, None, [], ["b"]]], "tokens array<string>").repartition(3)
    want = Counter(p for x in lists for p in pairwise(x))
    got = te.pair_counts(rows, "tokens", 40).collect()
    assert {(r["a"], r["b"]): r["n"] for r in got if r["a"] is not None} == {p: n for p, n in want.items() if n >= 40}
    assert sum(r["n"] for r in got if r["a"] is None) == len(want) and sum(r["a"] is None for r in got) > 1
    words = Counter(w for x in [*lists, ["b"]] for w in x)
    scores = {(r["a"], r["b"]): r["score"] for r in te.phrase_scores(rows, min_count=40, threshold=0.0).collect()}
    assert scores == {(a, b): pytest.approx((n - 40) / (words[a] * words[b]) * (len(words) + len(want)), abs=1e-6) for (a, b), n in want.items() if n > 40}
    assert te.pair_counts(rows.limit(0), "tokens", 1).count() == 0 == te.phrase_scores(rows.where("size(tokens) = 1"), min_count=1).count()


def test_many_phrases_shuffle_no_sentence(spark, monkeypatch):
    monkeypatch.setattr(te, "MOST_SENT", 100)
    rows = spark.createDataFrame([(k, [f"w{k % 50}", f"v{k % 40}", "x"]) for k in range(4000)], "k int, tokens array<string>")
    phrases = spark.createDataFrame([(f"w{k}", f"v{j}") for k in range(20) for j in range(40)], "a string, b string")
    written, out = shuffled(spark, lambda: {r["k"]: r["tokens"] for r in te.merged_tokens(rows, phrases, ["k"]).collect()})
    assert all(out[k] == ([f"w{k % 50}_v{k % 40}", "x"] if k % 50 < 20 else [f"w{k % 50}", f"v{k % 40}", "x"]) for k in range(4000))
    assert len(out) == 4000 and written <= 30_000  # the distinct phrases; sentences and places took more
