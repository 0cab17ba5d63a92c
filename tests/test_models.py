"""Factors, n-gram vectors, pruned profiles and the vector index against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.operators import candidates as ca
from lexiloom.operators import embedding as em
from lexiloom.operators import index as ix

WEIGHTS = "term string, ctx string, weight double"


def unit(m):
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(size == 0, 1, size)


def dense(rows):
    terms, ctx = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    m = np.zeros((len(terms), len(ctx)))
    for t, c, w in rows:
        m[terms.index(t), ctx.index(c)] = w
    return terms, m


def structured(seed, n=30, k=6, share=0.5):
    """A table of low rank, some noise and holes."""
    rng = np.random.default_rng(seed)
    m = np.abs(rng.normal(size=(n, k))) @ np.abs(rng.normal(size=(k, 20))) * (rng.random((n, 20)) < share) + 0.01
    return [(f"t{i}", f"c{j}", float(m[i, j])) for i in range(n) for j in range(20) if m[i, j] > 0.02]


def vectors_of(df):
    return {r["term"]: np.array(r["vector"]) for r in df.collect()}


def test_factors_are_the_singular_vectors(spark):
    rows = structured(1)
    terms, m = dense(rows)
    u, s, _ = np.linalg.svd(m, full_matrices=False)
    df = spark.createDataFrame(rows, WEIGHTS).repartition(5)
    for power in (0.5, 1.0):
        got = vectors_of(em.factors(df, size=4, more=14, rounds=3, power=power))
        made, want = np.stack([got[t] for t in terms]), u[:, :4] * s[:4] ** power
        assert np.allclose(made @ made.T, want @ want.T, atol=1e-3 * s[0])  # the same up to a rotation
    again = vectors_of(em.factors(df.repartition(3), size=4, more=14, rounds=3))
    first = vectors_of(em.factors(df, size=4, more=14, rounds=3))
    a, b = (unit(np.stack([x[t] for t in terms])) for x in (again, first))
    assert np.allclose(a @ a.T, b @ b.T, atol=1e-6)


def test_factors_of_small_tables(spark):
    """Fewer terms than columns; one weight; none."""
    got = vectors_of(em.factors(spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0), ("b", "y", 1.0)], WEIGHTS), size=5))
    made = np.stack([got["a"], got["b"]])
    m = np.array([[1.0, 0], [2, 1]])
    u, s, _ = np.linalg.svd(m)
    want = u * s**0.5
    assert made.shape == (2, 5) and np.allclose(made @ made.T, want @ want.T, atol=1e-6)
    assert em.factors(spark.createDataFrame([], WEIGHTS), size=5).count() == 0


def plain_grams(term, lo, hi):
    marked = f"<{term.lower()}>"
    return list(dict.fromkeys(marked[i : i + n] for n in range(lo, hi + 1) for i in range(max(1, len(marked) - n + 1))))


def test_subwords_against_numpy(spark):
    rng = np.random.default_rng(3)
    known = {t: rng.normal(size=4) for t in ("store", "stores", "opening", "open", "bank", "")}
    terms = [("store", 9), ("stores", 4), ("opening", 1), ("open", 16), ("bank", 2), ("Storess", 1), ("zq", 3), ("", 1), ("b" * 300, 1)]
    df = spark.createDataFrame([(t, v.tolist()) for t, v in known.items()], "term string, vector array<double>")
    got = vectors_of(em.with_subwords(df, spark.createDataFrame(terms, "term string, frequency long"), 3, 4, 0.7))
    sums, weight = {}, {}
    for t, n in terms:
        for g in plain_grams(t, 3, 4) if t in known else ():
            sums[g] = sums.get(g, 0) + n**0.5 * known[t]
            weight[g] = weight.get(g, 0) + n**0.5
    for t, _ in terms:
        spelled = sum((sums[g] / weight[g] for g in plain_grams(t, 3, 4) if g in sums), np.zeros(4))
        want = unit(known.get(t, np.zeros(4))[None])[0] + 0.7 * unit(spelled[None])[0]
        assert np.allclose(got[t], want, atol=1e-9), t
    assert len(got) == len(terms) and not got["zq"].any()
    near = {r["other"] for r in ca.vector_neighbors(em.with_subwords(df, spark.createDataFrame(terms, "term string, frequency long")), top=2).where("term = 'Storess'").collect()}
    assert "stores" in near
    assert not vectors_of(em.with_subwords(df.limit(0), spark.createDataFrame(terms, "term string, frequency long")))["open"].any()
    assert em.no_neighbors(df).count() == 0


# ---------------------------------------------------------------- profiles
def plain_neighbors(rows, top):
    terms, m = dense(rows)
    m = unit(m)
    s = np.round(m @ m.T, 6)
    both = (m > 0).astype(float) @ (m > 0).T.astype(float) > 0
    out = set()
    for i, t in enumerate(terms):
        told = sorted((-s[i, j], terms[j]) for j in range(len(terms)) if j != i and both[i, j])
        out |= {(t, o, round(-x, 6), k) for k, (x, o) in enumerate(told[:top], 1)}
    return out


@pytest.mark.parametrize("seed,light,salt", [(1, 1, 1), (2, 3, 2), (3, 8, 4096), (4, 12, 5), (5, 10**6, 7)])
def test_pruned_profiles_are_the_exact_ones(spark, monkeypatch, seed, light, salt):
    """Whatever counts as a heavy context, and however its terms are dealt."""
    monkeypatch.setattr(ca, "SALT_TERMS", salt)
    rng = np.random.default_rng(seed)
    rows = [(f"t{i}", "everywhere", float(rng.random() + 0.1)) for i in range(50)] + [("alone", "everywhere", 1.0), ("lonely", "own", 2.0)]
    rows += [(f"t{i}", f"c{int(j)}", float(rng.random() * 3 + 0.01)) for i in range(50) for j in np.unique((rng.random(6) ** 2 * 40).astype(int))]
    df = spark.createDataFrame(rows, WEIGHTS).repartition(3)
    got = {(r["term"], r["other"], round(r["similarity"], 6), r["rank"]) for r in ca.profile_neighbors(df, top=6, light=light).collect()}
    want = plain_neighbors(rows, 6)
    assert {g[:2] for g in got} == {w[:2] for w in want} and len(got) == len(want)
    assert {(t, o): s for t, o, s, _ in got} == pytest.approx({(t, o): s for t, o, s, _ in want}, abs=2e-6)


def test_a_context_of_very_many_terms(spark, monkeypatch):
    """Terms with neighbours of their own aren't paired with all that share the context."""
    n = 19_995
    terms = spark.range(n).select(F.concat(F.lit("t"), "id").alias("term"), "id")
    rows = terms.select("term", F.lit("hot").alias("ctx"), F.lit(0.2).alias("weight"))
    rows = rows.unionByName(terms.select("term", F.concat(F.lit("c"), F.floor(F.col("id") / 15).cast("string")).alias("ctx"), F.lit(1.0).alias("weight")))
    met = {}
    pairs = ca._heavy_pairs
    monkeypatch.setattr(ca, "_heavy_pairs", lambda *a: met.setdefault("rows", pairs(*a)))
    got = ca.profile_neighbors(rows, top=5)
    assert got.count() == 5 * n and got.agg(F.min("similarity")).first()[0] == 1.0
    assert met["rows"].count() <= 15 * n  # of n * n pairs that share it


# ---------------------------------------------------------------- the index
def points(seed, n, dims=24, centres=40):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(centres, dims))[rng.integers(0, centres, n)] + 0.5 * rng.normal(size=(n, dims))


def test_the_index_finds_nine_of_ten(spark, monkeypatch):
    monkeypatch.setattr(ix, "PART_ROWS", 40)  # cells of many parts
    m = points(1, 1500)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "term long, vector array<double>").repartition(4)
    found, exact = ix.indexed_neighbors(df, top=10, cells=40, probes=8), ca.vector_neighbors(df, top=10)
    figures = ix.recall(found, exact).first()
    assert figures["asked"] == 15_000 and figures["recall"] >= 0.9 and ix.overlap(found, exact).first()["recall"] >= 0.9
    s = unit(m) @ unit(m).T
    rows = found.collect()
    assert all(abs(r["similarity"] - s[r["term"], r["other"]]) < 1e-5 and r["term"] != r["other"] for r in rows)
    assert len(rows) == len({(r["term"], r["other"]) for r in rows}) == 15_000
    flat = np.random.default_rng(2).normal(size=(600, 16))  # without any structure
    df = spark.createDataFrame([(f"k{i}", v.tolist()) for i, v in enumerate(flat)], "term string, vector array<double>")
    assert ix.recall(ix.indexed_neighbors(df, top=5), ca.vector_neighbors(df, top=5)).first()["recall"] >= 0.9


def test_index_cases(spark):
    rows = [("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("z", [0.0, 0.0]), ("n", None), ("e", []), ("h", [1.0, None]), ("x", [float("nan"), 1.0]), ("long", [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "term string, vector array<double>, near double")
    got = {(r["term"], r["other"]): r["similarity"] for r in ix.indexed_neighbors(df, top=5).collect()}
    assert set(got) == {(x, y) for x in "abz" for y in "abz" if x != y} and got["a", "z"] == 0 and got["a", "b"] == pytest.approx(0.995037, abs=1e-6)
    assert ix.indexed_neighbors(df.limit(0)).count() == 0 and ix.indexed_neighbors(df.where("term = 'a'")).count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(30)], "term int, vector array<double>")
    assert ix.indexed_neighbors(same, top=3).count() == 90
    assert ix.recall(df.select("term", F.lit(1.0).alias("similarity")).limit(0), df.select("term", F.lit(1.0).alias("similarity")).limit(0)).first()["recall"] is None
