import random

import numpy as np
from pyspark.sql import functions as F

from lexiloom.operators import candidates as ca
from lexiloom.session import written


def terms(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "term string")


def rows(df, *cols):
    return {tuple(r[c] for c in cols) for r in df.collect()}


def test_lexical(spark):
    t = terms(spark, "메일_인증", "인증_메일", "인덱스", "전문_인덱스", "API", "Application_Programming_Interface", "e-mail", "email")
    got = {(r["a"], r["b"]): (r["sources"], r["score"]) for r in ca.lexical_pairs(t).collect()}
    assert got == {("메일_인증", "인증_메일"): (["LEXICAL"], 1.0), ("인덱스", "전문_인덱스"): (["CONTAINMENT"], 0.5), ("API", "Application_Programming_Interface"): (["LEXICAL"], 0.9), ("e-mail", "email"): (["LEXICAL"], 1.0)}


def test_cooccurrence_counts_by_place(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c"],)], "tokens array<string>")
    got = {(r["term"], r["ctx"]): r["n"] for r in ca.cooccurrence(df, window=2).collect()}
    assert got[("a", "a")] == 2 and got[("a", "b")] == 2 and got[("b", "c")] == 1 and ("a", "d") not in got


def test_profiles_against_numpy(spark):
    rng = random.Random(4)
    sents = [[rng.choice("abcdef") for _ in range(rng.randint(2, 8))] for _ in range(40)]
    df = spark.createDataFrame([(s,) for s in sents], "tokens array<string>")
    freq = df.select(F.explode("tokens").alias("term")).groupBy("term").count().withColumnRenamed("count", "n")
    names = "abcdef"
    m = np.zeros((6, 6))
    for s in sents:
        for i, x in enumerate(s):
            for j in range(max(0, i - 2), min(len(s), i + 3)):
                if i != j:
                    m[names.index(x), names.index(s[j])] += 1
    w = np.log(np.where(m > 0, m * m.sum() / np.outer(m.sum(1), m.sum(0)), 1e-12) + 1e-12)
    w = np.where((m > 0) & (w > 0), w, 0)
    u = w / np.maximum(np.sqrt((w * w).sum(1, keepdims=True)), 1e-9)
    got = ca.profile_neighbors(ca.ppmi(ca.cooccurrence(df, window=2), freq), top=5)
    for r in got.collect():
        assert abs(r["similarity"] - (u @ u.T)[names.index(r["term"]), names.index(r["other"])]) < 1e-5


def test_vectors_against_numpy(spark):
    v = np.random.default_rng(1).normal(size=(60, 8)).round(3)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "term long, vector array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -9)
    want = {(i, int(j)) for i in range(60) for j in np.argsort(-s[i], kind="stable")[:4]}
    assert rows(ca.vector_neighbors(df, top=4, block=16), "term", "other") == want


def neighbors(spark, lists):
    data = [(t, o, s, k + 1) for t, own in lists.items() for k, (o, s) in enumerate(own)]
    return spark.createDataFrame(data, "term string, other string, similarity double, rank int")


def test_ranks_after_filtering(spark):
    cat = spark.createDataFrame([("QX", 9, ""), ("매장", 9, ""), ("패밀리_오픈", 9, ""), ("x", 1, "stopword")], "term string, frequency int, excluded_reason string")
    near = neighbors(spark, {"QX": [("x", 0.99), ("매장", 0.97), ("패밀리_오픈", 0.95), ("F_O", 0.9)], "패밀리_오픈": [("QX", 0.95)]})
    fused = ca.fuse([ca.neighbor_pairs(ca.valid_neighbors(near, cat), "FASTTEXT", 0.5)])
    got = {(r["a"], r["b"]): (r["rank_ab"], r["rank_ba"], r["similarity"]) for r in fused.collect()}
    assert got == {("QX", "패밀리_오픈"): (2, 1, 0.95), ("QX", "매장"): (1, None, 0.97)}


def test_mutual(spark):
    near = neighbors(spark, {"a": [("b", 0.9), ("c", 0.8), ("d", 0.7)], "b": [("a", 0.9)], "d": [("c", 0.9), ("a", 0.7)]})
    got = rows(ca.mutual_pairs(ca.neighbor_pairs(near, "FASTTEXT", 0.0), 3, 1), "a", "b")
    assert got == {("a", "b"), ("c", "d"), ("a", "d")}


def test_fusion_and_priority(spark):
    lex = spark.createDataFrame([("a", "b", 1.0)], "a string, b string, score double")
    near = neighbors(spark, {"a": [("b", 0.9)], "b": [("a", 0.9)], "c": [("a", 0.8)]})
    fused = ca.fuse([ca.scored_pairs(lex, "LEXICAL", "lexical"), ca.neighbor_pairs(near, "FASTTEXT", 0.0), ca.neighbor_pairs(near, "CONTEXT_PROFILE", 0.0)])
    got = {(r["a"], r["b"]): (r["sources"], r["priority"]) for r in fused.collect()}
    assert got[("a", "b")] == (["CONTEXT_PROFILE", "FASTTEXT", "LEXICAL"], round(0.45 + 0.3 + 0.09 + 0.15 + 0.3, 6))
    assert got[("a", "c")] == (["CONTEXT_PROFILE", "FASTTEXT"], round(0.3 * 0.5 + 0.08 + 0.15, 6))
    assert rows(ca.corroborated(fused), "a", "b") == {("a", "b")}
    out = spark.createDataFrame([("a||b",)], "pair_key string")
    assert rows(ca.without_excluded(fused, out), "a", "b") == {("a", "c")}
    assert {(r["source"], r["n"]) for r in ca.source_counts(fused).collect()} == {("LEXICAL", 1), ("FASTTEXT", 2), ("CONTEXT_PROFILE", 2)}


def scan(pairs, cap):
    degree, out = {}, set()
    for a, b, _ in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if degree.get(a, 0) < cap and degree.get(b, 0) < cap:
            out.add((a, b))
            degree[a], degree[b] = degree.get(a, 0) + 1, degree.get(b, 0) + 1
    return out


def test_degree_cap_is_the_scan(spark):
    rng = random.Random(9)
    pairs = {tuple(sorted(rng.sample(range(25), 2))): rng.randint(0, 20) / 10 for _ in range(150)}
    pairs |= {(0, k): 0.5 for k in range(1, 11)}
    data = [(f"t{a:02}", f"t{b:02}", s) for (a, b), s in pairs.items()]
    df = spark.createDataFrame(data, "a string, b string, priority double")
    for cap, scanned in ((1, 0), (3, 0), (2, 40), (1, 1 << 20)):  # all in rounds, some of each, all scanned
        assert rows(ca.degree_capped(df, cap, written(spark), scanned=scanned), "a", "b") == scan(data, cap)


def test_a_chain_takes_no_round_for_each_pair(spark):
    data = [(f"t{k:04}", f"t{k + 1:04}", 1.0 - k / 1000) for k in range(400)]
    made = []
    put = written(spark)
    got = ca.degree_capped(spark.createDataFrame(data, "a string, b string, priority double"), 1, lambda df, name: made.append(name) or put(df, name), scanned=396)
    assert rows(got, "a", "b") == scan(data, 1) == {(a, b) for k, (a, b, _) in enumerate(data) if k % 2 == 0} and len(made) < 10


def test_nothing_to_cap(spark):
    df = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 0.5)], "a string, b string, priority double")
    data = df.collect()
    assert ca.degree_capped(df, 0, None).count() == len(data) and ca.degree_capped(df.limit(0), 2, written(spark)).count() == 0 and ca.degree_capped(df.where('false'), 2, written(spark), scanned=0).count() == 0
