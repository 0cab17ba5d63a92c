"""Top-k search, collocations and fill-in-middle against plain computations."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from lexiloom.llm import collocations as co
from lexiloom.llm import fim, queries, topk

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = 2**63


# ---------------------------------------------------------------- top-k
def plain_top_k(rows, k=10, every=100, scale=1024):
    """rows: (id, vector) in any order; gives sorted (query_id, rank, vec_id, score)."""
    whole = []
    for i, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(float(x) * scale) for x in v]))
    out = []
    for a, (i, q) in enumerate(whole):
        if i is None or i % every:
            continue
        told = []
        for b, (j, v) in enumerate(whole):
            if a != b:
                s = sum(x * y for x, y in zip(q, v))  # noqa: B905  the shorter one is filled up with zeros
                told.append((-max(-LONG, min(LONG - 1, s)), j is not None, j or 0))
        for rank, (s, known, j) in enumerate(sorted(told)[:k], 1):
            out.append((i, rank, j if known else None, -s))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, r[3]))


def found_top_k(spark, rows, parts=3, **more):
    data = [(i, v, "x", 1, 2) for i, v in rows]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label string, score int, rank int").repartition(parts)
    return order(tuple(r) for r in topk.top_k(df, **more).collect())


def random_vectors(n, dims, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dims))
    return [(i, (spread * (rng.normal(size=dims) + centres[i % 7])).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed,n,dims,every", [(1, 700, 16, 10), (2, 300, 3, 7), (3, 900, 64, 50)])
def test_top_k_equals_brute_force(spark, monkeypatch, seed, n, dims, every):
    rows = random_vectors(n, dims, seed)
    assert found_top_k(spark, rows, every=every) == order(plain_top_k(rows, every=every))


def test_top_k_over_many_small_shards_and_cells(spark, monkeypatch):
    rows = random_vectors(3000, 8, 4) + [(i, [0.5] * 8) for i in range(3000, 3200)]  # ties beyond k
    assert found_top_k(spark, rows, parts=40, every=20, k=5) == order(plain_top_k(rows, every=20, k=5))


def test_top_k_cases(spark):
    rng = random.Random(5)
    rows = random_vectors(200, 5, 6)
    rows += [(100, None), (200, [1.0, None, 2.0]), (300, [float("nan")] * 5), (400, [float("inf"), 0.0]), (500, []), (600, [1.0]), (None, [9.0] * 5), (None, [9.0] * 5)]
    rows += [(0, [3.0] * 5), (0, [3.0] * 5), (700, [1e300, 1.0]), (-100, [-1e-9] * 9), (800, [1e17] * 5), (801, [-1e17] * 5)]
    rng.shuffle(rows)
    got = found_top_k(spark, rows)
    assert got == order(plain_top_k(rows))
    assert {r[0] for r in got} == {0, 100, 500, 600, 700, -100, 800} and (800, 1, None, LONG - 1) in got
    assert found_top_k(spark, []) == [] and found_top_k(spark, [(1, [1.0])]) == [] and found_top_k(spark, [(100, [1.0])]) == []
    assert found_top_k(spark, [(100, [1.0]), (200, [2.0])]) == [(100, 1, 200, 2048 * 1024), (200, 1, 100, 2048 * 1024)]


def test_a_shard_stops_only_on_proof():
    """Answers of the search with early stops, against all exact scores; and it does stop early."""
    rng = np.random.default_rng(7)
    vectors = np.floor(1024 * rng.normal(size=(2000, 12)))
    shard = topk.Shard(topk.Block(0, np.arange(2000), np.ones(2000, bool), vectors, np.arange(2000)), 12)
    short = 0
    for q in np.floor(1024 * rng.normal(size=(50, 12))):
        at, scores = shard.search(q, 10, 17, [])
        exact = (vectors @ q).astype(int)
        assert [exact[a] for a in at] == scores and 17 not in at
        assert set(sorted((-exact[i], i) for i in range(2000) if i != 17)[:10]) <= {(-s, a) for a, s in zip(at, scores, strict=True)}
        short += len(at) < 200
    assert short > 40


# ---------------------------------------------------------------- collocations
def plain_collocations(rows, most=4, least=30, share=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (t or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {}
        for p, a in counts.items():
            if len(p) > 1 and a >= least:
                found[p] = min((math.floor(Fraction(2_000_000 * a, counts[p[:k]] + counts[p[k:]])), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
        gone = {q[i : i + k] for q in found for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * counts[q] >= share * counts[q[i : i + k]]}
        kept = sorted(((-s, -counts[p], " ".join(p).encode(), p, lo, r) for p, (s, _, lo, r) in found.items() if p not in gone), key=lambda x: x[:3])
        out += [(lang, rank, " ".join(p), -a, lo, r, n[lang], -s) for rank, (s, a, _, p, lo, r) in enumerate(kept[:top], 1)]
    return sorted(out)


def phrase_rows(seed, docs=120):
    rng = random.Random(seed)
    fixed = ["new york city hall", "Rio de Janeiro", "state of the art", "état civil", "a b a b a", "日本 語 の 文"]
    words = ["the", "of", "and", "x\x00y", "é", "U", "zz", *(f"w{k}" for k in range(30))]
    out = []
    for k in range(docs):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 120))]
        gaps = "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ", ", "\n", "\x0b", " \r\n"]) for p in parts)
        out.append((gaps, ("en", "fr", None, "und", "")[k % 5 if k % 4 else 0]))
    return out


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"least": 3}), (3, {"least": 5, "most": 2, "top": 7}), (4, {"least": 2, "most": 6, "share": 50, "top": 9}), (5, {"least": 1, "most": 3})])
def test_collocations_equal_brute_force(spark, monkeypatch, seed, options):
    monkeypatch.setattr(co, "CHUNK", 900)
    rows = phrase_rows(seed) + [(None, "en"), ("", None), ("a", "en"), (" , .", "xx")] + [("one two three four five", "one")] * 40
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "text string, lang string, phrase string, f int").repartition(3)
    assert sorted(tuple(r) for r in co.collocations(df, **options).collect()) == plain_collocations(rows, **options)


def test_the_filter_only_saves_rows(spark, monkeypatch):
    rows = phrase_rows(8)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    monkeypatch.setattr(co, "pair_filter", lambda *a: None)
    assert sorted(tuple(r) for r in co.collocations(df, least=4).collect()) == plain_collocations(rows, least=4)


def test_collocations_of_nothing_and_of_long_texts(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert co.collocations(empty).collect() == []
    rows = [("ab cd " * 40_000, "en"), ("q" * 200_000 + " r", "en")]
    assert sorted(tuple(r) for r in co.collocations(spark.createDataFrame(rows, "text string, lang string")).collect()) == plain_collocations(rows)


def test_products_beyond_64_bits(spark):
    a = 4 * 10**18
    df = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, a), ("en", "y", 1, a + 1)], "lang string, phrase string, size int, f long")
    got = co.scored(df).first()
    assert (got["a"], got["score"]) == (a, 2_000_000 * a // (2 * a + 1))


def test_words_are_those_of_the_pattern():
    texts = ["A b\tC.d\x0b e\x00f \xa0 g", "", "  x", "É;É\r\n日本 語\x1fz"]
    words = co.Words([t.encode() for t in texts])
    made = [words.dictionary[int(i)].as_py().decode() for i in words.ids]
    pieces = [[w for w in re.split(r"[ \t]+", p) if w] for t in texts for p in re.split(r"[.,;:!?\n-\r]", t.translate(LOWER))]
    assert made == [w for p in pieces for w in p]
    assert Counter(words.piece.tolist()).values() and sorted(Counter(words.piece.tolist()).values()) == sorted(len(p) for p in pieces if p)


# ---------------------------------------------------------------- fill in the middle
def plain_fim(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_rows():
    rng = random.Random(9)
    line = lambda: "".join(rng.choice("ab é日👍<PSM>\r\t") for _ in range(rng.randint(0, 12)))
    texts = ["\n".join(line() for _ in range(rng.randint(0, 15))) for _ in range(150)]
    texts += [None, "", "\n", "\n\n\n", "one", "one\n", "<P>", "a<S>b\n", "<M\n>", "<", "x" * 150_000, "line\n" * 30_000, "\x00\n﻿ \x85x", "a\r\nb"]
    return list(enumerate(texts)) + [(7, "again\nand\nagain"), (7, "again\nand\nagain"), (None, "no id\nhere\nat all"), (2**62, "big\nid\n")]


@pytest.mark.parametrize("options", [{}, {"seed": 3, "rate": 40, "spm_rate": 10}, {"rate": 0}])
def test_fim_equals_a_plain_computation(spark, options):
    rows = fim_rows()
    df = spark.createDataFrame([(*r, 5, "p") for r in rows], "doc_id long, text string, n int, form string").repartition(3)
    made = fim.fill_in_middle(df, out="made", **options)
    made = made.withColumn("back", fim.restored(made["made.output"], made["made.form"]))
    got = sorted(((r["doc_id"], r["text"], *r["made"], r["back"], r["n"], r["form"]) for r in made.collect()), key=repr)
    assert got == sorted(((i, t, *plain_fim(i, t, **options), t or "", 5, "p") for i, t in rows), key=repr)
    assert len({r[3] for r in got}) == (1 if options.get("rate") == 0 else 3)


def test_fim_of_no_rows_and_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, __FIM int, h0 int")
    assert fim.fill_in_middle(empty).collect() == [] and fim.fill_in_middle(empty).columns == ["doc_id", "text", "h0", "__fim"]


# ---------------------------------------------------------------- the registered queries
def test_registered_queries(spark, tmp_path):
    vectors = [(i, [float(np.float32(x)) for x in v], 1) for i, v in random_vectors(450, 6, 11, 0.3)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    docs = [(i, t, ("en", None)[i % 2], "s", 3) for i, (t, _) in enumerate(phrase_rows(12, 200))]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: [tuple(r) for r in queries.queries()[name](spark, str(tmp_path)).collect()]
    assert order(run("op11_exact_top_k")) == order(plain_top_k([(i, v) for i, v, _ in vectors]))
    assert sorted(run("op12_collocations")) == plain_collocations([(t, lang) for _, t, lang, *_ in docs])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    plain = [(i, *plain_fim(i, t)) for i, t, *_ in docs]
    assert sorted(run("op13_fill_in_middle")) == sorted((*p[:5], sha(p[5]), sha(t)) for p, (_, t, *_) in zip(plain, docs, strict=True))


def test_integers_of_vectors():
    take, q = topk.integers(pa.array([[0.5, -0.0001], None, [1.0, None], [], [2.0, 1.0, 1.0], [float("inf")]], pa.list_(pa.float64())), 1024)
    assert take.tolist() == [0, 3, 4] and q.tolist() == [[512, -1, 0], [0, 0, 0], [2048, 1024, 1024]]
