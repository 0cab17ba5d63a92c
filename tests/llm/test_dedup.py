"""Exact and line dedup: cases, and brute force on a small fixture."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexiloom.llm import line_dedup as line_module
from lexiloom.llm import store
from lexiloom.llm.exact_dedup import DigestIndex, exact_dedup
from lexiloom.llm.line_dedup import LineIndex, line_dedup
from lexiloom.llm.store import Shelf, batch_of, batches_for

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, id string, digest int, keep_id int, n_lines string, hash string"


def docs(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "x", 1, 2, "y", "z") for i, t in rows], DOCS)


def test_exact(spark):
    rows = [(1, "Same"), (2, "sAME"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 300_000), (8, "X" * 300_000), (9, "same "), (9, "same ")]
    got = {(r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(docs(spark, rows)).collect()}
    assert got == {(1, 2, 2, False), (2, 2, 2, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True), (7, 8, 2, False), (8, 8, 2, True), (9, 9, 2, True)}


def test_exact_nulls_and_nothing(spark):
    got = exact_dedup(docs(spark, [(None, "a"), (1, "a"), (None, "b"), (None, "b")])).collect()
    assert sorted(((r["id"] or 0), r["kept"]) for r in got) == [(0, False), (0, True), (0, True), (1, True)]
    assert exact_dedup(docs(spark, [])).count() == 0


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_against_brute_force(spark, keep, weak):
    """Also with a digest of two bits: texts of one digest are told apart by their bytes."""
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", "Ab", "aB", "", "hot", "hot", "hot"]) * rng.randint(1, 2)) for i in range(300)]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t.translate(LOWER)].append(i)
    best = max if keep == "largest" else min
    want = {(i, best(groups[t.translate(LOWER)]), len(groups[t.translate(LOWER)])) for i, t in rows}
    options = {"digest": lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 1))} if weak else {}
    got = exact_dedup(docs(spark, rows), keep=keep, memtables=5, fanout=2, **options).collect()
    assert {(r["id"], r["keep_id"], r["group_size"]) for r in got} == want and len(got) == len(rows)


def test_exact_answer_is_the_runs(spark, monkeypatch):
    """What the runs hold is what comes out: with other identifiers in them, the result has those."""
    merged = DigestIndex.merged
    monkeypatch.setattr(DigestIndex, "merged", lambda self, rows: merged(self, rows).withColumn("keep_id", F.col("keep_id") + 1000).withColumn("n", F.col("n") + 0))
    rows = [(i, "copy" if i % 3 else f"own {i}") for i in range(40)]
    got = {r["id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup(docs(spark, rows)).collect()}
    assert got[0] == (0, 1) and got[3] == (3, 1)
    keep, size = got[1]
    assert keep > 1000 and size == 26


@pytest.mark.parametrize("heavy", [1, 20, 10_000])
def test_hot_groups(spark, monkeypatch, heavy):
    """The same result whether groups go by broadcast or by merge join."""
    monkeypatch.setattr(store, "HEAVY", heavy)
    monkeypatch.setattr(line_module, "HEAVY", heavy)
    rows = [(i, "" if i % 3 == 0 else f"a line in all of them\nown line {i % 7}\nown {i}") for i in range(120)]
    got = exact_dedup(docs(spark, rows)).collect()
    assert {(r["id"], r["keep_id"], r["group_size"]) for r in got} == {(i, 117, 40) if i % 3 == 0 else (i, i, 1) for i, _ in rows} and len(got) == 120
    got = line_dedup(docs(spark, rows), min_chars=8, min_docs=3).collect()
    want = brute(rows, 8, 3)
    assert {r["doc_id"]: (r["__lines"]["n_lines"], r["__lines"]["n_dropped"], hashlib.sha256(r["__lines"]["text"].encode()).hexdigest()) for r in got} == want and len(got) == 120


def test_batches(spark):
    assert [batches_for(n) for n in (0, 10**6, 10**7, 5 * 10**10)] == [3, 3, 5, 17]
    got = {r["b"]: r["count"] for r in spark.range(8000).select(batch_of(F.col("id"), 4).alias("b")).groupBy("b").count().collect()}
    assert sorted(got) == [0, 1, 2, 3] and 900 < got[0] < 1100 and 900 < got[1] < 1100 and 3800 < got[3] < 4200


def test_line_index(spark):
    """A hash has one fresh row over all runs, and the totals need it: other marks give other totals."""
    rng = random.Random(9)
    batches = [[(i, bytes([rng.randrange(30)])) for i in range(k * 100, k * 100 + 60)] for k in range(4)]
    index = LineIndex(Shelf(spark, "test"))
    for k, b in enumerate(batches):
        index.add(spark.createDataFrame(b, "id long, hash binary"), more=k < 3)
    assert len(index.runs()) == 3  # the first two batches were compacted before the third came
    fresh = [bytes(r["hash"]) for run in index.runs() for r in run.where("fresh").collect()]
    assert sorted(fresh) == sorted({h for b in batches for _, h in b})
    want = defaultdict(list)
    for b in batches:
        for i, h in b:
            want[h].append(i)
    got = {bytes(r["hash"]): (r["n_docs"], r["last"]) for r in index.totals().collect()}
    assert got == {h: (len(v), max(v)) for h, v in want.items()}
    index.shelf = Shelf(spark, "test")
    index.tables = {k: t.withColumn("fresh", F.lit(True)) for k, t in index.tables.items()}
    assert index.totals().count() > len(want)


def test_runs_meet_without_exchange(spark):
    """Merge joins of runs, and of a grouped batch with a run, shuffle no run."""
    shelf = Shelf(spark, "test")
    run = shelf.run(spark.range(1000).select(F.col("id").cast("string").cast("binary").alias("hash")), "run", "hash")
    batch = spark.range(100).select(F.col("id").cast("string").cast("binary").alias("hash")).groupBy("hash").count()
    plan = batch.join(run.hint("merge"), "hash", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
    shelf.drop("run")


def test_lines_clashing_names(spark):
    names = ["doc_id", "text", "__go", "__id", "go", "id", "doc", "stay", "to", "hash", "batch", "last"]
    rows = [(i, "a common line\nown", *[f"{n}{i}" for n in names[2:]]) for i in range(6)]
    got = line_dedup(spark.createDataFrame(rows, names), min_chars=5, min_docs=3, out="lines").orderBy("doc_id").collect()
    assert got[0].asDict()["__go"] == "__go0" and got[0]["doc"] == "doc0" and [r["lines"]["text"] for r in got] == ["own"] * 5 + ["a common line\nown"]
    got = line_dedup(spark.createDataFrame([(1, "x", "old")], ["doc_id", "text", "__lines"]))
    assert got.columns == ["doc_id", "text", "__lines"] and got.first()["__lines"]["text"] == "x"
    texts = line_dedup(spark.createDataFrame([(c, "a common line") for c in "abc"], ["doc_id", "text"]), min_chars=5, min_docs=3)
    assert {r["doc_id"]: r["__lines"]["text"] for r in texts.collect()} == {"a": "", "b": "", "c": "a common line"}  # ids of any type


def test_index_refuses(spark):
    with pytest.raises(ValueError, match="keep"):
        DigestIndex(None, keep="first")


def brute(rows, min_chars, min_docs):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and max(held[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest())
    return out


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    pool = ["  Common LINE one ", "common line one", "É common line", "é common line", "short", "", "\tTabbed common line\r", "last common line"]
    rows = [(i, "\n".join(rng.choice([*pool, f"own line number {i} {k}"]) for k in range(rng.randint(0, 7)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "common line one\n" * 3), (103, "only common line one".replace("only ", "")), (104, "x" * 200_000 + "\ncommon line one\n")]
    got = line_dedup(docs(spark, rows), min_chars=8, min_docs=3, batches=4, fanout=2).collect()
    want = brute(rows, 8, 3)
    assert {r["doc_id"]: (r["__lines"]["n_lines"], r["__lines"]["n_dropped"], hashlib.sha256(r["__lines"]["text"].encode()).hexdigest()) for r in got} == want and len(got) == len(rows)
    assert got[0]["lang"] == "en" and got[0]["n_lines"] == "y"  # further columns stay


def test_very_many_common_lines(spark):
    """Time grows with the lines: each of them is looked at once, however many are common."""
    text = "\n".join(f"this is a common line of some length, number {k // 2}" for k in range(60_000))
    rows = [(k, text) for k in range(6)] + [(9, text + "\nend"), (9, "begin\n" + text), (None, text), (None, "x\n" + text), (None, "x\n" + text)]
    got = line_dedup(docs(spark, rows), min_chars=20).selectExpr("doc_id", "__lines.n_lines n", "__lines.n_dropped d", "substring(__lines.text, 1, 9) t").collect()
    want = [(k, 60_000, 60_000, "") for k in range(6)] + [(9, 60_001, 0, "this is a"), (9, 60_001, 0, "begin\nthi")]
    want += [(None, 60_000, 60_000, ""), (None, 60_001, 60_000, "x"), (None, 60_001, 60_000, "x")]
    assert Counter(map(tuple, got)) == Counter(want)


def test_lines_rows_of_one_id(spark):
    rows = [(7, "a common line"), (7, "a common line"), (None, "a common line"), (3, "a common line"), (None, "null only line"), (None, "null only line"), (None, "null only line")]
    got = line_dedup(docs(spark, rows), min_chars=5, min_docs=3).collect()
    assert sorted((r["doc_id"] or 0, r["__lines"]["text"]) for r in got) == [(0, ""), (0, "null only line"), (0, "null only line"), (0, "null only line"), (3, ""), (7, "a common line"), (7, "a common line")]
    assert line_dedup(docs(spark, [])).count() == 0
