"""Listings as streams with cursors, publishing of changed rows, and the trained splitter."""

import json

import pytest
from pyspark.sql import functions as F

from lexiloom.operators import splitter as sp
from lexiloom.sources import publishing as pb
from lexiloom.sources import readers as rd
from lexiloom.sources.keyed import KeyedTable

MODULE = """
import json, pathlib
ROOT = pathlib.Path({root!r})

def publish(row):
    if (ROOT / "down").exists() and row["page_id"] == "c":
        raise PermissionError("down")
    with open(ROOT / "out.txt", "a") as f:
        f.write(json.dumps(row) + "\\n")

def finish(n):
    (ROOT / "finished").write_text(str(n))

def failed(n):
    (ROOT / "failed").write_text(str(n))
"""


@pytest.fixture(scope="module")
def shelf(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("listing")
    (root / "listing_functions.py").write_text(MODULE.format(root=str(root)).replace("\\\\", "\\"))
    spark.sparkContext.addPyFile(str(root / "listing_functions.py"))
    return root


def test_a_listing_goes_on_where_it_ended(spark, shelf, tmp_path):
    root = str(shelf)

    def fetch(space, cursor):
        with open(f"{root}/{space}.json") as f:
            rows = json.loads(f.read())
        n = int(cursor or 0)
        return rows[n : n + 2], (str(n + 2) if n + 2 < len(rows) else None)

    spark.dataSource.register(rd.PagedSource.over(fetch))

    def run(pages):
        source = spark.readStream.format("paged").option("spaces", "A,B").option("pages", str(pages)).load()
        query = source.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out")).trigger(once=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted((r["space"], r["value"]) for r in spark.read.schema("space string, value string").parquet(str(tmp_path / "out")).collect())

    (shelf / "A.json").write_text(json.dumps([f"a{k}" for k in range(5)]))
    (shelf / "B.json").write_text(json.dumps(["b0"]))
    assert run(2) == [("A", "a0"), ("A", "a1"), ("A", "a2"), ("A", "a3"), ("B", "b0")]
    assert run(2) == [("A", f"a{k}") for k in range(5)] + [("B", "b0")]
    assert len(run(2)) == 6  # nothing new, nothing read again
    (shelf / "B.json").write_text(json.dumps(["b0", "b1", "b2"]))
    got = run(9)
    assert set(got) == {*(("A", f"a{k}") for k in range(5)), ("B", "b0"), ("B", "b1"), ("B", "b2")} and got.count(("A", "a4")) == 1


def test_only_changed_rows_are_published(spark, shelf, tmp_path):
    kind = "page_id string, title string, body string"
    store = str(tmp_path / "hashes")

    def publish(rows, stored):
        counts = pb.publish_changed(spark.createDataFrame(rows, kind), "listing_functions:publish", stored, store, finish="listing_functions:finish", failed="listing_functions:failed").first()
        return counts["new"], counts["changed"], counts["same"]

    out = lambda: [json.loads(x)["page_id"] for x in (shelf / "out.txt").read_text().splitlines()]
    assert publish([("a", "t", "1"), ("b", "t", "1")], None) == (2, 0, 0) and sorted(out()) == ["a", "b"] and (shelf / "finished").read_text() == "2"
    again = [("a", "t", "1"), ("b", "t", "2"), ("c", None, None)]
    (shelf / "down").write_text("")
    with pytest.raises(Exception, match="down"):
        publish(again, spark.read.parquet(store))
    assert (shelf / "failed").exists() and spark.read.parquet(store).count() == 2  # what failed isn't stored
    (shelf / "down").unlink()
    assert publish(again, spark.read.parquet(store)) == (1, 1, 1) and out().count("a") == 1
    assert publish(again, spark.read.parquet(store)) == (0, 0, 3)


# ---------------------------------------------------------------- keyed tables
def test_keyed_writes_touch_their_partitions_only(spark, tmp_path):
    path, kind = str(tmp_path / "table"), "k long, v string"
    frame = lambda rows, kind=kind: spark.createDataFrame(rows, kind)
    table = KeyedTable(spark, path, ["k"], 8)
    assert not table.exists()
    want = {k: f"v{k}" for k in range(100)} | {None: "none"}
    table.put(frame(list(want.items())))
    files = lambda: {p.relative_to(path): p.stat().st_mtime_ns for p in (tmp_path / "table").glob("*/*.parquet")}
    before = files()
    table = KeyedTable(spark, path, ["k"], 99)  # the table's own number counts
    assert table.buckets == 8 and len(before) == 8
    touched = table.put(frame([(5, "new"), (None, "other")]))
    want |= {5: "new", None: "other"}
    stay = {p: t for p, t in before.items() if int(p.parts[0].split("=")[1]) not in touched}
    assert 1 <= len(touched) <= 2 and len(stay) == 8 - len(touched) and stay.items() <= files().items()
    table.add(frame([(5, "late"), (200, "added")]))
    want |= {200: "added"}
    assert {r["k"]: r["v"] for r in table.read().collect()} == want and table.read().count() == len(want)
    assert table.put(frame([])) == [] and table.read().columns == ["k", "v"]
    table.put(frame([(7, "x", 1)], kind + ", more int"))
    assert {(r["k"], r["more"]) for r in table.read().where("k in (7, 8)").collect()} == {(7, 1), (8, None)}
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="isn't a keyed table"):
        KeyedTable(spark, str(tmp_path / "plain"), ["id"])


# ---------------------------------------------------------------- splitter
def lines():
    out = []
    for k in range(60):
        out.append(f"Dr. Kim met Prof. Lee at the store number {k}. The store opened early. However they left.")
        out.append(f"We saw items e.g. apples and pears, approx. {k} of them. The rest was sold. However nobody came.")
        out.append(f"A long word is not short. Stores sell words. The word store sells, and short stores open {k}. Words here are few and they came early and left the items that nobody sold them here.")
    return out


def test_abbreviations_are_learned(spark):
    docs = spark.createDataFrame([(t,) for t in [*lines(), None, ""]], "text string").repartition(3)
    short, starters = sp.trained(docs)
    assert {"dr", "prof", "e.g", "approx"} <= set(short) and not {"early", "left", "sold", "came", "words", "short", "them"} & set(short)
    assert {"the", "however"} <= set(starters) and not {"kim", "apples"} & set(starters)
    text = "Dr. Kim met Prof. Lee. We saw approx. The end. See e.g. apples."
    got = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(sp.split_trained(F.col("t"), short, starters).alias("s")).collect()
    assert [r["s"] for r in got] == [["Dr. Kim met Prof. Lee.", "We saw approx.", "The end.", "See e.g. apples."], [], []]
    assert sp.trained(docs.limit(0)) == ([], [])
    plain = spark.createDataFrame([(text,)], "t string").select(sp.split_trained(F.col("t"), []).alias("s")).first()["s"]
    assert "Kim met Prof." in plain
