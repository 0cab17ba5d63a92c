import itertools

import pytest
from pyspark.sql import functions as F

from lexiloom.functions import policy as po
from lexiloom.operators import evaluate as ev
from lexiloom.operators import judgement as ju
from lexiloom.operators import sync as sy


def status(kind, confidence, both):
    if kind in ("UNRELATED", "UNKNOWN"):
        return "REJECTED"
    if kind not in ("SAME_ENTITY", "EXACT_ALIAS", "ABBREVIATION") or not both:
        return "REVIEW"
    return {"HIGH": "ACTIVE", "MEDIUM": "REVIEW", "LOW": "REJECTED"}[confidence]


def test_policy_table(spark):
    data = list(itertools.product(po.RELATION_TYPES, po.CONFIDENCES, (True, False), ("ENTITY", "CONCEPT", "UNKNOWN")))
    df = spark.createDataFrame(data, "k string, c string, both boolean, t string").withColumn("s", po.decide_status(F.col("k"), F.col("c"), F.col("both")))
    for r in df.withColumn("e", po.is_expandable(F.col("t"), F.col("k"), F.col("s"))).collect():
        assert r["s"] == status(r["k"], r["c"], r["both"])
        allowed = {"ENTITY": po.ENTITY_EXPANDED, "CONCEPT": po.CONCEPT_EXPANDED}.get(r["t"], ())
        assert r["e"] == (r["s"] == "ACTIVE" and r["k"] in allowed)


def test_wider_active_types(one):
    """Contrary, broader and narrower terms are never active, whatever the active types; statuses can be set."""
    decide = lambda k, c: po.decide_status(k, c, F.lit(True), active=po.RELATION_TYPES, related="REJECTED", by_confidence={"MEDIUM": "ACTIVE"})
    want = {"ANTONYM": "REVIEW", "BROADER": "REVIEW", "NARROWER": "REVIEW", "UNRELATED": "REJECTED", "RELATED": "REJECTED", "SYNONYM": "ACTIVE"}
    for kind, status_of in want.items():
        assert one(decide, kind, "HIGH") == status_of and one(decide, kind, "MEDIUM") == status_of
    assert one(decide, "ALIAS", "LOW") == "REJECTED"


@pytest.mark.parametrize(("kind", "want"), [("NARROWER", (True, False)), ("BROADER", (False, True)), ("RELATED", (False, False)), ("SYNONYM", (True, True))])
def test_directions(one, kind, want):
    assert tuple(one(lambda k, a: po.safe_directions(k, a, a), kind, True)) == want


def test_guard_and_values(one):
    guard = lambda k, c, n: po.guarded_confidence(k, c, n, F.lit(5))
    assert one(guard, "ALIAS", "HIGH", 1) == "MEDIUM" and one(guard, "ALIAS", "HIGH", 2) == "HIGH" and one(guard, "SYNONYM", "HIGH", 1) == "HIGH"
    assert one(lambda c: po.known(c, po.RELATION_TYPES, "UNKNOWN"), " alias ") == "ALIAS" and one(lambda c: po.known(c, po.RELATION_TYPES, "UNKNOWN"), "odd") == "UNKNOWN"
    assert one(lambda c: po.known(c, po.CONFIDENCES, "LOW"), None) == "LOW"
    assert one(po.proposal_score, "SAME", "MEDIUM") == 0.7 and one(po.proposal_score, "x", None) == 0.2
    assert one(po.is_removal_mark, " x ") and not one(po.is_removal_mark, "no") and not one(po.is_removal_mark, None)
    assert one(po.stratum, ["FASTTEXT"]) == "embedding only" and one(po.stratum, ["A", "B"]) == "several paths" and one(po.stratum, []) == "none"


def test_removal_hints(one):
    hint = lambda k: one(lambda c: po.removal_hint(c, F.lit(3), F.lit(9)), k)
    assert [hint(k) for k in ("product", "NOT", "DevOps", "MySQL", "Feature_Flag", "<DATE>", "값")] == ["field name", "code value", "", "", "", "placeholder", "one character"]
    assert one(lambda c: po.removal_hint(c, F.lit(1), F.lit(5)), "매장 오픈") == "repeated phrase"


def test_answers(spark):
    answers = spark.createDataFrame([(0, '```json\n{"results":[{"pairId":"c1","relationType":"alias","confidence":"odd","evidenceContextIds":[1,9,1]},{"pairId":"zz"}]}\n```'), (1, "broken")], "batch int, answer string")
    results = ju.parsed(answers, ju.JUDGED, "results").withColumnRenamed("pairId", "pair_id")
    asked = spark.createDataFrame([("c1",), ("c2",)], "pair_id string")
    assert [r["pair_id"] for r in ju.matched(asked, results, "pair_id").collect()] == ["c1"]
    assert [r["pair_id"] for r in ju.unanswered(asked, results, "pair_id").collect()] == ["c2"]
    kept = ju.matched(asked, results, "pair_id").select(ju.offered_only(F.col("evidenceContextIds"), F.array(F.lit(1).cast("long"), F.lit(2).cast("long")))).first()[0]
    assert kept == [1, 1]


def test_batches_fail_alone(spark):
    def client(prompt):
        if "bad" in prompt:
            raise ValueError("no")
        return prompt.upper()

    got = {r["batch"]: (r["answer"], r["error"]) for r in ju.call_batches(spark.createDataFrame([(0, "good"), (1, "bad")], "batch long, prompt string"), client).collect()}
    assert got == {0: ("GOOD", None), 1: (None, "no")}


def test_numbering(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    assert [(r["k"], r["batch"]) for r in ju.batched(df, 24, [F.col("k")]).orderBy("k").collect()] == [(i, i // 24) for i in range(1000)]


def test_replay(spark):
    entries = spark.createDataFrame([("c1", "a||b"), ("c2", "a||c"), ("c3", "a||d")], "pair_id string, pair_key string")
    by_id, by_pair = spark.createDataFrame([("c1", "I")], "pair_id string, answer string"), spark.createDataFrame([("a||b", "P"), ("a||c", "Q")], "pair_key string, answer string")
    got = {r["pair_id"]: (r["answer"], r["missing"]) for r in ju.replayed(entries, by_id, by_pair).collect()}
    assert got == {"c1": ("I", False), "c2": ("Q", False), "c3": (None, True)}


def test_dictionary(spark):
    terms = spark.createDataFrame([("QX", 42, "ENTITY"), ("패밀리_오픈", 30, "ENTITY"), ("매장_오픈", 12, "UNKNOWN"), ("x_y", 9, "CONCEPT"), ("x y", 5, "CONCEPT")], "term string, frequency int, term_type string")
    verdict = [("QX", "패밀리_오픈", "ALIAS", "HIGH", 0.87, True, True), ("QX", "매장_오픈", "SAME_ENTITY", "HIGH", 0.7, True, True)]
    rows = spark.createDataFrame(verdict, "a string, b string, relation_type string, confidence string, similarity double, safe_ab boolean, safe_ba boolean")
    patterns = spark.createDataFrame([("QX", 3), ("패밀리_오픈", 3), ("매장_오픈", 2)], "term string, patterns int")
    relations = ju.directed(ju.judged(rows, patterns))
    assert relations.count() == 4 and {(r["source"], r["status"]) for r in relations.collect()} == {("QX", "REVIEW"), ("QX", "ACTIVE"), ("패밀리_오픈", "REVIEW"), ("매장_오픈", "ACTIVE")}
    entries = {r["display"]: r for r in ju.dictionary(terms, relations).collect()}
    assert [(e["termKey"], e["expandable"]) for e in entries["QX"]["relations"]] == [("매장_오픈", True), ("패밀리_오픈", False)]
    assert entries["매장 오픈"]["relations"][0]["expandable"] is False  # unknown types expand nothing
    assert entries["x y"]["term"] == "x y" and entries["x y"]["relations"] == []
    assert ju.review_queue(relations).count() == 1


def test_sync(spark):
    new = spark.createDataFrame([("1", 2), ("2", 1), ("3", 1)], "page_id string, version int")
    old = spark.createDataFrame([("1", 3), ("2", 1)], "page_id string, version int")
    got = sy.version_sync(new, old)
    assert {(r["page_id"], r["change"]) for r in got.collect()} == {("1", "updated"), ("2", "unchanged"), ("3", "created")}
    assert sy.sync_counts(got).first().asDict() == {"seen": 3, "created": 1, "updated": 1, "unchanged": 1, "failed": 0, "changed": 2}
    assert sy.retain_only(new, old.limit(0), "page_id").count() == 3 and sy.retain_only(new, old, "page_id").count() == 2


def test_upserts(spark):
    rows = spark.createDataFrame([("QX||P", 0.87, "A", 1), ("QX||P", 0.85, "B", 2)], "pair_key string, similarity double, status string, seq int")
    assert sy.upsert_max(rows, ["pair_key"], "similarity", "seq", ["status"]).first().asDict() == {"pair_key": "QX||P", "similarity": 0.87, "status": "B"}
    old = spark.createDataFrame([("a", 1, "T"), ("b", 2, None)], "k string, n int, t string")
    new = spark.createDataFrame([("b", 5, "U"), ("c", 6, "V")], "k string, n int, t string")
    assert {tuple(r) for r in sy.upsert(old, new, ["k"], keep=["t"]).collect()} == {("a", 1, "T"), ("b", 5, None), ("c", 6, "V")}
    assert {r["k"] for r in sy.insert_new(old, new.union(new), ["k"]).collect()} == {"c"}


def test_removal(spark):
    relations = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "source string, target string")
    terms, pairs = spark.createDataFrame([("a",)], "term string"), spark.createDataFrame([("c||d",)], "pair_key string")
    assert tuple(sy.removal_impact(relations, terms, pairs).first()) == (1, 1, 1)
    assert [tuple(r) for r in sy.without_terms(relations, terms, pairs).select("source", "target").collect()] == [("b", "c")]


def test_evaluation(spark):
    df = spark.createDataFrame([(True, True, "ACTIVE"), (True, True, "REVIEW"), (True, False, None), (False, True, "ACTIVE")], "positive boolean, found boolean, status string")
    assert ev.gold_figures(df).first().asDict() == {"positives": 3, "found": 2, "active": 2, "active_right": 1, "in_review": 1, "recall": 0.6667, "precision": 0.5}
    values = spark.createDataFrame([(0.1,), (0.5,), (0.9,)], "v double")
    assert [(r["threshold"], r["n"]) for r in ev.threshold_shares(values, "v", [0.5, 0.95]).collect()] == [(0.5, 2), (0.95, 0)]
    rows = spark.range(100).select("id", (F.col("id") % 4 == 0).cast("string").alias("s"))
    sample = ev.stratified_sample(rows, F.col("s"), 20, ["id"]).groupBy("stratum").count().collect()
    assert {r["stratum"]: r["count"] for r in sample} == {"true": 10, "false": 10}
    ids = spark.createDataFrame([(1,), (2,), (5,), (70000,)], "i long")
    got = sorted(r["id"] for r in ev.missing_ids(ids, "i").collect())
    assert got[:2] == [3, 4] and len(got) == 70000 - 4


def test_corpus_checks(spark):
    docs = spark.createDataFrame([(1, "adr", "uses X and Y", ["X"]), (2, "adr", "uses X", None), (3, "odd", "", [])], "id int, type string, body string, systems array<string>")
    assert {(r["category"], r["n"], r["missing"]) for r in ev.category_counts(docs, "type", {"adr": 5, "faq": 1}).collect()} == {("adr", 2, 3), ("faq", 0, 1), ("odd", 1, None)}
    assert {tuple(r) for r in ev.unlisted_mentions(docs, "body", ["X", "Y"], "systems", "id").collect()} == {(1, "Y"), (2, "X")}
