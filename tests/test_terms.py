from pyspark.sql import functions as F

from lexiloom.functions import text as tx
from lexiloom.operators import terms as te


def tokens(spark, rows):
    data = [(str(p), i, " ".join(t), t) for p, i, t in rows]
    return spark.createDataFrame(data, "page_id string, sentence_index int, sentence string, tokens array<string>")


def test_statistics(spark):
    rows = spark.createDataFrame([("1", 0, "a b a good sentence.", ["a", "b", "a"]), ("1", 1, "a", ["a"]), ("2", 0, "b", ["b"])], "page_id string, sentence_index int, sentence string, tokens array<string>")
    got = {r["term"]: tuple(r)[1:] for r in te.term_statistics(rows).collect()}
    assert got == {"a": (3, 1, 0.5), "b": (2, 2, 0.5)}


def test_statistics_do_not_depend_on_partitions(spark):
    rows = tokens(spark, [(p, i, [f"w{(p * i) % 5}", "x", f"w{i}"]) for p in range(20) for i in range(6)])
    a = sorted(te.term_statistics(rows.repartition(1)).collect())
    assert a == sorted(te.term_statistics(rows.repartition(7)).collect())


def test_phrases(spark):
    rows = tokens(spark, [(i, 0, ["패밀리", "오픈", "일정"]) for i in range(5)] + [(i + 5, 0, ["패밀리", "오픈", "매장"]) for i in range(5)])
    found = te.phrase_scores(rows, min_count=2, threshold=0.3)
    assert ("패밀리", "오픈") in {(r["a"], r["b"]) for r in found.collect()}
    assert all("패밀리_오픈" in r["tokens"] for r in te.merged_tokens(rows, found, ["page_id"]).collect())


def greedy(words, phrases):
    out, i = [], 0
    while i < len(words):
        if i + 1 < len(words) and (words[i], words[i + 1]) in phrases:
            out.append(f"{words[i]}_{words[i + 1]}")
            i += 2
        else:
            out.append(words[i])
            i += 1
    return out


def test_merge_is_the_greedy_scan(spark, monkeypatch):
    import random

    rng = random.Random(1)
    texts = {k: [rng.choice("abc") for _ in range(rng.randint(1, 30))] for k in range(60)}
    phrases = {("a", "b"), ("b", "a"), ("a", "a"), ("c", "a")}
    rows = spark.createDataFrame([(k, t) for k, t in texts.items()] + [(99, []), (98, ["a"])], "k int, tokens array<string>")
    table = spark.createDataFrame(list(phrases), "a string, b string")
    want = {k: greedy(t, phrases) for k, t in texts.items()} | {99: [], 98: ["a"]}
    for sent in (te.MOST_SENT, 0):  # by broadcast, and by a shuffle
        monkeypatch.setattr(te, "MOST_SENT", sent)
        got = {r["k"]: r["tokens"] for r in te.merged_tokens(rows, table, ["k"]).collect()}
        assert got == want


def test_placeholders_and_stopwords_are_no_terms(spark):
    rows = tokens(spark, [(1, 0, ["<DATE>", "a", "the", " "]), (1, 1, ["the", "<NUMBER>"])])
    assert {r["term"] for r in te.term_statistics(rows, stopwords=("the",)).collect()} == {"a"}
    assert {r["term"] for r in te.term_contexts(rows).collect()} == {"a", "the"}


def test_unmerge(one):
    assert one(lambda c: te.unmerge_forbidden(c, ["x"]), ["a_x", "a_b", "c"]) == ["a", "x", "a_b", "c"]


def test_verb_only(spark):
    rows = spark.createDataFrame([("go", True), ("go", True), ("run", True), ("run", False)], "t string, v boolean")
    assert [r[0] for r in te.verb_only(rows, "t", F.col("v")).collect()] == ["go"]


def contexts(spark, rows):
    return spark.createDataFrame(rows, "term string, page_id string, sentence_index int, sentence string")


def test_patterns(spark):
    rows = contexts(spark, [("t", str(i), 0, f"t 일정은 2026-09-0{i} 예정") for i in range(4)] + [("t", "9", 0, "다른 문장 t 입니다")])
    assert te.pattern_counts(rows).first()["patterns"] == 2


def diversify(rows, limit, per_page):
    seen, pages, out = set(), {}, []
    for quota in (True, False):
        for r in rows:
            if len(out) >= limit or r in out or (r[2] and r[2] in seen) or quota and pages.get(r[0], 0) >= per_page:
                continue
            out.append(r)
            seen.add(r[2])
            pages[r[0]] = pages.get(r[0], 0) + 1
    return [(r[0], r[1]) for r in out]


def test_diversified_is_the_two_passes(spark):
    import random

    rng = random.Random(2)
    data = sorted({("t", str(rng.randint(0, 3)), rng.randint(0, 9), rng.choice(["x one", "x two", "x three", "x", "x four"])) for _ in range(25)})
    first = {}
    for r in data:
        first.setdefault(r[1:3], r)
    data = sorted(first.values(), key=lambda r: (r[1], r[2]))
    rows = contexts(spark, [(t, p, i, s.replace("x", t)) for t, p, i, s in data])
    signed = rows.withColumn("sig", tx.pattern_signature(F.col("sentence"), F.col("term"))).orderBy("page_id", "sentence_index").collect()
    want = diversify([(r["page_id"], r["sentence_index"], r["sig"]) for r in signed], 4, 1)
    assert [(r["page_id"], r["sentence_index"]) for r in te.diversified(rows, 4, 1).orderBy("rank").collect()] == want


KEPT = ["중복_방지_키", "잔여_값", "A_등급", "지연_로딩", "3월_정산", "QX", "AI"]
REJECTED = {"DB_로": "malformed", "을_반환": "malformed", "버_수정": "malformed", "3월": "measure", "2024년": "measure", "20건": "measure", "500만원": "measure", "99%": "measure", "<DATE>": "placeholder", "--": "no meaning", "값": "too short", "묶이": "verb stem", "문제_묶이": "verb stem", "the": "stopword"}


def test_eligibility(spark):
    terms = spark.createDataFrame([(t, 1.0) for t in [*KEPT, *REJECTED]] + [("rare", 0.0)], "term string, sentence_ratio double")
    stop, verbs = spark.createDataFrame([("the",)], "word string"), spark.createDataFrame([("묶이",)], "token string")
    got = {r["term"]: r["excluded_reason"] for r in te.annotated(terms, stop, verbs, min_ratio=0.1).collect()}
    assert got == {k: "" for k in KEPT} | REJECTED | {"rare": "no sentence"}
