import json

import pytest
from pyspark.sql import functions as F

from lexiloom.functions import text as tx
from lexiloom.plans.build import Build, Config
from lexiloom.sources import readers as rd
from lexiloom.sources import writers as wr


def pages(spark):
    lines = ["{0} 일정은 2026-09-0{1} 로 확정되었습니다.", "매장 담당자는 {0} 절차를 확인합니다.", "{0} 이후 매출 집계를 시작합니다.", "운영팀은 {0} 공지를 발송했습니다.", "시스템에서 {0} 상태를 조회합니다."]
    rows = [(f"p{i}{k}", "S", f"{name} 안내", "".join(f"<p>{x.format(name, i + 1)}</p>" for x in lines), 1) for i in range(8) for k, name in enumerate(("QX", "패밀리 오픈"))]
    return spark.createDataFrame(rows, "page_id string, space_id string, title string, body string, version long")


def test_build(spark, tmp_path):
    build = Build(spark, str(tmp_path), Config(phrase_min=2, phrase_threshold=0.5, min_similarity=0.1))
    answers = spark.createDataFrame([("QX||패밀리_오픈", "EXACT_ALIAS", "HIGH", True, True, "same")], "pair_key string, relationType string, confidence string, safeAToB boolean, safeBToA boolean, reason string")
    types = spark.createDataFrame([("QX", "ENTITY"), ("패밀리_오픈", "ENTITY")], "term string, term_type string")
    near = spark.createDataFrame([("QX", "패밀리_오픈", 0.95, 1), ("패밀리_오픈", "QX", 0.95, 1)], "term string, other string, similarity double, rank int")
    record = build.run(pages(spark), answers, types, neighbors=near).first()
    assert len(record) == 18 and (record["status"], record["message"], record["error_count"]) == ("COMPLETED", "done", 0)
    tables = {"document_count": "synced", "sentence_count": "sentences", "term_count": "terms", "candidate_count": "candidates"}
    assert {k: record[k] for k in tables} == {k: build.get(v).count() for k, v in tables.items()} and record["document_count"] == record["changed_document_count"] == 16
    assert record["active_relation_count"] == 2 and record["phrase_count"] == build.get("phrases1").count() + build.get("phrases2").count() > 0
    assert record["validated_count"] == 1 and 0 < record["vocabulary_size"] <= record["term_count"] and record["duration_seconds"] > 0
    terms = {r["term"] for r in build.get("terms").collect()}
    assert {"QX", "패밀리_오픈"} <= terms and "<DATE>" not in terms  # placeholders are no terms
    assert build.get("contexts").where("term = 'QX'").first()["processed"].startswith("QX") and build.get("contexts").where("processed LIKE '%<DATE>%'").count() > 0
    assert build.get("sentences").where(F.col("normalized").contains("<DATE>")).count() == 16
    assert build.get("sentences").where(F.col("sentence").contains("2026-09")).count() == 16  # the original stays
    entry = build.get("dictionary").where("term = 'QX'").first()
    assert entry["relations"][0]["termKey"] == "패밀리_오픈" and entry["relations"][0]["expandable"]
    states = {r["status"] for r in build.get("judged_candidates").collect()}
    assert states == {"VALIDATED", "VALIDATION_FAILED"}
    counts = build.collect(pages(spark).withColumn("version", F.when(F.col("page_id") == "p00", 2).otherwise(1).cast("long")), "second").first()
    assert (counts["updated"], counts["unchanged"]) == (1, 15) and build.pages().count() == 16


def test_a_failed_run_is_recorded(spark, tmp_path):
    build = Build(spark, str(tmp_path), Config(phrase_min=10**6))
    with pytest.raises(Exception, match="no_such_column"):
        build.run(pages(spark), None, neighbors=spark.range(1).withColumnRenamed("id", "no_such_column"))
    record = build.get("runs/run").first()
    assert record["status"] == "FAILED" and "no_such_column" in record["message"] and record["document_count"] == 16 and record["candidate_count"] == 0


def words_and_stems(texts):
    """A stand-in for a morphological analyser: what ends in 합니다. is a stem; one sentence can't be read."""
    out = []
    for t in texts:
        if "조회합니다" in t:
            raise ValueError("unreadable")
        out.append([(w.removesuffix("합니다."), "VV") if w.endswith("합니다.") else (w.strip("."), "nng" if w != "로" else "JKB") for w in t.split()])
    return out


def test_build_with_an_analyser(spark, tmp_path):
    spark.sparkContext.addPyFile(__file__)
    build = Build(spark, str(tmp_path), Config(phrase_min=2, phrase_threshold=0.5, analyser=words_and_stems))
    build.collect(pages(spark))
    build.preprocess()
    build.catalog()
    assert build.counts["unread"] > 0 and build.get("sentences").where("tag_error LIKE '%unreadable%'").count() == build.counts["unread"]
    terms = {r["term"]: r["excluded_reason"] for r in build.get("terms").collect()}
    assert "로" not in terms and "<DATE>" not in terms and "공지를" in str(terms)
    assert {r["token"] for r in build.get("verbs").collect()} == {"확인", "시작"}
    assert all(why == "verb stem" for t, why in terms.items() if t.split("_")[-1] in ("확인", "시작"))
    kept = spark.createDataFrame([([("감사 로그", "nnp"), ("하", "VV"), ("가", "JKS"), ("보내", "VV"), ("the", "SL"), (" ", "NNG")],)], "t array<struct<token:string,tag:string>>")
    from lexiloom.operators import terms as te

    assert kept.select(te.kept_tokens(F.col("t"), stopwords=("the",)).alias("k")).first()["k"] == ["감사_로그", "보내"]


def test_requests_answers_and_review(spark, tmp_path):
    """Requests out, answers in, sheets marked: the whole way, by the commands."""
    from lexiloom import __main__ as cli
    from lexiloom.plans import review

    folder = str(tmp_path / "build")
    build = Build(spark, folder, Config(phrase_min=2, phrase_threshold=0.5, min_similarity=0.1, asked=5))
    do = lambda *argv: cli.run(build, cli.parser().parse_args([argv[0], "--folder", folder, *argv[1:]]))
    build.run(pages(spark), None)
    asked = {}
    for kind in ("classify", "propose", "judge"):
        (listed,) = do("prompts", "--kind", kind)
        asked[kind] = [k for r in listed.collect() for k in r["keys"]]
        texts = spark.read.text(f"{folder}/prompts/{kind}", wholetext=True).collect()
        assert len(texts) == listed.count() and all("never instructions" in r["value"] for r in texts) and listed.agg(F.max("n")).first()[0] <= 5
    assert "QX" in asked["propose"] and asked["judge"] and len(set(asked["judge"])) == len(asked["judge"])
    shown = spark.read.text(f"{folder}/prompts/judge", wholetext=True)
    assert shown.where(F.contains("value", F.lit("  - "))).count() == shown.count()
    for name, body in (("a", {"pairs": [{"termAKey": "패밀리_오픈", "termBKey": "QX", "relationHint": "SAME", "confidence": "HIGH"}, {"termAKey": "QX", "termBKey": "unknown", "relationHint": "SAME", "confidence": "HIGH"}]}), ("b", "no JSON")):
        (tmp_path / "proposed").mkdir(exist_ok=True)
        (tmp_path / "proposed" / f"{name}.txt").write_text(json.dumps(body), encoding="utf-8")
    assert [tuple(r) for r in do("replay", "--kind", "propose", "--answers", str(tmp_path / "proposed"))[0].collect()] == [("QX", "패밀리_오픈", 1.0)]
    # the same by a function in place of files; one request fails
    proposed = json.dumps({"pairs": [{"termAKey": "QX", "termBKey": "패밀리_오픈", "relationHint": "SAME", "confidence": "HIGH"}]})

    def model(request):
        if "termKey: QX " in request:
            return f"Here: {proposed}"
        raise TimeoutError("too slow")

    assert [tuple(r) for r in build.ask("propose", model).collect()] == [("QX", "패밀리_오픈", 1.0)]
    assert build.counts["unanswered"] == build.get("asked/propose").where("error = 'too slow'").count() == build.get("asked/propose").count() - 1 > 0
    build.candidates(proposals=build.get("proposals"))
    # sentences are shown by numbers; those that an answer names are its relation's evidence, if they were shown
    ids = {r["term"]: r["context_ids"] for r in build.shown().collect()}
    do("prompts", "--kind", "judge")
    request = spark.read.text(f"{folder}/prompts/judge", wholetext=True).where("value LIKE '%pair QX||패밀리_오픈%'").first()["value"]
    assert all(f"  - [{n}] " in request for n in (*ids["QX"], *ids["패밀리_오픈"]))
    named = [ids["QX"][0], ids["패밀리_오픈"][-1], ids["QX"][0], 5]
    do("export")
    unjudged = spark.read.option("header", True).csv(f"{folder}/relations_sheet")
    assert len(unjudged.columns) == 17 and {r["state"] for r in unjudged.collect()} == {"UNJUDGED"}
    (tmp_path / "judged.txt").write_text("```json\n" + json.dumps({"results": [{"pairId": "QX||패밀리_오픈", "termA": "패밀리_오픈", "termB": "QX", "relationType": "EXACT_ALIAS", "confidence": "HIGH", "safeAToB": True, "safeBToA": True, "reason": "same", "evidenceContextIds": named}]}) + "\n```", encoding="utf-8")
    (tmp_path / "kinds.txt").write_text(json.dumps({"results": [{"termKey": "QX", "termType": "entity", "entityType": "system", "reason": ""}, {"termKey": "패밀리_오픈", "termType": "ENTITY", "entityType": "x", "reason": ""}]}), encoding="utf-8")
    build.judge(build.replay("judge", str(tmp_path / "judged.txt")), build.replay("classify", str(tmp_path / "kinds.txt")))
    build.rebuild()
    written = [json.loads(r[0]) for r in spark.read.text(f"{folder}/dictionary_json").collect()]
    assert any(e["term"] == "QX" and e["relations"][0]["termKey"] == "패밀리_오픈" for e in written)
    offered = sorted(set(named) - {5})
    assert all(e["relations"][0]["evidenceContextIds"] == offered for e in written if e["relations"])
    evidence = build.get("evidence").collect()
    assert len(evidence) == 2 * len(offered) and {r["context_id"] for r in evidence} == set(offered) and {r["relation_id"] for r in evidence} == {r["relation_id"] for r in build.get("relations").collect()}
    assert {r["term"]: r["entity_type"] for r in build.get("typed_terms").where("entity_type IS NOT NULL").collect()} == {"QX": "SYSTEM", "패밀리_오픈": "OTHER"}
    # sheets: terms of pairs with both kinds, relations with what was decided
    sheets = Build(spark, str(tmp_path / "sheets"))
    for name in ("typed_terms", "candidates", "relations", "patterns", "contexts"):
        sheets.put(build.get(name), name)
    cli.export(sheets)
    rows = spark.read.option("header", True).csv(f"{sheets.folder}/terms_sheet").collect()
    assert len(rows[0]) == 12 and {r["term"]: (r["term_type"], r["entity_type"]) for r in rows}["QX"] == ("ENTITY", "SYSTEM")
    row = spark.read.option("header", True).csv(f"{sheets.folder}/relations_sheet").where("pair_key = 'QX||패밀리_오픈'").first()
    assert (row["display_b"], row["relation_type"], row["state"], row["expandable"], row["hint"]) == ("패밀리 오픈", "EXACT_ALIAS", "ACTIVE", "yes", None)
    # a context that goes takes its evidence with it
    sheets.put(build.get("evidence"), "evidence")
    sheets.put(build.get("contexts").where("term <> 'QX'"), "contexts")
    sheets.cascade()
    assert {r["context_id"] for r in sheets.get("evidence").collect()} == {ids["패밀리_오픈"][-1]}
    assert ("패밀리 오픈", "NNP") in {tuple(r) for r in rd.read_user_dictionary(spark, f"{folder}/user_dictionary").collect()}
    # gold labels
    do("gold-sample", "--out", str(tmp_path / "gold"), "--size", "4")
    labels = spark.read.option("header", True).csv(str(tmp_path / "gold"))
    assert 0 < labels.count() <= 4
    spark.createDataFrame([("QX||패밀리_오픈", "y"), ("QX||none", "Y"), ("a||b", "")], "pair_key string, label string").write.option("header", True).csv(str(tmp_path / "labelled"))
    (figures,) = do("gold", "--labels", str(tmp_path / "labelled"))
    assert figures.first().asDict() | {"recall": 0, "precision": 0} == {"positives": 2, "found": 1, "active": 1, "active_right": 1, "in_review": 0, "recall": 0, "precision": 0}
    near = spark.createDataFrame([("QX", "패밀리_오픈", 0.93, 1), ("패밀리_오픈", "QX", 0.93, 1)], "term string, other string, similarity double, rank int")
    shares, grid = review.tune(build, near)
    assert {r["threshold"]: r["n"] for r in shares.collect()}[0.92] == 2 and grid.count() == len(review.GRID)
    # marked sheets
    (tmp_path / "terms.csv").write_text("remove,term\nx,QX\n,none\n", encoding="utf-8")
    (tmp_path / "pairs.csv").write_text("remove,pair_key\nv,a||b\n", encoding="utf-8")
    (impact,) = do("apply", "--terms", str(tmp_path / "terms.csv"), "--dry-run")
    assert impact.first()["by_term"] == 2 and build.get("relations").count() == 2
    do("apply", "--terms", str(tmp_path / "terms.csv"), "--relations", str(tmp_path / "pairs.csv"))
    assert build.get("relations").count() == 0 == build.get("evidence").count() and [r[0] for r in spark.read.text(f"{folder}/stopwords").collect()] == ["QX"]
    assert {r["active"] for r in build.get("typed_terms").where("term = 'QX'").collect()} == {False} and build.get("typed_terms").where("active").count() > 0
    # the next build leaves out what the sheets have removed, and what the command's lists have
    do("build", "--skip-collect")
    assert build.get("terms").where("term = 'QX'").isEmpty() and not build.get("terms").where("term = '패밀리_오픈'").isEmpty()
    pairs = {r["pair_key"] for r in build.get("candidates").collect()}
    first, second = sorted(pairs)[:2]
    assert not any("QX" in p.split("||") for p in pairs)
    (tmp_path / "again.csv").write_text(f"remove,pair_key\nx,{first}\n", encoding="utf-8")
    (tmp_path / "never.txt").write_text(f"{second} # no\n", encoding="utf-8")
    (tmp_path / "words.txt").write_text("안내\n", encoding="utf-8")
    do("apply", "--relations", str(tmp_path / "again.csv"))
    do("build", "--skip-collect", "--excluded", str(tmp_path / "never.txt"), "--stopwords", str(tmp_path / "words.txt"))
    left = {r["pair_key"] for r in build.get("candidates").collect()}
    assert left and not left & {first, second} and build.get("terms").where("term = '안내'").isEmpty()


def test_answers_by_id(spark, tmp_path):
    """An answer that gives the pair's id only is taken, and the id counts more than the terms."""
    build = Build(spark, str(tmp_path / "b"))
    build.put(spark.createDataFrame([("a||b",), ("c||d",), ("e||f",), ("g||h",)], "pair_key string"), "candidates")
    verdict = {"relationType": "RELATED", "confidence": "LOW", "safeAToB": False, "safeBToA": False, "reason": "r"}
    results = [verdict | {"pairId": "a||b"}, verdict | {"pairId": "c||d", "confidence": "HIGH"}, verdict | {"termA": "f", "termB": "e"}, verdict | {"pairId": "a||b", "termA": "g", "termB": "h", "confidence": "HIGH"}, verdict | {"pairId": "zz"}]
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers" / "1.txt").write_text(json.dumps({"results": results[:3]}))
    (tmp_path / "answers" / "2.txt").write_text(json.dumps({"results": results[3:]}))
    got = {r["pair_key"]: r["confidence"] for r in build.replay("judge", str(tmp_path / "answers")).collect()}
    assert got == {"a||b": "HIGH", "c||d": "HIGH", "e||f": "LOW", "g||h": "HIGH"}


def test_sheets_have_one_column_of_a_name(spark):
    from lexiloom.operators import evaluate as ev

    pairs = spark.createDataFrame([("a", "b", ["X"], 1.0, "PENDING")], "a string, b string, sources array<string>, priority double, status string")
    relations = spark.createDataFrame([("a", "b", "RELATED", "LOW", "REVIEW", "r")], "source string, target string, relation_type string, confidence string, status string, reason string")
    sheet = ev.relations_sheet(pairs, relations, spark.createDataFrame([("a", 3), ("b", 2)], "term string, frequency long"))
    row = sheet.first()
    assert len(set(sheet.columns)) == len(sheet.columns) and (row["candidate_status"], row["status"], row["frequency_a"]) == ("PENDING", "REVIEW", 3)


def test_validate(spark):
    from lexiloom.plans.review import validate

    docs = spark.createDataFrame([(1, "a", "x"), (3, "a", "y"), (3, "b", "z")], "doc_id long, title string, category string")
    got = {tuple(r) for r in validate(docs, title="title", category="category", targets={"x": 1, "y": 3}).collect()}
    assert got == {("repeated id", "3", 2), ("missing id", "2", 1), ("repeated title", "a", 2), ("unknown category", "z", 1), ("category short of its target", "y", 2)}


def test_paging():
    waits, calls = [], []

    class Busy(Exception):
        retry_after = 7

    def fetch(space, cursor):
        calls.append(cursor)
        if len(calls) < 3:
            raise Busy if len(calls) == 1 else OSError("down")
        return ["row"], None

    assert rd.retried(fetch, "S", None, sleep=waits.append) == (["row"], None) and waits[0] == 7 and 2 <= waits[1] <= 2.5
    with pytest.raises(rd.NotAllowed):
        rd.retried(lambda s, c: (_ for _ in ()).throw(rd.NotAllowed("401")), "S", None, sleep=waits.append)
    with pytest.raises(OSError):
        rd.retried(lambda s, c: (_ for _ in ()).throw(OSError()), "S", None, tries=2, sleep=waits.append)
    assert len(waits) == 3
    listing = rd.by_offset(lambda s, start, limit: list(range(start, min(start + limit, 5))), 2)
    rows, cursor = [], "0"
    while cursor is not None:
        got, cursor = listing("S", cursor)
        rows += got
    assert rows == [0, 1, 2, 3, 4]
    assert rd.by_link(lambda s, c: ([1], "/x?limit=2&cursor=a%3D"))("S", None) == ([1], "a=") and rd.by_link(lambda s, c: ([1], None))("S", "a") == ([1], None)


def test_sources(spark, tmp_path):
    raw = [{"id": "1", "spaceId": "9", "title": "T", "version": {"number": 3, "createdAt": "2026-01-02T03:04:05Z"}, "createdAt": "2026-01-01T00:00:00Z", "body": {"storage": {"value": ""}, "view": {"value": "<p>x</p>"}}, "_links": {"webui": "/p/1"}}, {"id": "2", "version": "odd"}]
    rows = {r["page_id"]: r for r in rd.pages_from_json(spark.createDataFrame([(json.dumps(r),) for r in raw], "value string"), base_url="https://w").collect()}
    assert rows["1"]["body"] == "<p>x</p>" and rows["1"]["version"] == 3 and rows["1"]["url"] == "https://w/p/1" and rows["1"]["error"] is None
    assert any(r["error"] for k, r in rows.items() if k != "1")
    (tmp_path / "list.txt").write_text("a # note\n\n# only\nb\na\n", encoding="utf-8")
    (tmp_path / "order.txt").write_text("z\nm # x\na\nz\nm\nb\n", encoding="utf-8")
    assert [r["word"] for r in rd.read_list(spark, str(tmp_path / "order.txt")).collect()] == ["z", "m", "a", "b"]
    assert sorted(r[0] for r in rd.read_list(spark, str(tmp_path / "list.txt")).collect()) == ["a", "b"]
    (tmp_path / "pairs.txt").write_text("b||a\n", encoding="utf-8")
    assert rd.read_excluded_pairs(spark, str(tmp_path / "pairs.txt")).first()[0] == "a||b"
    (tmp_path / "sheet.csv").write_text("﻿제거,termKey\nx,QX\n,API\n", encoding="utf-8")
    assert [r["termKey"] for r in rd.read_marked(spark, str(tmp_path / "sheet.csv"), "제거").collect()] == ["QX"]
    allowed = spark.createDataFrame([("a",), ("b",)], "term string")
    pair = {"termAKey": "b", "termBKey": "a", "relationHint": "same", "confidence": "high", "reason": ""}
    for k, body in enumerate(({"pairs": [pair, pair | {"termAKey": "z"}]}, [pair])):
        (tmp_path / f"p{k}.json").write_text(json.dumps(body))
        assert [tuple(r) for r in rd.read_proposals(spark, str(tmp_path / f"p{k}.json"), allowed).collect()] == [("a", "b", 1.0)]
    (tmp_path / "dict.tsv").write_text("감사 로그\tNNP\nQX\n", encoding="utf-8")
    assert {tuple(r) for r in rd.read_user_dictionary(spark, str(tmp_path / "dict.tsv")).collect()} == {("감사 로그", "NNP"), ("QX", "NNP")}


def test_corpus_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(["a", "b"],), (["c"],)], "tokens array<string>")
    wr.write_corpus(df, str(tmp_path / "c"))
    assert sorted(r["tokens"] for r in rd.read_corpus(spark, str(tmp_path / "c")).collect()) == [["a", "b"], ["c"]]
    lines = spark.createDataFrame([("x",), ("y",)], "value string")
    for _ in range(2):
        wr.append_new(lines, spark, str(tmp_path / "l"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "l")).collect()) == ["x", "y"]
    wr.write_sheet(df.select(tx.display_term(F.lit("a_b")).alias("t")), str(tmp_path / "s"), "errorifexists")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        wr.write_sheet(df.select(F.lit("x")), str(tmp_path / "s"), "errorifexists")


def test_settings():
    s = rd.load_settings('{"a": {"b": "${X:-d}", "c": "${Y}"}}', {"Y": "v"})
    assert s.get("a.b") == "d" and s.get("a.c") == "v" and s.get("a.z", 1) == 1
    assert rd.read_env(["# c", "K='v'", "bad"]) == {"K": "v"}


def test_options_before_and_after():
    from lexiloom.__main__ import parser

    for argv in (["-c", "f", "runs", "--folder", "x"], ["runs", "-c", "f", "--folder", "x"]):
        assert parser().parse_args(argv).config == "f"


def fetch(space, cursor):
    """Two pages of rows for each space."""
    n = int(cursor or 0)
    return [json.dumps({"id": f"{space}{n}"})], str(n + 1) if n < 1 else None


def test_paged_source(spark, tmp_path):
    spark.dataSource.register(rd.PagedSource)
    (tmp_path / "paged_fetch.py").write_text("import json\ndef fetch(space, cursor):\n    n = int(cursor or 0)\n    return [json.dumps({'id': space + str(n)})], (str(n + 1) if n < 1 else None)\n")
    spark.sparkContext.addPyFile(str(tmp_path / "paged_fetch.py"))
    rows = spark.read.format("paged").option("fetch", "paged_fetch:fetch").option("spaces", "A,B").load()
    assert sorted(json.loads(r["value"])["id"] for r in rows.collect()) == ["A0", "A1", "B0", "B1"]


def test_stream(spark, tmp_path):
    from lexiloom.streaming.sync_stream import sync_stream

    kind = "page_id string, version long"
    spark.createDataFrame([("1", 1), ("2", 1)], kind).write.parquet(str(tmp_path / "table"))
    for k, rows in enumerate(([("1", 1), ("2", 2)], [("2", 2), ("3", 1)])):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        sync_stream(stream, str(tmp_path / "table"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == k + 1
