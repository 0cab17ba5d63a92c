from pyspark.sql import functions as F

from lexiloom.functions.variants import Variant, apply_variants, word_start
from lexiloom.operators import judgement as ju


def test_variants(spark):
    rule = Variant("p", F.col("on"), [(word_start("포인트"), "적립금")])
    text, counts = apply_variants(F.col("t"), [rule])
    rows = [("포인트를 쓴다. 내포인트는 `포인트` 포인트가", True), ("포인트를", False), (None, True), ("```\n포인트\n``` 포인트와", True)]
    got = spark.createDataFrame(rows, "t string, on boolean").select(text.alias("t"), counts["p"].alias("n")).collect()
    assert [tuple(r) for r in got] == [("적립금을 쓴다. 내포인트는 `포인트` 적립금이", 2), ("포인트를", 0), ("", 0), ("```\n포인트\n``` 적립금과", 1)]


def test_rules_of_the_package(spark, tmp_path):
    """All eight, by the command: where they hold, what stays, particles, code, order."""
    from lexiloom import __main__ as cli
    from lexiloom.plans.build import Build

    rows = [
        ("1", "2025-12-31", "x", "x", "포인트를 쓰고 포인트가 쌓인다"), ("2", "2026-01-01", "x", "x", "포인트를"), ("3", "2025-01-01", "x", "x", "적립금과 포인트는"),
        ("4", "2026-02-01", "고객지원팀", "x", "회원은 회원가입 후 `회원` 정회원이"), ("5", "2026-02-01", "x", "프로젝트 진행상황", "멱등키를, 대사는 장바구니와 배송지로 감사 로그를 탈퇴는"),
        ("6", "2026-02-01", "x", "DB 테이블 설계안", "대사 멱등키"), ("7", None, None, None, "포인트 회원 대사"), ("8", "2025-01-01", "서비스기획팀", "코드리뷰", None),
        ("9", "2026-02-01", "x", "코드리뷰", "장바구니를 `a` 카트을 ```\n장바구니\n```"),
    ]
    spark.createDataFrame(rows, "id string, date string, department string, type string, body string").write.parquet(str(tmp_path / "docs"))
    build = Build(spark, str(tmp_path / "b"))
    do = lambda *argv: cli.run(build, cli.parser().parse_args(["variants", "--folder", build.folder, "--docs", str(tmp_path / "docs"), *argv]))[0]
    counts = {r["name"]: (r["documents"], r["replaced"]) for r in do("--out", str(tmp_path / "out")).collect()}
    got = {r["id"]: r["body"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {
        "1": "적립금을 쓰고 적립금이 쌓인다", "2": "포인트를", "3": "적립금과 포인트는", "4": "고객은 회원가입 후 `회원` 정회원이", "5": "중복 방지 키를, 정합성 대조는 카트와 수령지로 감사 이력을 해지는",
        "6": "정합성 대조 멱등키", "7": "포인트 회원 대사", "8": "", "9": "카트를 `a` 카트를 ```\n장바구니\n```",
    }
    assert len(counts) == 8 and counts["적립금 ↔ 포인트"] == (1, 2) and counts["정합성 대조 ↔ 대사"] == (2, 2) and counts["고객 ↔ 회원"] == (1, 1) and counts["카트 ↔ 장바구니"] == (2, 2)
    (tmp_path / "own.json").write_text('[{"name": "n", "canonical": "대사", "variant": "x", "when": "id = \'7\'"}]', encoding="utf-8")
    assert [tuple(r) for r in do("--out", str(tmp_path / "again"), "--rules", str(tmp_path / "own.json")).collect()] == [("n", 1, 1)]


def test_selections(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string")
    terms = spark.createDataFrame([("a", 3, ""), ("z", 9, ""), ("c", 5, "x")], "term string, frequency int, excluded_reason string")
    assert {r["term"] for r in ju.involved(terms, pairs).collect()} == {"a", "c"}
    assert [r["term"] for r in ju.proposal_terms(terms, 5).collect()] == ["z", "a"]
    keyed = pairs.withColumn("pair_key", F.concat("a", "b"))
    assert ju.answered_only(keyed, keyed.limit(0)).count() == 2 and ju.answered_only(keyed, keyed.where("a = 'a'")).count() == 1
