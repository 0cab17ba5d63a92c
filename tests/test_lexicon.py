"""Dictionaries by automaton, and the lattice analyser, against brute force."""

import itertools
import pickle
import random

import pytest
from pyspark.sql import functions as F

from lexiloom.functions import lexicon as lx
from lexiloom.operators import analyser as an
from lexiloom.operators import terms as te
from lexiloom.plans.build import Build, Config


def plain_matches(words, text, whole):
    out, at = [], 0
    while at < len(text):
        ok = lambda w: text.startswith(w, at) and not (at and text[at - 1].isalnum()) and not (whole and text[at + len(w) : at + len(w) + 1].isalnum())  # noqa: B023, E731
        best = max((w for w in words if ok(w)), key=len, default=None)
        if best is None:
            at += 1
        else:
            out.append((at, at + len(best), best))
            at += len(best)
    return out


@pytest.mark.parametrize("whole", [False, True])
def test_matches_are_leftmost_longest(whole):
    rng = random.Random(1)
    for _ in range(300):
        words = {"".join(rng.choice("ab 가x") for _ in range(rng.randint(1, 5))).strip() for _ in range(8)} - {""}
        text = "".join(rng.choice("ab 가x.") for _ in range(60))
        lexicon = pickle.loads(pickle.dumps(lx.Lexicon(words, whole)))
        assert [(a, b, lexicon.words[k]) for a, b, k in lexicon.matches(text)] == plain_matches(words, text, whole), (words, text)


def test_lexicon_columns(spark):
    lexicon = lx.Lexicon([" 감사 로그 ", "로그", "감사 로그 보관", "", "감사 로그"])
    rows = [(1, "새 감사 로그를 감사 로그 보관함"), (2, None), (3, ""), (4, "감사  로그"), (5, "x감사 로그 " * 20_000)]
    df = spark.createDataFrame(rows, "id int, t string").select("id", "t", lx.matches(F.col("t"), lexicon).alias("m"), lx.joined(F.col("t"), lexicon).alias("j"))
    got = {r["id"]: r for r in df.collect()}
    assert [tuple(m) for m in got[1]["m"]] == [(2, 7, "감사 로그"), (9, 17, "감사 로그 보관")] and got[1]["j"] == "새 감사_로그를 감사_로그_보관함"
    assert got[2]["m"] == [] and got[2]["j"] is None and got[3]["j"] == "" and got[4]["j"] == "감사  로그"
    assert len(got[5]["m"]) == 20_000 and got[5]["j"] == rows[4][1]  # only the word behind the blank stands
    none = lx.Lexicon([])
    assert none.matches("a b") == [] and none.joined("a b") == "a b"
    many = lx.Lexicon(f"word {k}" for k in range(50_000))
    assert many.joined("see word 4711 and word 50000x") == "see word_4711 and word_50000x" or many.joined("see word 4711") == "see word_4711"


# ---------------------------------------------------------------- analyser
def plain_cut(model, run):
    """The cheapest of all ways, by trying them."""
    best = None

    def go(at, way, cost):
        nonlocal best
        if at == len(run):
            key = (round(cost, 9), way)
            if best is None or key[0] < best[0]:
                best = key
            return
        for end, tag, own in model.offers(run, at):
            link = model.pairs.get((way[-1][1] if way else an.BEGIN, tag), model.no_pair)
            go(end, (*way, (run[at:end], tag)), cost + own + link)

    go(0, (), 0.0)
    return best


def cost_of(model, way):
    at, last, cost = 0, an.BEGIN, 0.0
    run = "".join(s for s, _ in way)
    for surface, tag in way:
        cost += min(c for e, t, c in model.offers(run, at) if (e, t) == (at + len(surface), tag)) + model.pairs.get((last, tag), model.no_pair)
        at, last = at + len(surface), tag
    return round(cost, 9)


def test_the_way_is_the_cheapest():
    rng = random.Random(2)
    surfaces = ["".join(p) for n in (1, 2, 3) for p in itertools.product("가나b1", repeat=n)]
    for _ in range(60):
        entries = [(s, rng.choice(["NNG", "JKS", "VV"]), rng.random() * 9) for s in rng.sample(surfaces, 12)]
        pairs = {(a, b): rng.random() * 5 for a in ("^", "NNG", "JKS", "VV", "SL") for b in ("NNG", "JKS", "VV") if rng.random() < 0.7}
        model = an.Analyser(entries, pairs)
        run = "".join(rng.choice("가나b1") for _ in range(rng.randint(1, 7)))
        way = model.cut(run)
        assert "".join(s for s, _ in way) == run and cost_of(model, way) == plain_cut(model, run)[0]


def tagged_rows():
    nouns, particles, stems, ends = ["매장", "로그", "담당자", "쿠폰"], ["를", "가", "에서"], ["확인", "보내"], ["합니다", "한다"]
    rng = random.Random(3)
    rows = [[(rng.choice(nouns), "NNG"), (rng.choice(particles), "JKS")] for _ in range(200)]
    return rows + [[(rng.choice(stems), "VV"), (rng.choice(ends), "EF")] for _ in range(200)] + [[("API", "sl")]] * 9 + [[]]


def test_trained_analyser(spark):
    df = spark.createDataFrame([(r,) for r in tagged_rows()], "tagged array<struct<token:string,tag:string>>").repartition(3)
    model = an.trained(df, user=[("감사 로그", "NNP"), ("QX", "NNP")])
    got = model(["담당자가 쿠폰를 확인한다", "감사 로그에서 신메뉴가 API", "", None, "x" * 500 + "12"])
    assert got[0] == [("담당자", "NNG"), ("가", "JKS"), ("쿠폰", "NNG"), ("를", "JKS"), ("확인", "VV"), ("한다", "EF")]
    assert got[1] == [("감사 로그", "NNP"), ("에서", "JKS"), ("신메뉴", "NNG"), ("가", "JKS"), ("API", "SL")]
    assert got[2] == got[3] == [] and got[4] == [("x" * 500, "SL"), ("12", "SN")]
    rows = spark.createDataFrame([("담당자가 QX를 보내합니다",), (None,)], "sentence string")
    kept = te.tagged(rows, model).select(te.kept_tokens(F.col("tagged")).alias("k"), "tag_error").collect()
    assert kept[0]["k"] == ["담당자", "QX", "보내"] and kept[1]["k"] == [] and {r["tag_error"] for r in kept} == {None}
    assert an.trained(df.limit(0))(["ab1 가"]) == [[("ab", "SL"), ("1", "SN"), ("가", "NNG")]]


def test_held_out_sentences(spark):
    rows = tagged_rows()
    model = an.trained(spark.createDataFrame([(r,) for r in rows[::2]], "tagged array<struct<token:string,tag:string>>"))
    asked = [r for r in rows[1::2] if r]
    right = sum(model(["".join(s for s, _ in r)])[0] == [(s, t.upper()) for s, t in r] for r in asked)
    assert right / len(asked) > 0.95


def test_errors_are_kept(spark):
    def reads(texts):
        if any("bad" in t for t in texts):
            raise ValueError("unreadable")
        return [[(t, "NNG")] for t in texts]

    got = {r["sentence"]: r for r in te.tagged(spark.createDataFrame([("good",), ("bad",), ("fine",)], "sentence string").coalesce(1), reads).collect()}
    assert got["good"]["tag_error"] is None and got["fine"]["tagged"][0]["token"] == "fine" and got["bad"]["tag_error"] == "ValueError: unreadable" and got["bad"]["tagged"] == []


def test_dictionary_and_vectors_in_a_build(spark, tmp_path):
    """A user dictionary makes tokens; the build's own vectors make neighbours."""
    (tmp_path / "words.tsv").write_text("쿠폰 발급\tNNP\n단어\tNNG\n", encoding="utf-8")
    lines = ["쿠폰 발급 안내를 {0} 확인합니다.", "{0} 에서 쿠폰 발급 내역을 조회합니다.", "{0} 담당자가 공지를 발송합니다."]
    rows = [(f"p{i}", "S", f"제목 {i}", "".join(f"<p>{x.format(n)}</p>" for x in lines), 1) for i, n in enumerate(["매장", "본사", "창고", "지점"] * 3)]
    pages = spark.createDataFrame(rows, "page_id string, space_id string, title string, body string, version long")
    build = Build(spark, str(tmp_path / "b"), Config(phrase_min=10**6, dictionary=str(tmp_path / "words.tsv"), vectors=6, neighbors=5, min_similarity=-1.0))
    build.run(pages, None)
    assert not build.get("terms").where("term = '쿠폰_발급'").isEmpty() and build.get("terms").where("term = '쿠폰'").isEmpty()
    assert build.get("vectors").count() == build.get("terms").where("excluded_reason = ''").count()
    assert build.get("fused").where("array_contains(sources, 'FASTTEXT')").count() > 0


def test_forbidden_words_are_no_part_of_a_phrase(spark, tmp_path):
    rows = [(f"p{i}", "S", f"제목 {i}", "<p>쿠폰 발급 안내 담당자 확인.</p><p>감사 로그 보관 기간 조회.</p>", 1) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id string, space_id string, title string, body string, version long")
    terms = {}
    for forbidden in ((), ("로그",)):
        build = Build(spark, str(tmp_path / f"b{len(forbidden)}"), Config(phrase_min=2, phrase_threshold=0.01, forbidden=forbidden))
        build.collect(pages)
        build.preprocess()
        terms[forbidden] = {t for r in build.get("merged2").select("tokens").collect() for t in r["tokens"]}
    assert any("로그" in t.split("_") and "_" in t for t in terms[()])
    assert "로그" in terms["로그",] and not any("로그" in t.split("_") and "_" in t for t in terms["로그",]) and any("_" in t for t in terms["로그",])
