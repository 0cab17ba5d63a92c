"""SimHash, quality rules, personal data, language, and the pipeline: cases and brute force."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import language_id as la
from lexiloom.llm import pii, quality, simhash
from lexiloom.llm.store import Shelf


# ---------------------------------------------------------------- SimHash
def plain_fingerprint(text, words=3):
    import xxhash

    own = [w for w in re.split("[ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(own[i : i + words]) for i in range(len(own) - words + 1)] or ([" ".join(own)] if own else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one Two", "A b C", "a b c d a b c d a b c", "É ça va bien  oui\tnon"])
def test_fingerprints(text):
    assert simhash.fingerprint_of((text or "").encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover(radius):
    masks = [m & (2**64 - 1) for m in simhash.covering_masks(radius)]
    rng = random.Random(radius)
    pairs = [rng.sample(range(64), k) for k in range(1, radius + 1) for _ in range(3000)]
    assert all(any(m & sum(1 << b for b in p) == 0 for m in masks) for p in pairs) and len(masks) == 2 ** (radius + 1) - 1


def roots(prints, radius=2):
    own = np.array(prints, np.uint64)
    parent = list(range(len(own)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(own)):
        for j in np.flatnonzero(np.bitwise_count(own[i + 1 :] ^ own[i]) <= radius) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(own))]


def planted(seed=1):
    """Pairs, a chain, one large bucket of near fingerprints, lone ones."""
    rng = random.Random(seed)
    flip = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    out = [rng.getrandbits(64) for _ in range(60)]
    out += [flip(x, rng.randint(1, 3)) for x in out[:30]]
    chain = [rng.getrandbits(64)]
    for _ in range(25):
        chain.append(flip(chain[-1], 2))
    hub = rng.getrandbits(64)
    return sorted({*out, *chain, *(flip(hub, rng.randint(0, 2)) for _ in range(150)), 0, 3})


@pytest.mark.parametrize(("small", "radius"), [(4, 2), (24, 2), (1000, 2), (4, 1), (4, 3), (24, 4)])
def test_links_against_brute_force(spark, small, radius):
    prints = planted()
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    shelf = Shelf(spark, "test")
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(df, shelf, radius, small), shelf).collect()}
    groups, want = {}, {}
    for p, s in zip(roots(prints, radius), signed, strict=True):
        want.setdefault(p, set()).add(s)
    for s in signed:
        groups.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert all(min(v) == k for k, v in groups.items())


def test_near_dedup(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base), (4, base.upper()), (6, base + " more"), (2, "other words here now"), (7, None), (3, ""), (5, " \n"), (8, base.replace("w7 ", "q7 ")), (8, "zz"), (None, "zz"), (11, "x " * 50_000)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, fp string")
    prints = [plain_fingerprint(t) for _, t in rows]
    own = roots(prints)
    ids = {}
    for r, (i, _) in zip(own, rows, strict=True):
        ids.setdefault(r, []).append(i)
    want = sorted((i or 0, p, min(x for x in ids[r] if x is not None)) for r, p, (i, _) in zip(own, prints, rows, strict=True))
    got = sorted((r["id"] or 0, r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_dedup(docs).collect())
    assert got == want
    assert simhash.near_dedup(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- quality
def test_repeats_and_figures():
    rng = random.Random(1)
    for _ in range(200):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 40))]
        seen, mark = {}, set()
        for i in range(len(words) - 7):
            seen.setdefault(tuple(words[i : i + 8]), []).append(i)
        for own in seen.values():
            if len(own) > 1:
                mark |= {k for i in own for k in range(i, i + 8)}
        assert quality.repeated_words(words) == len(mark)
    text = "a b\n \na b\n#x\xa0y\x1fz\n"
    assert quality.base_figures(text, quality.words_of(text)) == (5, 10, 1, 1, 0)


def test_distance():
    p, q = np.array([1, 0]), np.array([0, 3])
    assert quality.distance(p, q) == 1 and quality.distance(p, p * 5) == 0 and quality.distance(p, q * 0) == 0
    assert abs(quality.distance(np.array([1, 1]), q) - quality.distance(q, np.array([1, 1]))) < 1e-12


EN = "the of and to in a is that for it was on".split()
DE = "der die das und in den von zu mit sich des auf".split()


def plain_distance(p, q):
    """The Jensen-Shannon distance by its definition, without numpy."""
    n, m = sum(p), sum(q)
    if not n or not m:
        return 0.0
    out = 0.0
    for x, y in zip(p, q, strict=True):
        x, y = x / n, y / m
        mean = (x + y) / 2
        out += (x * math.log2(x / mean) if x else 0) / 2 + (y * math.log2(y / mean) if y else 0) / 2
    return math.sqrt(max(out, 0))


def test_distance_by_definition():
    rng = random.Random(3)
    rows = [([rng.choice([0, 0, 1, 5, 90]) for _ in range(12)], [rng.randint(0, 9) for _ in range(12)]) for _ in range(200)]
    got = quality.distance(np.array([p for p, _ in rows]), np.array([q for _, q in rows]))
    assert np.allclose(got, [plain_distance(p, q) for p, q in rows])


def plain_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    inside = {k for i, w in enumerate(windows) if counts[w] > 1 for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_base_figures_by_definition(spark):
    rng = random.Random(12)
    piece = ["the", "a", "b|c", "##", "\xa0", "x\x1fy", "é", "\u3000", "👍", " ", "\n", "\n\n", "\t", "\r\n", "\x0b", "same line\n", "same line\n"]
    texts = ["".join(rng.choice(piece) + rng.choice(["", " "]) for _ in range(rng.randint(0, 120))) for _ in range(300)] + [None, "", " ", "w " * 20, "long " * 100_000]
    docs = spark.createDataFrame([(i, t, rng.choice(["en", "de", None])) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in quality.quality(docs).collect():
        own = plain_figures(texts[r["id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == own
        assert r["base_failed"] == (own[0] < 20 or 100 * own[4] > 30 * own[0]) and not (r["base_failed"] and r["kept"])


def test_common_words_are_counted(spark, monkeypatch):
    rng = random.Random(5)
    pool = [f"w{chr(97 + k)}" for k in range(20)] + ["|", "12", "The,", "the", "THE."]
    docs = [(i, " ".join(rng.choice(pool[: 5 + rng.randrange(20)]) for _ in range(50)), rng.choice(["en", "it"])) for i in range(60)] + [(99, None, "en"), (98, "x y", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    want = {}
    for lang in ("en", "it"):
        counts = Counter(w.strip(".,;:!?").lower() for _, t, x in docs if x == lang for w in (t or "").split())
        want[lang] = [w for w, _ in sorted(((w, n) for w, n in counts.items() if any(c.isalpha() for c in w)), key=lambda t: (-t[1], t[0]))][:9]
    assert quality.common_words(df, most=9) == want
    monkeypatch.setattr(quality, "HELD_WORDS", 3)  # given out in many parts
    assert quality.common_words(df, most=9) == want
    assert set(quality.common_words(df, langs=2)) <= {"en", "it"} and len(quality.common_words(df, langs=1)) == 0


def test_quality(spark):
    rng = random.Random(2)
    fill = lambda n: " ".join(rng.choice([*EN, f"some{rng.randint(0, 99)}", "words", "other"]) for _ in range(n)) + "."
    rows = [(i, fill(150), "en") for i in range(120)]
    rows += [(200, "%%% ".join(fill(150).split(" ")), "en"), (201, " | ".join(f"x{rng.randint(0, 9999)}" for _ in range(200)), "en"), (202, "few words", "en"), (203, None, None), (204, "", "en"), (205, fill(30) * 9, "en"), (206, fill(25), "xx"), (207, fill(25), None), (208, fill(20_000), "en")]
    german = lambda: " ".join(rng.choice([*DE, f"etwas{rng.randint(0, 99)}", "wort", "ander"]) for _ in range(150)) + "."
    rows += [(300 + i, german(), "de") for i in range(60)] + [(209, german(), "en"), (210, rows[200 - 80][1], None)]  # another language than it says; junk without one
    rows += [(211, rows[0][1], "en"), (211, rows[0][1], "en")]  # repeated rows
    odd = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 7)))
    rows += [(212, " ".join(odd() for _ in range(200)) + ".", "en")]  # only its words are wrong
    docs = spark.createDataFrame([(*r, "c", 1, "d") for r in rows], "doc_id long, text string, lang string, n_words string, at int, carried string")
    got = {r["id"]: r for r in quality.quality(docs).collect()}
    assert {i for i, r in got.items() if not r["kept"]} == {200, 201, 202, 203, 204, 205, 210, 212} and len(got) == len(rows) - 1
    assert {i for i, r in got.items() if r["base_failed"]} == {202, 203, 204, 205} and got[200]["char_distance"] > quality.MOST_CHAR
    left = quality.accepted(docs)
    assert left.columns == docs.columns and Counter(r["doc_id"] for r in left.collect()) == Counter(r["id"] for r in quality.quality(docs).where("kept").collect())
    assert quality.quality(docs.limit(0)).count() == 0 and quality.accepted(docs.limit(0)).count() == 0
    # the callers' limits hold: with a wide one for words, only characters and base rules reject
    assert {r["id"] for r in quality.quality(docs, most_word=1.0).where("not kept").collect()} < {200, 201, 202, 203, 204, 205, 210, 212}
    assert quality.quality(docs, most_char=1.0, most_word=1.0).where("kept = base_failed").count() == 0


def test_sampling_limit():
    draw = np.random.default_rng(5)
    reference = np.array([*range(40, 0, -1), 1500])
    for n in (20, 60, 400):
        told = quality.distance(draw.multinomial(n, reference / reference.sum(), 2000), reference)
        # nearly all samples are within the limit, and it is no more than twice the usual distance
        assert 0.98 < (told <= quality.sampling_limit(n, reference)).mean() and quality.sampling_limit(n, reference) < 2 * told.mean()
    assert quality.sampling_limit(60, reference / 100) > quality.sampling_limit(60, reference)  # a small reference says less


def test_short_texts_have_a_word_distance(spark):
    rng = random.Random(4)
    common = lambda n: [rng.choice(EN) for _ in range(n)]
    fill = lambda n: " ".join(x for w in common(n // 2) for x in (w, f"some{rng.randint(0, 9999)}")) + "."
    odd = lambda n: " ".join(f"some{rng.randint(0, 9999)}" for _ in range(n)) + "."
    rows = [(i, fill(150)) for i in range(60)] + [(100 + n, fill(n)) for n in range(20, 100, 2)] + [(300 + n, odd(n)) for n in range(28, 100, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en"))
    gone = {r["id"]: r for r in quality.quality(docs).where("NOT kept").collect()}
    assert set(gone) == {i for i, _ in rows if i >= 300} and all(r["char_distance"] <= quality.MOST_CHAR for r in gone.values())


ALPHABETS = {"ko": [chr(0xAC00 + 37 * k) for k in range(200)], "zh": [chr(0x4E00 + 11 * k) for k in range(400)], "ru": list("абвгдежзийклмнопрстуфхцчшыьэюя"), "it": list("aeioaeiotrnlscdpmvugfbzhq"), "ar": list("ابتثجحخدذرزسشصضطظعغفقكلمنهوي"), "th": [chr(c) for c in range(0xE01, 0xE2F)]}


@pytest.mark.parametrize("share", [60, 3])
def test_every_language_has_a_reference(spark, share):
    """Clean texts of any language stay, however few; junk in it goes where it has a reference of its own."""
    rng = random.Random(6)
    rows, junk = [(i, " ".join(rng.choice([*EN, *EN, f"some{rng.randint(0, 999)}"]) for _ in range(150)) + ".", "en") for i in range(150)], set()
    for j, (lang, letters) in enumerate(ALPHABETS.items()):
        word = lambda few, many, a=letters: "".join(rng.choice(a) for _ in range(rng.randint(few, many)))
        common = [word(1, 3) for _ in range(12)]
        say = lambda n, c=common, w=word: " ".join(rng.choice([*c, w(3, 8)]) for _ in range(n)) + "."
        first = 1000 * (j + 1)
        rows += [(first + i, say(120), lang) for i in range(share)] + [(first + 500, say(120), None)]
        if share > 50:
            junk |= {first + 600, first + 601}
            rows += [(first + 600, "%%% ".join(say(120).split(" ")), lang), (first + 601, " ".join(word(6, 9) for _ in range(200)), lang)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["id"]: r for r in quality.quality(docs).collect()}
    assert {i for i, r in got.items() if not r["kept"]} == junk and len(got) == len(rows)


@pytest.mark.parametrize("size", [60, 1900, 2500])
def test_a_small_language_frees_nothing(spark, size):
    """Junk of a language, and junk without one, is rejected with a further language of the script as without."""
    rng = random.Random(10)
    letters = ALPHABETS["it"]
    word = lambda few, many: "".join(rng.choice(letters) for _ in range(rng.randint(few, many)))
    own = [word(1, 3) for _ in range(12)]
    english = lambda n: " ".join(rng.choice([*EN, f"some{rng.randint(0, 999)}"]) for _ in range(n)) + "."
    junk = lambda n: " ".join(word(4, 9) for _ in range(n)) + "."
    other = lambda n: " ".join(rng.choice([*own, word(3, 8)]) for _ in range(n)) + "."
    rows = [(i, english(150), "en") for i in range(100)]
    rows += [(200 + k, junk(n), lang) for k, (n, lang) in enumerate((n, lang) for n in (60, 80, 94, 150) for lang in ("en", None))]
    rows += [(220, "%%% ".join(english(60).split(" ")), None), (221, english(70), None)]
    before = {r["id"] for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("not kept").collect()}
    assert before == {*range(200, 208), 220}
    rows += [(300 + k, other(n), "xx") for k, n in enumerate([size] if size < 100 else [100] * (size // 100))]
    after = {r["id"] for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("not kept").collect()}
    assert after == before


def test_null_languages_and_small_references(spark):
    """Without a language: a small reference may claim a text by its words and characters; where none of the
    script has a say, characters decide."""
    rng = random.Random(14)
    letters = ALPHABETS["it"]
    word = lambda few, many: "".join(rng.choice(letters) for _ in range(rng.randint(few, many)))
    own = [word(1, 3) for _ in range(12)]
    other = lambda n: " ".join(rng.choice([*own, *own, word(3, 8)]) for _ in range(n)) + "."
    english = lambda n: " ".join(rng.choice([*EN, f"some{rng.randint(0, 999)}"]) for _ in range(n)) + "."
    small = [(300 + k, other(100), "xx") for k in range(9)]
    asked = [(1, other(100), None), (2, " ".join(word(4, 9) for _ in range(100)) + ".", None), (3, "%%% ".join(other(100).split(" ")), None)]
    kept = lambda rows: {r["id"] for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).where("kept and id < 100").collect()}
    assert kept([*small, *asked, *((500 + i, english(150), "en") for i in range(60))]) == {1}
    assert kept([*small, *asked]) == {1, 2}


def test_language_without_reference(spark, monkeypatch):
    """A language under the bound is judged by the base rules only."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice([*EN, f"some{rng.randint(0, 999)}"]) for _ in range(150)), "en") for i in range(80)]
    rows += [(200, " ".join("".join(rng.choice(ALPHABETS["ru"]) for _ in range(5)) for _ in range(120)), "ru"), (201, "слово " * 30, "ru"), (202, " ".join("".join(rng.choice(ALPHABETS["ru"]) for _ in range(5)) for _ in range(120)), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = quality.common_words
    monkeypatch.setattr(quality, "common_words", lambda *a: few(*a, langs=40))
    got = {r["id"]: r for r in quality.quality(docs).collect()}
    assert got[200]["kept"] and got[200]["char_distance"] == 0 and got[201]["base_failed"] and got[202]["kept"]
    assert sum(not r["kept"] for r in got.values()) == 1


@pytest.mark.parametrize("langs", [1, 3])
def test_rare_languages_are_judged_alike(spark, monkeypatch, langs):
    """Languages under the bound have references too: verdicts don't hang on the bound."""
    rng = random.Random(15)
    rows = [(i, " ".join(rng.choice([*EN, *EN, f"some{rng.randint(0, 999)}"]) for _ in range(150)) + ".", "en") for i in range(90)]
    rows += [(90 + k, t, lang) for k, (t, lang) in enumerate([(rows[0][1], "it"), (rows[1][1], None), ("%%% ".join(rows[2][1].split(" ")), "it"), ("%%% ".join(rows[3][1].split(" ")), None), (None, "it"), ("", "none"), ("1 2 " * 5, "digits")])]
    junk = set()
    for j, (lang, letters) in enumerate(ALPHABETS.items()):
        word = lambda few, many, a=letters: "".join(rng.choice(a) for _ in range(rng.randint(few, many)))
        common = [word(1, 3) for _ in range(12)]
        say = lambda n, c=common, w=word: " ".join(rng.choice([*c, w(3, 8)]) for _ in range(n)) + "."
        first = 1000 * (j + 1)
        rows += [(first + i, say(120), lang) for i in range(25 if j % 2 else 4)] + [(first + 500, say(60), None), (first + 501, say(60), "en")]
        rows += [(first + 600, "%%% ".join(say(120).split(" ")), lang), (first + 601, " ".join(word(6, 9) for _ in range(200)), lang), (first + 602, " ".join(word(6, 9) for _ in range(200)), None)]
        junk |= {first + 600, first + 601} if j % 2 else set()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = lambda: {r["id"]: r for r in quality.quality(docs).collect()}
    wide = told()
    few = quality.common_words
    monkeypatch.setattr(quality, "common_words", lambda *a: few(*a, langs=langs))
    got = told()
    assert len(few(docs, langs=langs)) == (langs > 1) and got.keys() == wide.keys() and len(got) == len(rows)
    assert {i for i, r in got.items() if r["kept"]} == {i for i, r in wide.items() if r["kept"]}
    assert junk <= {i for i, r in got.items() if not r["kept"]}
    # what no reference keeps has the nearest's distances, and all else the same figures
    same = lambda r: [r[c] for c in quality.BASE] + ([] if r["kept"] or r["base_failed"] else [round(r[c], 9) for c in quality.DISTANCES])
    assert {i: same(r) for i, r in got.items()} == {i: same(r) for i, r in wide.items()}
    assert {r["doc_id"] for r in quality.accepted(docs).collect()} == {i for i, r in wide.items() if r["kept"]}


# ---------------------------------------------------------------- personal data
PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    ok = {"email": lambda s, d: True, "ip": lambda s, d: all(int(p) <= 255 for p in s.split(".")), "card": lambda s, d: 12 <= len(d) <= 19 and pii.luhn(d), "phone": lambda s, d: 9 <= len(d) <= 15}
    out = [(k, m.start(), m.end()) for k, (n, p) in enumerate(PATTERNS) for m in re.finditer(p, text) if ok[n](m[0], re.sub("[^0-9]", "", m[0]))]
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_patterns_against_plain_ones():
    rng = random.Random(3)
    parts = ["a@b.c", "@", ".", "-", "+", " ", "1", "23", "255", "256.", "4111111111111111", "x", "é", "(", ")", "+1 ", "\n", "a.b", "00", "@d.e-f", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    import time

    began = time.time()
    for c in ("a", "1", "1.", "a.", "+1", "@", "a@", "-", "1-"):
        pii.base_spans(c * 100_000)
    assert time.time() - began < 20


@pytest.fixture(scope="module")
def field():
    return pii.default_field()


def test_held_out_accuracy(field):
    right = wrong = missed = 0
    for tokens, labels in pii.labelled_rows(300, seed=99):
        runs = pii.runs_of(tokens)
        for (a, b), got in zip(runs, field.decode([field.scores([pii.features(tokens, k) for k in range(a, b)]) for a, b in runs]), strict=True):
            for g, want in zip(got, labels[a:b], strict=True):
                name = pii.LABELS[g]
                right += name == want != "O"
                wrong += name not in ("O", want)
                missed += want not in ("O", name)
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.95


def test_features_read_whole_tokens():
    head = "https://a.example/" + "k=v&" * 60
    for one, other in (("ip=2001:db8::1", "ip=none"), ("tel=(415)555-2671", "tel=415"), ("12", "1234")):
        assert pii.shape(head + one) != pii.shape(head + other) or pii.groups(head + one) != pii.groups(head + other)
        assert pii.features([head + one], 0) != pii.features([head + other], 0)
    began = time.time()
    pii.features(["1a." * 100_000] * 3, 1)
    assert time.time() - began < 10


def test_viterbi_is_the_best_path(field):
    import itertools

    rng = np.random.default_rng(0)
    n = len(pii.LABELS)
    for length in (1, 2, 3):
        e = rng.normal(size=(length, n))
        score = lambda p, e=e: field.trans[0, p[0]] + sum(e[t, x] for t, x in enumerate(p)) + sum(field.trans[a, b] for a, b in itertools.pairwise(p)) + field.trans[p[-1], 0]
        best = max(itertools.product(range(n), repeat=length), key=score)
        assert tuple(field.decode([e])[0]) == best


def test_many_spans_take_linear_time(field):
    text = " ".join(f"10.0.{k % 256}.{k // 256} call (212) 555-{k % 10000:04} now" for k in range(20_000))
    began = time.process_time()
    spans = pii.all_spans([text], field)[0]
    assert time.process_time() - began < 40 and sum(s[3] for s in spans) == 20_000 and sum(not s[3] for s in spans) > 10_000
    ends = [(a, b) for _, a, b, _ in spans]
    assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:], strict=False))


def test_spans(spark, field):
    texts = ["call (415) 555-2671 now, or mail x@y.org", "order 123456 on 2024-01-31, $1,234.50, v1.2.3", "ip 2001:db8::1 and 8.8.8.8", None, "", "no data here", "é +1 (743) 555-3824 and 4111 1111 1111 1111", "word " * 60_000 + "a@b.co"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    out = df.select("doc_id", "text", pii.find_spans(F.col("text"), field).alias("found")).withColumn("clean", pii.redact(F.col("text"), F.col("found")))
    got = {r["doc_id"]: r for r in out.collect()}
    shown = {i: [(s["kind"], texts[i][s["start"] : s["end"]], s["base"]) for s in r["found"]] for i, r in got.items()}
    assert shown[0] == [("phone", "(415) 555-2671", False), ("email", "x@y.org", True)] and shown[1] == [] and shown[2] == [("ip", "2001:db8::1", False), ("ip", "8.8.8.8", True)]
    assert shown[3] == shown[4] == shown[5] == [] and shown[6] == [("phone", "+1 (743) 555-3824", True), ("card", "4111 1111 1111 1111", True)] and shown[7] == [("email", "a@b.co", True)]
    assert got[0]["clean"] == "call [PHONE] now, or mail [EMAIL]" and got[3]["clean"] is None and got[4]["clean"] == "" and got[1]["clean"] == texts[1]
    for i, t in enumerate(texts):
        assert [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in got[i]["found"] if s["base"]] == plain_spans(t or "")


def test_redacted_is_one_python_step(spark, field):
    """The same text as by spans, from one Python worker for a task."""
    texts = [None, "", "no data", "a@b.co and (212) 555-2671 now", "+1 212 555 2671 or 10.0.0.1\nmail x_y@z.org.", "é 4111 1111 1111 1111"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    out = df.select("i", "text", pii.redacted(F.col("text"), field).alias("new"))
    want = df.select("i", pii.redact(F.col("text"), pii.find_spans(F.col("text"), field)).alias("new"))
    assert {r["i"]: r["new"] for r in out.collect()} == {r["i"]: r["new"] for r in want.collect()} and "[PHONE]" in out.where("i = 3").first()["new"]
    import corpus_pipeline

    stage = corpus_pipeline.personal_data(spark, df, "")
    assert stage._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_meeting_spans_are_one(spark):
    df = spark.sql("SELECT 'abcdef' AS t, array(named_struct('kind', 'card', 'start', 1, 'end', 4, 'base', true), named_struct('kind', 'phone', 'start', 2, 'end', 5, 'base', true)) AS s")
    assert df.select(pii.redact(F.col("t"), F.col("s")).alias("r")).first()["r"] == "a[CARD]f"


# ---------------------------------------------------------------- language
WORDS = {"en": "the house and water with nothing there thing".split(), "fr": "maison avec être où déjà le quelle beaucoup".split(), "de": "haus und wasser nicht straße über ich schön".split()}


def test_addresses():
    assert la.address("https://u@m.a.example.de:80/fr/x?y") == ("m.a.example.de", "example.de", "de", "fr") and la.address("odd") == ("", "", "", "")
    assert la.address("http://h.com/fra/") == ("h.com", "h.com", "", "") and la.page_text("<script>x</script><p>a&amp;b<!-- c --></p>").split() == ["a&b"]


def language_rows(spark, seed=1):
    rng = random.Random(seed)
    say = lambda lang, n: " ".join(rng.choice(WORDS[lang]) for _ in range(n))
    docs = spark.createDataFrame([(say(x, 60), x) for x in WORDS for _ in range(30)] + [(None, "en"), ("x", None), ("junk", "?")], "text string, lang string")
    pages, truth = [], {}
    for k in range(240):
        lang = rng.choice(list(WORDS)) if k % 3 else "fr"
        host = "hot.example.fr" if k % 3 == 0 else f"h{k % 7}.{lang}.example.com"
        declared = lang if rng.random() < 0.9 else "en"
        body = say(lang, 40 if k % 5 else 0)
        pages.append((k, f"https://{host}/{lang if k % 2 else 'x1'}/p", f'<html lang="{declared}"><body><p>{body}</p></body></html>', "c"))
        truth[k] = lang
    pages += [(900, None, None, "c"), (901, "odd", "", "c"), (902, "https://hot.example.fr/", "<p>" + say("de", 200) + "</p>", "c"), (None, "https://x.y/", "<p>x</p>", "c")]
    return spark.createDataFrame(pages, "page_id long, url string, html string, host string"), docs, truth


def test_language_against_numpy(spark):
    pages, docs, truth = language_rows(spark)
    got = {r["id"]: r for r in la.language_id(pages, docs).collect()}
    assert sum(got[k]["lang"] == v for k, v in truth.items()) / len(truth) > 0.98
    assert got[902]["lang"] == "de" and got[900]["host"] is None and len(got) == len(truth) + 4
    # the same by one process: text, priors and evidence from plain sums
    rows = [r for r in pages.collect()]
    counts = {}
    for t, x in ((r["text"], r["lang"]) for r in docs.collect()):
        if x and re.fullmatch("[a-z]{2,3}", x):
            own = counts.setdefault(x, np.zeros(la.GRAMS + 1, int))
            own[:-1] += np.bincount(la.grams(t or ""), minlength=la.GRAMS)
            own[-1] += 1
    model = la.TextModel([(x, g if g < la.GRAMS else -1, int(n)) for x, own in counts.items() for g, n in enumerate(own) if n])
    text = np.array([model.score(la.page_text(r["html"] or "")) for r in rows])
    share = np.rint(la.softmax(text) * la.UNIT) / la.UNIT
    where = [la.address(r["url"] or "") for r in rows]
    said = [m[1].lower() if (m := la.DECLARED.search(r["html"] or "")) else "" for r in rows]
    n = len(model.langs)
    for i, r in enumerate(rows):
        p = (t := share.sum(0) - share[i] + 1 / n) / t.sum()
        for level in (1, 0):
            own = sum((share[j] for j in range(len(rows)) if j != i and where[j][0] and where[i][0] and where[j][level] == where[i][level]), np.zeros(n))
            p = (own + la.PARENT * p) / (own.sum() + la.PARENT)
        total = text[i] + np.log(p)
        for values in (said, [w[2] for w in where], [w[3] for w in where]):
            hit = sum((share[j] for j in range(len(rows)) if values[j] == values[i]), np.zeros(n))
            total = total + np.log((hit + la.SHY / len(set(values))) / (share.sum(0) + la.SHY))
        p = la.softmax(total)
        assert got[r["page_id"]]["lang"] == model.langs[int(p.argmax())] and abs(got[r["page_id"]]["confidence"] - p.max()) < 2e-4


def test_page_texts():
    text = lambda h: la.page_text(h).split()
    assert text("<head><title>t</title><body>a</body>") == ["a"] and text("<head><title>t</title><p>a</p>") == ["a"]
    assert text("<head><script>'<p>x'</script><title>t</title></head><header>h</header><nav>n</nav>a") == ["h", "a"]
    assert text("a<nav><a>n</a>b") == ["a", "n", "b"] and text("a<script>b<p>c") == ["a"] and text("<header>h") == ["h"]


def test_language_cases(spark):
    """Labels with a region count for their language; ids may be of any type; repeated, very long and odd pages."""
    pages, docs, _ = language_rows(spark)
    docs = docs.withColumn("lang", F.when(F.col("lang") == "de", "de-AT").otherwise(F.col("lang")))
    long = "<p>" + " ".join(WORDS["de"] * 20_000) + "</p>"
    rows = [("a", "https://x.org/", long), ("b", "https://x.org/", "<p></p>"), ("b", "https://x.org/", "<p></p>"), ("c", "https://\x00/", "<" * 5000)]
    got = la.language_id(spark.createDataFrame(rows, "page_id string, url string, html string"), docs).collect()
    assert sorted(r["id"] for r in got) == ["a", "b", "b", "c"] and {r["lang"] for r in got if r["id"] == "a"} == {"de"}
    assert len({(r["lang"], r["confidence"]) for r in got if r["id"] == "b"}) == 1
    few = la.language_id(spark.createDataFrame(rows[:1], "page_id string, url string, html string"), docs.where("lang <> 'de-AT'")).first()
    assert few["lang"] != "de"


def test_language_of_nothing(spark):
    pages, docs, _ = language_rows(spark)
    assert la.language_id(pages.limit(0), docs).count() == 0
    assert {r["lang"] for r in la.language_id(pages, docs.limit(0)).collect()} == {None}


# ---------------------------------------------------------------- pipeline
def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    from lexiloom.llm.packing import pieces_of
    from lexiloom.llm.pretok import vocab_path

    rng = random.Random(7)
    fill = lambda n: " ".join(rng.choice([*EN, f"some{rng.randint(0, 999)}", "words", "other"]) for _ in range(n)) + "."
    shared = "This very common boilerplate line is long enough to go."
    rows = [(i, fill(60) + ("\n" + shared if i % 4 == 0 else ""), "en", f"src{i % 3}") for i in range(60)]
    rows += [(100, rows[5][1], "en", "s"), (101, rows[7][1].upper().lower() + " x", "en", "s"), (102, "junk", "en", "s"), (103, None, None, None), (104, fill(40) + " mail a.b@c.org or +1 (743) 555-3824", "en", "s"), (105, fill(3000), "en", "s")]
    docs = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    # quality
    verdict = {r["id"]: r["kept"] for r in quality.quality(docs).collect()}
    left = [(i, t, lang) for i, t, lang, _ in rows if verdict[i]]
    assert {102, 103}.isdisjoint(i for i, _, _ in left) and len(left) >= 62
    # lines
    held = {}
    for i, t, _ in left:
        for line in t.split("\n"):
            held.setdefault(line.strip().lower(), set()).add(i)
    keep = lambda i, line: not (len(k := line.strip().lower()) >= 40 and len(held[k]) >= 5 and max(held[k]) != i)
    left = [(i, "\n".join(x for x in t.split("\n") if keep(i, x))) for i, t, _ in left]
    # near copies
    own = roots([plain_fingerprint(t) for _, t in left])
    least = {}
    for r, (i, _) in zip(own, left, strict=True):
        least[r] = min(i, least.get(r, i))
    left = [(i, t) for r, (i, t) in zip(own, left, strict=True) if least[r] == i]
    assert 100 not in dict(left)
    # personal data
    clean = lambda t: re.sub(r"\+1 \(743\) 555-3824", "[PHONE]", t.replace("a.b@c.org", "[EMAIL]"))
    left = [(i, clean(t)) for i, t in left]
    want = pieces_of(spark.createDataFrame(left, "doc_id long, text string"), vocab_path()).drop("slot")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "personal_data", "packing"] and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_of_nothing_and_odd_rows(spark, tmp_path):
    import corpus_pipeline

    kind = "doc_id long, text string, lang string, source string, n_chars long, __lines string"
    for name, rows in (("a", []), ("b", [(None, None, None, None, None, None), (1, "", "", "", 0, ""), (1, "x " * 30, "en", "s", 60, "c"), (None, "y z " * 3, None, None, None, None)])):
        spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / name / "documents.parquet"))
        assert corpus_pipeline.run(spark, str(tmp_path / name)).count() == 0
