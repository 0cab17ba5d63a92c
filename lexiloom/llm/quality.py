"""Quality rules: divergence of a document from its language's reference.

Three steps go over the documents. First, words are counted by language, over all
documents: the ``COMMON`` most frequent words of each language (of those with a letter)
are its common words. Second, one pass over the texts gives the base figures and two
histograms: of character classes (letters by script), and of common words, with one bin
for all other words. Their sums over a language's documents that pass the base rules are
its references. Third, a document is compared to its language's references by the
Jensen-Shannon distance (base 2, so 0 to 1) of either histogram; texts aren't read again.

A document with few words has a ragged histogram, so the word distance's limit rises to
what a sample of so many words would have against a reference of so many, and some
standard deviations: a rare language, whose reference is small, has a wider limit. The
character distance counts only from a minimum length on, of the text and of the
reference. A reference of few words has no say on words: those of its language are judged by characters.

A text may be in another language than it says: one beyond a limit is judged by the
language that it exceeds least, among its own and those with a say and RICH times its
words. A text without a language is judged by the one that it exceeds least among those of
its script. There a reference without a say can claim it by evidence only: it must be long
enough for characters to count, and the words must be within the limit for its size. So
a small reference frees no text of another language, nor one that nothing else would keep.

Every language has a reference. Those with at least 1 / LANGS of the documents are LANGS
at most: their LANGS * (COMMON + 1) counts go through the driver to every task. All others
are *rare*, and stay rows of a table: a rare language's documents are joined with its
common words and its reference, and what none of the languages so far keeps is paired
with the rare references that may judge it. Verdicts are those of one comparison with all
references; only the distances of what is kept may be another language's than the nearest's.

Cases: null and empty texts have no words and fail the base rules; bytes that aren't
UTF-8 count as U+FFFD; a language has a reference however few its documents are; a null language is judged by the
reference it exceeds least among those of its script, by characters if none of them has a
say on words, and by the base rules only if there is none; langs are compared as they are written; languages that put no blanks between words
have few words and fail the base rules unless they have many lines; an empty table gives
an empty result; repeated rows are rows of their own, and equal counts of words are
ordered by the word; further columns don't matter, whatever their names.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.llm.store import BLANKS, Shelf, small_batches, trimmed, whole_text

SYMBOLS = "#*$%&|<>"
#: Scripts whose letters have a class of their own, by the beginning of their characters' names.
SCRIPTS = ("ARABIC", "ARMENIAN", "BENGALI", "CJK", "CYRILLIC", "DEVANAGARI", "GEORGIAN", "GREEK", "HANGUL", "HEBREW", "HIRAGANA", "KATAKANA", "TAMIL", "THAI")
#: Classes of characters, in the histogram's order; lower and upper are Latin.
CLASSES = ("lower", "upper", *SCRIPTS, "other letter", "digit", "space", "newline", "stop", "quote or bracket", "symbol", "other")
LETTERS = 2 + len(SCRIPTS) + 1
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Common words of a language, and languages whose references every task has, at most; those of others are joined.
COMMON, LANGS = 32, 4096
#: Distances beyond which a document is rejected, the characters from which on the first counts, and
#: the standard deviations beyond the sampling error's mean that a text of few words may have.
MOST_CHAR, MOST_WORD, LEAST_CHARS, DEVIATIONS = 0.29, 0.28, 200, 4
#: Words from which on a reference has a say on words: the common words of fewer are chance.
LEAST_REFERENCE = 2000
#: A language that a text doesn't say it is in must have so many times its words.
RICH = 20
#: White space that str.split knows and words are not told by.
OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
#: Distinct words that a task counts before it gives them out.
HELD_WORDS = 200_000


@lru_cache(maxsize=1)
def class_of() -> np.ndarray:
    """The class of each code point of the basic plane."""
    place = {c: k for k, c in enumerate(CLASSES)}
    out = np.full(0x10000, place["other"], np.uint8)
    for cp in range(0x10000):
        c, kind = chr(cp), unicodedata.category(chr(cp))
        if kind[0] in "LM":
            script = unicodedata.name(c, "").split(" ")[0].split("-")[0]
            if script in SCRIPTS:
                out[cp] = place[script]
            else:
                out[cp] = place["lower" if kind == "Ll" else "upper" if kind in ("Lu", "Lt") else "other letter"]
        elif kind[0] == "N":
            out[cp] = place["digit"]
        elif c in "\n\r":
            out[cp] = place["newline"]
        elif c in BLANKS or kind[0] == "Z":
            out[cp] = place["space"]
        elif c in ".,;:!?":
            out[cp] = place["stop"]
        elif c in SYMBOLS or kind[0] == "S":
            out[cp] = place["symbol"]
        elif kind[0] == "P":
            out[cp] = place["quote or bracket"]
    return out


def char_histogram(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(class_of()[np.minimum(cp, 0xFFFF)], minlength=len(CLASSES))


def script_of(chars: np.ndarray) -> np.ndarray:
    """The most frequent script of histograms (Latin's cases are one): a number, -1 without letters."""
    letters = chars[..., :LETTERS].astype(float)
    letters[..., 0] += letters[..., 1]
    letters[..., 1] = 0
    return np.where(letters.sum(axis=-1) > 0, letters.argmax(axis=-1), -1)


def plain_word(word: str) -> str:
    return word.strip(".,;:!?").lower()


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The Jensen-Shannon distances of histograms along the last axis; 0 if either is empty."""
    p, q = np.broadcast_arrays(np.asarray(p, float), np.asarray(q, float))
    n, m = p.sum(axis=-1, keepdims=True), q.sum(axis=-1, keepdims=True)
    p, q = p / np.maximum(n, 1e-300), q / np.maximum(m, 1e-300)
    mean = np.maximum((p + q) / 2, 1e-300)
    part = lambda a: (a * np.log2(np.maximum(a, 1e-300) / mean)).sum(axis=-1)
    both = (n > 0)[..., 0] & (m > 0)[..., 0]
    return np.where(both, np.sqrt(np.maximum(0, (part(p) + part(q)) / 2)), 0.0)


@lru_cache(maxsize=1)
def bin_moments() -> np.ndarray:
    """(expected count, mean, variance) of what one bin adds to the squared distance of a Poisson
    sample to its source, times the sample's size. From the last expected count on they hardly change."""
    out = [(0.0, 0.0, 0.0)]
    for a in np.geomspace(1e-3, 400, 160):
        x = np.arange(int(a + 12 * a**0.5 + 20))
        p = np.exp(x * np.log(a) - a - np.array([lgamma(k + 1) for k in x]))
        v = (x * np.log2(np.maximum(2 * x, 1) / (x + a)) + a * np.log2(2 * a / (x + a))) / 2
        out.append((a, float((p * v).sum()), float((p * v * v).sum() - (p * v).sum() ** 2)))
    return np.array(out).T


def sampling_limit(n: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The distances to references (along the last axis) that samples of n words hardly exceed: mean and
    DEVIATIONS standard deviations of the squared distance. The reference is a sample too, of its own size."""
    reference = np.asarray(reference, float)
    total = np.maximum(reference.sum(axis=-1), 1)
    share = reference / total[..., None]
    n = np.maximum(np.asarray(n, float), 1)
    n = n * total / (n + total)
    at, mean, variance = bin_moments()
    expected = n[..., None] * share
    square = (np.interp(expected, at, mean) * (1 - share)).sum(axis=-1)
    square = square + DEVIATIONS * np.sqrt((np.interp(expected, at, variance) * (1 - share) ** 2).sum(axis=-1))
    return np.sqrt(square / n)


@lru_cache(maxsize=1)
def multipliers() -> np.ndarray:
    return np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(1, WINDOW + 1)], np.uint64)


def repeated_words(words: list[str]) -> int:
    """Words in windows of WINDOW words that are found twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    of: dict[str, int] = {}
    ids = np.array([of.setdefault(w, len(of)) for w in words], np.uint64) + np.uint64(1)
    h = np.zeros(n, np.uint64)
    for k, m in enumerate(multipliers()):
        h += ids[k : k + n] * m
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    at = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
    windows = [tuple(words[i : i + WINDOW]) for i in at]  # equal hashes may be chance: the words decide
    found = Counter(windows)
    mark = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(at, windows, strict=True):
        if found[w] > 1:
            mark[i] += 1
            mark[i + WINDOW] -= 1
    return int((np.cumsum(mark) > 0).sum())


def words_of(text: str) -> list[str]:
    """Words between the six ASCII blanks (str.split knows more)."""
    return text.split() if OTHER_BLANKS(text) is None else [w.decode() for w in text.encode().split()]


def base_figures(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            seen.add(line)
    dup = lines - len(seen)
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words)


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat > MOST_REPEATED * n_words


# ---------------------------------------------------------------- common words
def ranked_words(rows: DataFrame, most: int) -> DataFrame:
    """(lang, word, n, rank) of the ``most`` most frequent words of each language of (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        distinct = 0

        def given() -> Iterator[pa.RecordBatch]:
            for name, counter in held.items():
                plain: Counter = Counter()
                for w, n in counter.items():
                    plain[plain_word(w)] += n
                words = [w for w in plain if any(map(str.isalpha, w))]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(words), pa.string()), pa.array(words, pa.string()), pa.array([plain[w] for w in words], pa.int64())], ["lang", "word", "n"])
            held.clear()

        for b in trimmed(batches):
            for t, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = held.setdefault(name, Counter())
                distinct -= len(own)
                own.update(words_of(t))
                distinct += len(own)
                if distinct + len(held) > HELD_WORDS:
                    yield from given()
                    distinct = 0
        yield from given()

    words = rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))  # limited within tasks first
    return words.withColumn("rank", rank).where(F.col("rank") <= most)


def common_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = COMMON, langs: int = LANGS) -> dict[str, list[str]]:
    """The most frequent words of each language with at least 1 / ``langs`` of the documents."""
    small_batches(docs.sparkSession)
    lang = F.col(lang_col).cast("string")
    sizes = docs.select(lang.alias("lang")).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.crossJoin(sizes.agg(F.sum("n").alias("total")))  # one row
    known = {r["lang"] for r in sizes.where(F.col("lang").isNotNull() & (F.col("n") * langs >= F.col("total"))).select("lang").collect()}

    rows = docs.select(whole_text(F.col(text_col)).alias("text"), lang.alias("lang")).where(F.col("lang").isin(*sorted(known)))
    out: dict[str, list[str]] = {name: [] for name in sorted(known)}
    for r in sorted(ranked_words(rows, most).collect(), key=lambda r: (r["lang"], r["rank"])):
        out[r["lang"]].append(r["word"])
    return out


# ---------------------------------------------------------------- figures
#: One pass over a text gives all that needs the text: base figures and both histograms. own: counts of the
#: language's common words and of all others; at, n: which words of all languages' lists it has, and how often.
FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars array<int>, own array<int>, at array<int>, n array<int>"


def vocabulary(common: dict[str, list[str]]) -> dict[str, int]:
    return {w: k for k, w in enumerate(sorted({w for words in common.values() for w in words}))}


def figures(text: Column, lang: Column, common: dict[str, list[str]], listed: Column | None = None) -> Column:
    """Struct FIGURES of a text. listed: the common words of its language, where this is none of ``common``."""
    every = vocabulary(common)
    places = {name: {every[w]: k for k, w in enumerate(words)} for name, words in common.items()}

    @F.arrow_udf(f"struct<{FIGURES.replace(' ', ':').replace(',:', ',')}>")
    def of(texts: pa.Array, langs: pa.Array, *lists: pa.Array) -> pa.Array:
        base, chars, owns, ats, ns = [], [], [], [], []
        rare = lists[0].to_pylist() if lists else [None] * len(texts)
        for t, name, words_listed in zip(texts.to_pylist(), langs.to_pylist(), rare, strict=True):
            words = words_of(t)
            base.append(base_figures(t, words))
            chars.append(char_histogram(t))
            found: Counter = Counter()
            own = np.zeros(COMMON + 1 if lists or name in places else 0, np.int64)
            mine = {w: k for k, w in enumerate(words_listed or ())}
            for w, n in Counter(words).items():
                plain = plain_word(w)
                if (k := every.get(plain)) is not None:
                    found[k] += n
                if mine and (i := mine.get(plain)) is not None:
                    own[i] += n
            for k, n in found.items():
                if name in places and (i := places[name].get(k)) is not None:
                    own[i] = n
            own[-1:] = len(words) - own.sum()
            owns.append(own)
            ats.append(np.fromiter(found.keys(), np.int64, len(found)))
            ns.append(np.fromiter(found.values(), np.int64, len(found)))
        lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, c)]), pa.int32()), pa.array(np.concatenate([np.zeros(0), *c]).astype(np.int32))) for c in (chars, owns, ats, ns)]
        longs = [pa.array([r[k] for r in base], pa.int64()) for k in range(5)]
        return pa.StructArray.from_arrays([*longs, *lists], names=[p.split()[0] for p in FIGURES.split(", ")])

    return of(whole_text(text), lang, *([] if listed is None else [listed]))


def compared(chars: np.ndarray, words: np.ndarray, ref_chars: np.ndarray, ref_words: np.ndarray, told: np.ndarray, most_word: float) -> np.ndarray:
    """Rows of (character distance, word distance, its limit) to a reference each; the word distance is 0
    where it isn't to be ``told``, the character distance where the text or the reference is short."""
    long = (chars.sum(axis=-1) >= LEAST_CHARS) & (ref_chars.sum(axis=-1) >= LEAST_CHARS)
    char = np.where(long, distance(chars, ref_chars), 0.0)
    word = np.where(told, distance(words, ref_words), 0.0)
    return np.stack([char, word, np.maximum(most_word, sampling_limit(words.sum(axis=-1), ref_words))], axis=1)


def exceeded(rows: np.ndarray, most_char: float) -> np.ndarray:
    """By how much rows of ``compared`` are beyond their limits; 0 or less: they are within."""
    return np.maximum(rows[..., 0] - most_char, rows[..., 1] - rows[..., 2])


class References:
    """References of languages, and verdicts on histograms."""

    def __init__(self, common: dict[str, list[str]], chars: dict[str, list[int]], words: dict[str, dict[int, int]]):
        every = vocabulary(common)
        self.langs = [name for name in common if name in chars]
        self.place = {name: k for k, name in enumerate(self.langs)}
        self.chars = np.array([chars[name] for name in self.langs], float).reshape(-1, len(CLASSES))
        self.words = np.zeros((len(self.langs), COMMON + 1))
        self.at = np.full((len(self.langs), COMMON), len(every))  # the last place of all is never counted
        for k, name in enumerate(self.langs):
            for i, n in words.get(name, {}).items():
                self.words[k, i] = n
            self.at[k, : len(common[name])] = [every[w] for w in common[name]]
        self.size = len(every)
        self.script = script_of(self.chars)
        self.total = self.words.sum(axis=1)
        self.say, self.long = self.total >= LEAST_REFERENCE, self.chars.sum(axis=1) >= LEAST_CHARS

    def candidates(self, own: int, n_words: int, script: int, named: bool, said: frozenset[int]) -> tuple[np.ndarray, np.ndarray]:
        """(references that a text beyond its own, or without a language, may be judged by; whether their words
        count). said: scripts of the rare references with a say."""
        if named:
            fit = self.say & (self.total >= RICH * n_words)
            if own >= 0:
                fit[own] = True
            return np.flatnonzero(fit), self.say[fit]
        fit = self.script == script
        if script in said or (fit & self.say).any():  # then those without a say need all evidence
            fit &= self.say | self.long
            return np.flatnonzero(fit), np.ones(fit.sum(), bool)
        return np.flatnonzero(fit), np.zeros(fit.sum(), bool)

    def judge(self, langs: list[str | None], n_words: np.ndarray, chars: np.ndarray, owns: list[list[int]], ats: list[list[int]], ns: list[list[int]], most_char: float, most_word: float, rare: tuple[list, list] | None = None, said: frozenset[int] = frozenset()) -> np.ndarray:
        """Rows of (character distance, word distance, its limit, by how much they are exceeded); zeros, most_word
        and infinity for a text without a language that no reference may judge. rare: character and word
        counts of the references of the texts' own languages where these aren't among ``langs``, else None."""
        out = np.tile(np.array([0.0, 0.0, most_word]), (len(langs), 1))
        which = np.array([-1 if x is None else self.place.get(x, -1) for x in langs], np.int64)
        known = np.flatnonzero(which >= 0)
        if known.size:
            of = which[known]
            out[known] = compared(chars[known], np.array([owns[k] for k in known]), self.chars[of], self.words[of], self.say[of], most_word)
        own = np.flatnonzero([x is not None for x in rare[0]]) if rare else np.zeros(0, np.int64)
        if own.size:
            ref_chars, ref_words = (np.array([x[k] for k in own], float) for x in rare)
            out[own] = compared(chars[own], np.array([owns[k] for k in own]), ref_chars, ref_words, ref_words.sum(axis=1) >= LEAST_REFERENCE, most_word)
        over = exceeded(out, most_char)
        script = script_of(chars)
        over[[x is None for x in langs]] = np.inf
        for k in np.flatnonzero(over > 0).tolist():
            few, told = self.candidates(int(which[k]), int(n_words[k]), int(script[k]), langs[k] is not None, said)
            if not few.size:
                continue
            dense = np.zeros(self.size + 1)
            dense[ats[k]] = ns[k]
            words = dense[self.at[few]]
            words = np.concatenate([words, n_words[k] - words.sum(axis=1, keepdims=True)], axis=1)
            rows = compared(np.broadcast_to(chars[k], (few.size, chars.shape[1])), words, self.chars[few], self.words[few], told, most_word)
            least = exceeded(rows, most_char)
            best = least.argmin()
            if which[k] >= 0 or least[best] < over[k]:  # a wide language is among the few itself
                out[k], over[k] = rows[best], least[best]
        return np.concatenate([out, over[:, None]], axis=1)


def references(figured: DataFrame, common: dict[str, list[str]]) -> References:
    """Of documents that pass the base rules: LANGS rows of each sum at most."""
    good = figured.where(~F.col("base_failed") & F.col("lang").isin(*common))
    chars = good.groupBy("lang").agg(F.array(*[F.sum(F.col("chars")[k]) for k in range(len(CLASSES))]).alias("chars"))
    words = good.select("lang", F.posexplode("own").alias("place", "n")).groupBy("lang", "place").agg(F.sum("n").alias("n"))
    found: dict[str, dict[int, int]] = {}
    for r in words.collect():
        found.setdefault(r["lang"], {})[r["place"]] = r["n"]
    return References(common, {r["lang"]: r["chars"] for r in chars.collect()}, found)


# ---------------------------------------------------------------- rare languages
def script_col(chars: Column) -> Column:
    """``script_of`` a column of histograms."""
    letters = F.concat(F.array(chars[0] + chars[1], F.lit(0).cast("long")), F.slice(chars, 3, LETTERS - 2))
    return F.when(F.array_max(letters) > 0, F.array_position(letters, F.array_max(letters)) - 1).otherwise(-1).cast("int")


def rare_references(figured: DataFrame, listed: DataFrame) -> DataFrame:
    """(lang, listed, ref_chars, ref_words, total, long, script) of each language of ``figured``: its sums over
    documents that pass the base rules."""
    sums = lambda name, n: F.array(*[F.sum(F.col(name)[k]).cast("long") for k in range(n)])
    out = figured.where(~F.col("base_failed")).groupBy("lang").agg(sums("chars", len(CLASSES)).alias("ref_chars"), sums("own", COMMON + 1).alias("ref_words"))
    total = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda a, x: a + x)
    out = out.join(listed, "lang", "left").withColumn("total", total("ref_words"))
    return out.withColumn("long", total("ref_chars") >= LEAST_CHARS).withColumn("script", script_col(F.col("ref_chars")))


def plain_counts(text: Column) -> Column:
    """(word, n) of a text's plain words."""

    @F.arrow_udf("array<struct<word:string,n:int>>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            plain: Counter = Counter()
            for w, n in Counter(words_of(t)).items():
                plain[plain_word(w)] += n
            out.append([{"word": w, "n": n} for w, n in plain.items()])
        return pa.array(out, pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())])))

    return of(text)


def best_of_rare(asked: DataFrame, refs: DataFrame, said: frozenset[int], shelf: Shelf, most_char: float, most_word: float) -> DataFrame:
    """(key, best) of texts (key, lang, n_words, chars, text): the distances to the rare reference that a text
    exceeds least, of those that may judge it. Texts and references are paired, each pair a row."""
    words = asked.select("key", F.explode(plain_counts(F.col("text"))).alias("w")).select("key", "w.*")
    words = words.join(refs.select(F.explode("listed").alias("word")).distinct(), "word")
    found = words.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("found"))
    asked = asked.select("key", F.col("lang").isNotNull().alias("named"), "n_words", "chars", script_col(F.col("chars").cast("array<long>")).alias("own_script"))
    asked = shelf.put(asked.join(found, "key", "left"), "asked")
    say = F.col("total") >= LEAST_REFERENCE
    evident = F.col("own_script").isin(*said)  # then those without a say need all evidence
    fit = F.when(F.col("named"), say & (F.col("total") >= RICH * F.col("n_words"))).otherwise((F.col("script") == F.col("own_script")) & (~evident | say | F.col("long")))
    pairs = asked.join(refs, fit)
    counts = F.transform("listed", lambda w: F.coalesce(F.try_element_at("found", w), F.lit(0)))
    counts = F.concat(counts, F.array_repeat(F.lit(0), F.lit(COMMON) - F.size("listed")))

    @F.arrow_udf("struct<over:double,char_distance:double,word_distance:double,word_limit:double>")
    def compare(n_words: pa.Array, chars: pa.Array, counts: pa.Array, ref_chars: pa.Array, ref_words: pa.Array, told: pa.Array) -> pa.Array:
        square = lambda x, n: x.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, n)
        words = square(counts, COMMON)
        words = np.concatenate([words, n_words.to_numpy(zero_copy_only=False)[:, None] - words.sum(axis=1, keepdims=True)], axis=1)
        rows = compared(square(chars, len(CLASSES)), words, square(ref_chars, len(CLASSES)), square(ref_words, COMMON + 1), told.to_numpy(zero_copy_only=False), most_word)
        return pa.StructArray.from_arrays([pa.array(x) for x in (exceeded(rows, most_char), *rows.T)], names=["over", "char_distance", "word_distance", "word_limit"])

    told = F.col("named") | evident
    return pairs.select("key", compare("n_words", "chars", counts, "ref_chars", "ref_words", told).alias("best")).groupBy("key").agg(F.min("best").alias("best"))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


DISTANCES = ["char_distance", "word_distance", "word_limit"]


def _judged(docs: DataFrame, carried: Column, text_col: str, lang_col: str, most_char: float, most_word: float, whole: bool) -> DataFrame:
    """(carried, base figures, distances, kept) of each row. whole: ``carried`` has all columns, and rows that
    fail the base rules are left out."""
    small_batches(docs.sparkSession)
    common = common_words(docs, text_col, lang_col)
    lang = F.col(lang_col).cast("string")
    shelf = Shelf(docs.sparkSession, "quality")
    is_rare = lang.isNotNull() & ~lang.isin(*common)
    any_rare = bool(docs.agg(F.max(is_rare)).first()[0])
    # only where there are rare languages may a text be read again
    text = [] if whole or not any_rare else [F.col("__text").alias("text")]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))

    def written(rows: DataFrame, *more: Column, listed: Column | None = None, name: str) -> DataFrame:
        """The figures of rows (carried, __lang, __text)."""
        made = rows.select("carried", F.col("__lang").alias("lang"), *more, *text, figures(F.col("__text"), F.col("__lang"), common, listed).alias("f"))
        made = made.select(*[c for c in made.columns if c != "f"], "f.*").withColumn("base_failed", failed)
        return shelf.put(made.where(~failed) if whole else made, name)

    rows = docs.select(carried.alias("carried"), lang.alias("__lang"), F.col(text_col).alias("__text"))
    key = F.monotonically_increasing_id()
    if any_rare:
        its_own = F.col("__lang").isNotNull() & ~F.col("__lang").isin(*common)
        wide = written(rows.where(~its_own), key.alias("key"), name="figures")
        few = rows.where(its_own)
        listed = ranked_words(few.select(whole_text(F.col("__text")).alias("text"), F.col("__lang").alias("lang")), COMMON)
        listed = listed.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("listed"))
        listed = shelf.put(listed, "listed")
        few = few.join(listed.withColumnRenamed("lang", "__lang"), "__lang", "left")
        few = written(few, (-1 - key).alias("key"), listed=F.col("listed"), name="rare_figures")
        refs = shelf.put(rare_references(few, listed).withColumn("listed", F.coalesce("listed", F.array().cast("array<string>"))), "references")
        figured = wide.withColumns({x: F.lit(None).cast("array<long>") for x in ("ref_chars", "ref_words")}).unionByName(few.join(refs.select("lang", "ref_chars", "ref_words"), "lang", "left"))
        said = frozenset(r["script"] for r in refs.where(F.col("total") >= LEAST_REFERENCE).select("script").distinct().collect())
    else:
        figured = wide = written(rows, name="figures")
        said = frozenset()
    known = references(wide, common)

    @F.arrow_udf("struct<char_distance:double,word_distance:double,word_limit:double,over:double>")
    def judge(langs: pa.Array, n_words: pa.Array, chars: pa.Array, owns: pa.Array, ats: pa.Array, ns: pa.Array, *rare: pa.Array) -> pa.Array:
        histograms = np.array(chars.to_pylist(), float).reshape(-1, len(CLASSES))
        theirs = tuple(x.to_pylist() for x in rare) if rare else None
        told = known.judge(langs.to_pylist(), n_words.to_numpy(zero_copy_only=False), histograms, owns.to_pylist(), ats.to_pylist(), ns.to_pylist(), most_char, most_word, theirs, said)
        return pa.StructArray.from_arrays([pa.array(told[:, k]) for k in range(4)], names=[*DISTANCES, "over"])

    out = figured.withColumn("told", judge("lang", "n_words", "chars", "own", "at", "n", *(["ref_chars", "ref_words"] if any_rare else [])))
    if any_rare:
        asks = ~F.col("base_failed") & (F.col("told.over") > 0)
        again = out.where(asks).select("key", "lang", "n_words", "chars", whole_text(F.col("carried")[text_col] if whole else F.col("text")).alias("text"))
        every = said | {int(x) for x in known.script[known.say]}
        best = best_of_rare(again, refs, frozenset(every), shelf, most_char, most_word)
        asked = out.where(asks).join(best, "key", "left")
        nearer = F.col("best.over") < F.col("told.over")
        asked = asked.select("carried", *BASE, *[F.when(nearer, F.col(f"best.{x}")).otherwise(F.col(f"told.{x}")).alias(x) for x in DISTANCES])
        out = out.where(~asks).select("carried", *BASE, *[f"told.{x}" for x in DISTANCES]).unionByName(asked)
    else:
        out = out.select("carried", *BASE, *[f"told.{x}" for x in DISTANCES])
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("char_distance") <= most_char) & (F.col("word_distance") <= F.col("word_limit")))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_char: float = MOST_CHAR, most_word: float = MOST_WORD) -> DataFrame:
    """(id, figures, base_failed, char_distance, word_distance, word_limit, kept) of each row of ``docs``."""
    return _judged(docs, F.col(id_col), text_col, lang_col, most_char, most_word, False).withColumnRenamed("carried", "id")


def accepted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most_char: float = MOST_CHAR, most_word: float = MOST_WORD) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. They are written with their figures, so that
    the verdict doesn't read texts again."""
    return _judged(docs, F.struct("*"), text_col, lang_col, most_char, most_word, True).where("kept").select("carried.*")
