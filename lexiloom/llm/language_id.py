"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence are combined by log-odds. Text: naive Bayes over hashed
letter trigrams, counted by language over all labelled documents. Declared: the
markup's lang attribute. Address: the country suffix of the host, and a language
code as the path's first part. How far these can be trusted is counted: each gives
P(value | language), by grouped sums of the pages' text posteriors. Host: a prior
that is smoothed from all pages to the domain to the host, from the same sums, without
the page's own share. Posteriors are summed as whole millionths, so sums don't depend
on their order.

Cases: a page without text has even text evidence; a null or odd address has no host
and takes the prior of all pages; undeclared is a value like any other; a null html or
url is empty; bytes that aren't UTF-8 are U+FFFD; ids may be of any type; repeated rows
are pages of their own; ties go to the language that sorts first; a label's region
(pt-BR) is left out; languages with fewer than LEAST_DOCS labelled documents, or beyond
the LANGS most labelled ones, are never the answer; with no labelled documents every
lang is null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.store import Shelf, looked_up, small_batches, whole_text

#: Hashed trigrams; trigrams after which more text adds no more evidence; smoothing of
#: trigrams and of evidence values; weight of a parent's prior; labelled documents of a language, at least.
GRAMS, ENOUGH, SMOOTH, SHY, PARENT, LEAST_DOCS = 1 << 13, 60, 0.5, 2.0, 8.0, 20
#: Languages that are told apart, at most: those with most labelled documents.
LANGS = 256
UNIT = 1_000_000
#: A language's code, of which a region or script that follows is no part.
CODE = r"^\s*([a-z]{2,3})(?:[-_].*)?$"
#: An unclosed script or style goes to the end, as browsers have it; a head without an end tag stops where the body begins.
UNREAD = re.compile(r"<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)", re.I | re.S)
DROPPED = re.compile(r"<nav\b(?:(?!<nav\b).)*?</nav\s*>|<head\b.*?(?:</head\s*>|(?=<(?:body|main|article|section|header|div|p|h1|h2|ul|ol|table)\b))", re.I | re.S)
TAG = re.compile(r"<[^<>]*>")
DECLARED = re.compile(r"<html\b[^<>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.I)
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)
SEGMENT = re.compile(r"^[^/?#]*//[^/?#]*/([A-Za-z]{2})(?:[-_][A-Za-z]{2})?(?:[/?#]|$)")


def grams(text: str) -> np.ndarray:
    """Hashed trigrams of a text: letters lower-cased, all else one blank."""
    cp = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    letter = ((cp >= 97) & (cp <= 122)) | (cp >= 192)
    cp = np.where(letter, cp, 32)
    keep = np.ones(len(cp), bool)
    keep[1:] = letter[1:] | letter[:-1]
    cp = cp[keep].astype(np.uint64)
    if len(cp) < 3:
        return np.zeros(0, np.int64)
    h = (cp[:-2] * np.uint64(0x9E3779B1) ^ cp[1:-1] * np.uint64(0x85EBCA77) ^ cp[2:] * np.uint64(0xC2B2AE3D)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - 13)).astype(np.int64)


def page_text(html: str) -> str:
    return markup.unescape(TAG.sub(" ", DROPPED.sub(" ", UNREAD.sub(" ", html))))


def address(url: str) -> tuple[str, str, str, str]:
    """(host, domain, country suffix, language code in the path); "" where there is none."""
    host = m[1].lower().rstrip(".") if (m := HOST.match(url)) else ""
    parts = host.split(".")
    suffix = parts[-1] if len(parts) > 1 and re.fullmatch("[a-z]{2}", parts[-1]) else ""
    return host, ".".join(parts[-2:]), suffix, m[1].lower() if (m := SEGMENT.match(url)) else ""


def trigram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n, docs) summed over all documents; docs stands at gram -1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(GRAMS + 1, np.int64))
                own[:-1] += np.bincount(grams(text or ""), minlength=GRAMS)
                own[-1] += 1
            if len(sums) > 64:  # what a task holds is bounded, however many codes there are
                yield from rows(sums)
                sums.clear()
        yield from rows(sums)

    def rows(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(np.where(at == GRAMS, -1, at).astype(np.int32)), pa.array(own[at])], ["lang", "gram", "n"])

    code = F.regexp_extract(F.lower(F.col(lang_col).cast("string")), CODE, 1)
    known = docs.select(code.alias("lang"), whole_text(F.col(text_col)).alias("text")).where("lang <> ''")
    return known.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class TextModel:
    """Log-probabilities of hashed trigrams by language."""

    def __init__(self, rows: list[tuple[str, int, int]], least_docs: int = LEAST_DOCS):
        docs = {lang: n for lang, gram, n in rows if gram < 0}
        self.langs = sorted(x for x, n in docs.items() if n >= least_docs)
        counts = np.full((len(self.langs), GRAMS), SMOOTH)
        place = {x: i for i, x in enumerate(self.langs)}
        for lang, gram, n in rows:
            if gram >= 0 and lang in place:
                counts[place[lang], gram] += n
        self.log = np.log(counts / counts.sum(axis=1, keepdims=True)) if self.langs else counts

    def score(self, text: str, enough: int = ENOUGH) -> np.ndarray:
        """Log-likelihoods, scaled to ``enough`` trigrams at most: the text's trigrams depend on each other."""
        own = grams(text)
        if not len(own):
            return np.zeros(len(self.langs))
        return self.log[:, own].sum(axis=1) * min(1.0, enough / len(own))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _vector(name: str, n: int) -> list[Column]:
    return [F.sum(F.col(name)[i]).alias(f"{name}{i}") for i in range(n)]


def _summed(rows: DataFrame, keys: list[str], n: int, to: str) -> DataFrame:
    sums = rows.groupBy(*keys).agg(*_vector("share", n))
    return sums.select(*keys, F.array(*[f"share{i}" for i in range(n)]).alias(to))


def language_id(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, host, declared, text_lang, lang, confidence) of each row of ``pages``; ``docs`` has labelled texts."""
    spark = pages.sparkSession
    small_batches(spark)
    shelf = Shelf(spark, "language")
    counts = shelf.put(trigram_counts(docs, text_col, lang_col), "counts")
    often = counts.where((F.col("gram") < 0) & (F.col("n") >= LEAST_DOCS)).orderBy(F.desc("n"), "lang").limit(LANGS).select("lang")
    # GRAMS + 1 rows for each of LANGS languages, whatever the input
    model = TextModel([tuple(r) for r in counts.join(often, "lang", "left_semi").select("lang", "gram", "n").collect()])
    langs, n = model.langs, len(model.langs)
    if not n:
        return pages.select(F.col(id_col).alias("id"), *(F.lit(None).cast("string").alias(c) for c in ("host", "declared", "text_lang", "lang")), F.lit(None).cast("double").alias("confidence"))
    form = f"id {pages.schema[id_col].dataType.simpleString()}, host string, domain string, suffix string, segment string, declared string, text array<double>, share array<long>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for url, html in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                html = html or ""
                text = model.score(page_text(html))
                declared = m[1].lower() if (m := DECLARED.search(html)) else ""
                share = np.rint(softmax(text) * UNIT).astype(np.int64)
                rows.append((*address(url or ""), declared, text.tolist(), share.tolist()))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.string()] * 5 + [pa.list_(pa.float64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [x.split()[0] for x in form.split(", ")])

    told = shelf.put(pages.select(F.col(id_col).alias("id"), whole_text(F.col(url_col)).alias("url"), whole_text(F.col(html_col)).alias("html")).mapInArrow(read, form), "told")
    # values of evidence are codes of two or three letters, so these tables are small
    evidence = {}
    for kind in ("declared", "suffix", "segment"):
        sums = {r[0]: np.array(r[1], float) / UNIT for r in _summed(told, [kind], n, "sums").collect()}
        total = reduce(np.add, sums.values(), np.zeros(n))
        evidence[kind] = {v: np.log((s + SHY / len(sums)) / (total + SHY)) for v, s in sums.items()}
    every = reduce(np.add, ([np.array(r[0], float) / UNIT for r in _summed(told, [], n, "sums").collect() if r[0][0] is not None]), np.zeros(n))
    placed = told.where("host <> ''")
    hosts = placed.groupBy("host", "domain").agg(F.count(F.lit(1)).alias("pages"), *_vector("share", n))
    hosts = hosts.select("host", "domain", "pages", F.array(*[f"share{i}" for i in range(n)]).alias("of_host"))
    domains = _summed(hosts.withColumnRenamed("of_host", "share"), ["domain"], n, "of_domain")
    hosts = shelf.put(hosts.join(domains, "domain").select("host", "pages", "of_host", "of_domain"), "hosts")
    placed = looked_up(placed.drop("domain"), hosts, "host", "pages", told.count())
    joined = placed.unionByName(told.where("host = ''").drop("domain"), allowMissingColumns=True)
    joined = joined.select("id", "host", "suffix", "segment", "declared", "text", "share", "of_host", "of_domain")

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.to_pydict()
            text, own = np.array(d["text"], float).reshape(-1, n), np.array(d["share"], float).reshape(-1, n) / UNIT
            none = [0] * n
            host = np.array([x or none for x in d["of_host"]], float).reshape(-1, n) / UNIT
            domain = np.array([x or none for x in d["of_domain"]], float).reshape(-1, n) / UNIT
            in_host = np.array([x is not None for x in d["of_host"]], bool).reshape(-1, 1)
            top = np.maximum(every - own, 0) + 1 / n
            prior = top / top.sum(axis=1, keepdims=True)
            for level in (domain, host):
                level = np.maximum(level - own * in_host, 0)
                prior = (level + PARENT * prior) / (level.sum(axis=1, keepdims=True) + PARENT)
            total = text + np.log(prior)
            for kind, of in evidence.items():
                total = total + np.array([of[v] for v in d[kind]]).reshape(-1, n)
            p = softmax(total)
            best = p.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([h or None for h in d["host"]], pa.string()), pa.array([x or None for x in d["declared"]], pa.string()), pa.array([langs[i] for i in text.argmax(axis=1)], pa.string()), pa.array([langs[i] for i in best], pa.string()), pa.array(np.round(p[np.arange(len(p)), best], 4), pa.float64())], ["id", "host", "declared", "text_lang", "lang", "confidence"])

    return joined.mapInArrow(fuse, f"id {pages.schema[id_col].dataType.simpleString()}, host string, declared string, text_lang string, lang string, confidence double")
