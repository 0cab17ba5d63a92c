"""Sources. HTTP is out of the engine: raw page JSON, lists and answers are read where they have landed."""

from __future__ import annotations

import hashlib
import os
import random
import re
import time
from collections.abc import Callable, Iterator
from typing import Any
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lexiloom.functions import policy as po

PAGE = "page_id string, space_id string, title string, body string, version long, created_at timestamp, updated_at timestamp, labels array<string>, url string"
RAW_PAGE = "id string, spaceId string, title string, version struct<number:bigint,createdAt:string>, createdAt string, body struct<storage:struct<value:string>,atlas_doc_format:struct<value:string>,view:struct<value:string>>, _links struct<webui:string>"


def pages_from_json(raw: DataFrame, column: str = "value", base_url: str = "", body_format: str = "storage") -> DataFrame:
    """PAGE rows of raw page JSON. The body is the first of the formats that isn't empty; a row that
    can't be read has an error and no page."""
    j = F.from_json(F.col(column), RAW_PAGE)
    bodies = [F.nullif(F.col(f"j.body.{f}.value"), F.lit("")) for f in dict.fromkeys((body_format, "storage", "atlas_doc_format", "view"))]
    link = F.col("j._links.webui")
    rows = raw.select(j.alias("j"))
    return rows.select(
        F.col("j.id").alias("page_id"), F.col("j.spaceId").alias("space_id"), F.coalesce("j.title", F.lit("")).alias("title"), F.coalesce(*bodies, F.lit("")).alias("body"), F.col("j.version.number").alias("version"),
        F.try_to_timestamp("j.createdAt").alias("created_at"), F.try_to_timestamp("j.version.createdAt").alias("updated_at"), F.array().cast("array<string>").alias("labels"), F.when(link.isNotNull(), F.concat(F.lit(base_url), link)).alias("url"),
        F.when(F.col("j.id").isNull() | F.col("j.version").isNull(), F.lit("unreadable page")).alias("error"),
    )


def url_parameter(url: Column, name: str) -> Column:
    """A query parameter of a URL, as for paging cursors; null if it isn't there."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def spaces(keys: DataFrame, known: DataFrame) -> DataFrame:
    """Numeric ids of space keys; unknown keys are left out. ``known`` (space_key, space_id)."""
    return keys.join(known, "space_key")


def with_details(pages: DataFrame, details: DataFrame, labels: DataFrame) -> DataFrame:
    """Bodies that the listing lacks come from single pages; labels from theirs, none where they failed."""
    out = pages.join(details.select("page_id", F.col("body").alias("__b")), "page_id", "left").join(labels.select("page_id", F.col("labels").alias("__l")), "page_id", "left")
    return out.withColumn("body", F.coalesce(F.nullif("body", F.lit("")), "__b", F.lit(""))).withColumn("labels", F.coalesce("__l", F.array().cast("array<string>"))).drop("__b", "__l")


class PagedSource(DataSource):
    """spark.read.format("paged"): a paged listing behind a ``fetch(space, cursor)`` function.

    Options: fetch, as module:function that gives (rows, next cursor or None), and spaces, separated by
    commas. A space is a partition; task retry is Spark's.

    As a stream (spark.readStream), a batch has ``pages`` pages of each space at most (100 by default), and the offsets,
    which the checkpoint keeps, are cursors: a listing goes on where the last run ended. Option peek: as fetch, but
    only its cursor counts (by default fetch itself, whose rows are then dropped). At the end of a
    listing the last page's cursor is kept; when that page has a next one, or other rows than before, a later
    run reads it again and goes on, so rows of that page may come twice."""

    #: Functions in place of the options' names, see ``over``.
    functions: dict[str, Callable] = {}

    @classmethod
    def over(cls, fetch: Callable, peek: Callable | None = None) -> type[PagedSource]:
        """The source with its functions, which then need no module that all of Spark's processes can import."""

        class Over(cls):
            functions = {"fetch": fetch} | ({"peek": peek} if peek else {})

        return Over

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "space string, value string"

    def reader(self, schema: Any) -> DataSourceReader:
        return _PagedReader(dict(self.options) | self.functions)

    def streamReader(self, schema: Any) -> DataSourceStreamReader:
        return _PagedStream(dict(self.options) | self.functions)


def loaded(name: str | Callable) -> Callable:
    """The function module:name, or a function itself."""
    import importlib

    if callable(name):
        return name
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class _Stretch(InputPartition):
    """Pages of a space from a cursor on, so many."""

    def __init__(self, space: str, cursor: str | None, pages: int):
        self.space, self.cursor, self.pages = space, cursor, pages


class _PagedStream(DataSourceStreamReader):
    """Offsets: for each space [cursor of the next page, the pages read in all, a mark of the last page at the end]."""

    def __init__(self, options: dict):
        self.options, self.at = options, None

    def initialOffset(self) -> dict:
        return {s: [None, 0, ""] for s in dict.fromkeys(self.options["spaces"].split(",")) if s}

    def latestOffset(self) -> dict:
        at = self.at or self.initialOffset()
        self.at = {s: self._later(s, *at.get(s, [None, 0, ""])) for s in self.initialOffset()}
        return self.at

    def _later(self, space: str, cursor: str | None, read: int, end: str) -> list:
        peek, mark = loaded(self.options.get("peek", self.options["fetch"])), ""
        for _ in range(int(self.options.get("pages", "100"))):
            rows, following = retried(peek, space, cursor)
            if following is None:
                mark = hashlib.sha256(repr(rows).encode()).hexdigest()[:16]
                return [cursor, read + (mark != end), mark]
            cursor, read = following, read + 1
        return [cursor, read, ""]

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = self.at or end
        each = ((s, start.get(s, [None, 0, ""]), end[s]) for s in end)
        return [_Stretch(s, a[0], b[1] - a[1]) for s, a, b in each if b[1] > a[1]]

    def read(self, partition: _Stretch) -> Iterator[tuple]:
        fetch, cursor = loaded(self.options["fetch"]), partition.cursor
        for _ in range(partition.pages):
            rows, cursor = retried(fetch, partition.space, cursor)
            for r in rows:
                yield (partition.space, r)
            if cursor is None:
                return

    def commit(self, end: dict) -> None:
        """Offsets are the checkpoint's."""


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(s) for s in dict.fromkeys(self.options["spaces"].split(",")) if s]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fetch, cursor = loaded(self.options["fetch"]), None
        while True:
            rows, cursor = retried(fetch, partition.value, cursor)
            for r in rows:
                yield (partition.value, r)
            if cursor is None:
                return


class NotAllowed(Exception):
    """A listing that no further try will give: refused, or not there."""


def retried(fetch: Callable, space: str, cursor: str | None, tries: int = 4, first: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """A page of a listing. NotAllowed is raised at once; other failures are tried again, after the
    seconds that the failure asks for (retry_after) or a doubling wait with up to a quarter more."""
    for k in range(tries):
        try:
            return fetch(space, cursor)
        except NotAllowed:
            raise
        except Exception as e:
            if k == tries - 1:
                raise
            asked = getattr(e, "retry_after", None)
            sleep(float(asked) if asked is not None else first * 2**k * (1 + random.random() / 4))
    raise ValueError("tries: one at least")


def by_offset(get: Callable[[str, int, int], list], limit: int = 50) -> Callable:
    """A ``fetch`` for listings by start and limit: the cursor is where the next page starts."""

    def fetch(space: str, cursor: str | None) -> tuple[list, str | None]:
        start = int(cursor or 0)
        rows = get(space, start, limit)
        return rows, str(start + len(rows)) if len(rows) == limit else None

    return fetch


def by_link(get: Callable[[str, str | None], tuple[list, str | None]]) -> Callable:
    """A ``fetch`` for listings that give the next page's address: its cursor parameter goes on."""

    def fetch(space: str, cursor: str | None) -> tuple[list, str | None]:
        rows, link = get(space, cursor)
        return rows, (parse_qs(urlsplit(link or "").query).get("cursor") or [None])[0]

    return fetch


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Token sentences of a text file, a sentence to a line."""
    return spark.read.text(path).select(F.filter(F.split("value", r"\s+"), lambda x: x != "").alias("tokens")).where(F.size("tokens") > 0)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a list file without comments (#) and repeats, in the file's order (at)."""
    word = F.btrim(F.split_part("value", F.lit("#"), F.lit(1)))
    rows = spark.read.text(path).select(word.alias("word"), F.monotonically_increasing_id().alias("at")).where("word <> ''")
    return rows.groupBy("word").agg(F.min("at").alias("at")).orderBy("at")


def read_excluded_pairs(spark: SparkSession, path: str) -> DataFrame:
    parts = F.transform(F.split("word", r"\|\|"), lambda x: F.btrim(x))
    return read_list(spark, path).where(F.size(parts) == 2).select(F.array_join(F.array_sort(parts), "||").alias("pair_key")).distinct()


def read_proposals(spark: SparkSession, path: str, allowed: DataFrame) -> DataFrame:
    """(a, b, score) of proposed pairs (an object with pairs, or a bare list) of allowed terms."""
    pair = "termAKey string, termBKey string, relationHint string, confidence string, reason string"
    text = spark.read.text(path, wholetext=True)
    both = F.coalesce(F.from_json("value", f"pairs array<struct<{pair.replace(' ', ':').replace(',:', ',')}>>")["pairs"], F.from_json("value", f"array<struct<{pair.replace(' ', ':').replace(',:', ',')}>>"))
    rows = text.select(F.explode(both).alias("p")).select(F.least("p.termAKey", "p.termBKey").alias("a"), F.greatest("p.termAKey", "p.termBKey").alias("b"), po.proposal_score(F.upper("p.relationHint"), F.upper("p.confidence")).alias("score")).where("a <> b")
    for side in ("a", "b"):
        rows = rows.join(allowed.select(F.col("term").alias(side)), side, "left_semi")
    return rows.groupBy("a", "b").agg(F.max("score").alias("score"))


def read_marked(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """Rows of a sheet whose mark cell asks for removal."""
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    return rows.where(po.is_removal_mark(F.col(mark)))


def read_labels(spark: SparkSession, path: str, label: str = "label") -> DataFrame:
    rows = spark.read.option("header", True).csv(path)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    return rows.withColumn(label, F.upper(F.btrim(label))).where(F.col(label) != "")


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """(file, answer) of answer files; later files count more (latest_answers by file)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("answer"))


def read_user_dictionary(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("sep", "\t").schema("surface string, tag string").csv(path)
    return rows.where("surface is not null and surface <> ''").withColumn("tag", F.coalesce("tag", F.lit("NNP")))


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """A phrase or vector table."""
    return spark.read.parquet(path)


def expand_variables(text: str, environment: dict[str, str] | None = None) -> str:
    """${NAME} and ${NAME:-default}; an unset name without default is empty."""
    env = os.environ if environment is None else environment
    return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", lambda m: env.get(m[1]) or m[2] or "", text)


def read_env(lines: list[str]) -> dict[str, str]:
    """NAME=value lines, comments and blank lines aside."""
    pairs = (x.strip().partition("=") for x in lines if "=" in x and not x.strip().startswith("#"))
    return {k.strip(): v.strip().strip("\"'") for k, _, v in pairs}


class Section:
    """A nested configuration: section.get("a.b", default)."""

    def __init__(self, values: dict | None):
        self.values = values or {}

    def get(self, path: str, default: Any = None) -> Any:
        node: Any = self.values
        for part in path.split("."):
            if not isinstance(node, dict) or part not in node:
                return default
            node = node[part]
        return default if node is None else node


def load_settings(text: str, environment: dict[str, str] | None = None) -> Section:
    """Settings of a JSON or YAML text (YAML needs its library)."""
    import json

    text = expand_variables(text, environment)
    try:
        return Section(json.loads(text))
    except ValueError:
        import yaml

        return Section(yaml.safe_load(text))
