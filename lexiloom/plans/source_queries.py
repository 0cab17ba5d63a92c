"""Queries of sources and sinks: tables go through a sink into the shared folder and come back by a source.

What is landed stays until the application ends."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.operators import evaluate as ev
from lexiloom.operators import terms as te
from lexiloom.plans.inputs import BASKET, SENT, TERMS, baskets, page_sentences, part_terms, table, token_frequency
from lexiloom.session import workplace
from lexiloom.sources import readers as rd
from lexiloom.sources import writers as wr
from lexiloom.sources.keyed import KeyedTable


def _pick(values: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


# ---------------------------------------------------------------- listings
def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a listing's raw JSON, a page to a line: bodies in the format of their language, pages
    in Spanish cut so that they can't be read."""
    lang = lambda name, value: F.struct(F.when(F.col("lang") == name, value).alias("value"))
    body = F.struct(
        F.struct(F.when(F.col("lang") == "en", F.col("text")).when(F.col("lang") == "fr", "").alias("value")).alias("storage"),
        lang("de", F.col("text")).alias("atlas_doc_format"),
        F.struct(F.when(F.col("lang") == "fr", F.col("text")).otherwise("other").alias("value")).alias("view"),
    )
    day = F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z"))
    page = F.to_json(
        F.struct(
            F.col("doc_id").cast("string").alias("id"), F.col("source").alias("spaceId"), F.concat(F.lit("Page "), F.col("doc_id")).alias("title"),
            F.struct((F.col("doc_id") % 9 + 1).alias("number"), F.lit("no date").alias("createdAt")).alias("version"), day.alias("createdAt"), body.alias("body"),
            F.struct(F.when(F.col("lang") != "de", F.concat(F.lit("/x/"), F.col("doc_id"))).alias("webui")).alias("_links"),
        )
    )
    landed = f"{workplace(spark)}/listing"
    table(spark, sf_dir, "documents").select(F.when(F.col("lang") == "es", F.substr(page, F.lit(2))).otherwise(page)).write.text(landed)
    pages = rd.pages_from_json(spark.read.text(landed), base_url="https://wiki.example.com")
    return pages.withColumn("created_at", F.unix_seconds("created_at")).withColumn("updated_at", F.unix_seconds("updated_at")).withColumn("labels", F.size("labels"))


RAW_PAGES = """SELECT CASE WHEN ok THEN doc_id::VARCHAR END AS page_id, CASE WHEN ok THEN source END AS space_id, CASE WHEN ok THEN 'Page ' || doc_id ELSE '' END AS title,
CASE WHEN NOT ok THEN '' WHEN text = '' THEN CASE lang WHEN 'fr' THEN '' ELSE 'other' END ELSE text END AS body, CASE WHEN ok THEN doc_id % 9 + 1 END AS version,
CASE WHEN ok THEN 1704067200 + (doc_id % 28) * 86400 END AS created_at, NULL::BIGINT AS updated_at, 0 AS labels,
CASE WHEN ok AND lang <> 'de' THEN 'https://wiki.example.com/x/' || doc_id END AS url, CASE WHEN NOT ok THEN 'unreadable page' END AS error FROM (SELECT *, lang <> 'es' AS ok FROM documents)"""


def customer_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Space keys with their ids; keys of one region aren't known."""
    keys = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("N"), F.col("c_nationkey")).alias("space_key"))
    known = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.concat(F.lit("N"), F.col("n_nationkey")).alias("space_key"), F.col("n_name").alias("space_id"))
    return rd.spaces(keys, known)


CUSTOMER_SPACES = "SELECT c_custkey, 'N' || c_nationkey AS space_key, n_name AS space_id FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2"


def pages_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed pages whose long bodies come from single pages (none in German), with the labels of those that have any."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), "lang", "n_chars", "text")
    listed = docs.select("page_id", F.when(F.col("n_chars") <= 500, F.col("text")).otherwise("").alias("body"))
    single = docs.where("lang <> 'de'").select("page_id", F.col("text").alias("body"))
    names = F.array_compact(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic")))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), names.alias("labels"))
    return rd.with_details(listed, single, labels).select("page_id", "body", F.array_join("labels", ",").alias("labels"))


PAGES_COMPLETED = """SELECT d.doc_id AS page_id, CASE WHEN n_chars > 500 AND lang = 'de' THEN '' ELSE text END AS body,
concat_ws(',', CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END) AS labels FROM documents d LEFT JOIN labels USING (doc_id)"""


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of labelled bad documents as messages of an error log, cut to its length."""
    bad = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id", F.lit(True).alias("bad"))
    rows = table(spark, sf_dir, "documents").join(bad, "doc_id", "left").withColumn("error", F.when(F.col("bad"), F.col("text")))
    path = f"{workplace(spark)}/errors"
    wr.write_table(wr.errors(rows, "doc_id"), path)
    return spark.read.parquet(path)


ERROR_LOG = "SELECT doc_id::VARCHAR AS key, substr(text, 1, 2000) AS message FROM documents JOIN labels USING (doc_id) WHERE quality = 0"


# ---------------------------------------------------------------- text files
def corpus_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents written as a training corpus and read again; how often each is there."""
    path = f"{workplace(spark)}/corpus"
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    wr.write_corpus(lines.select(F.filter(F.split("line", r"\s+"), lambda x: x != "").alias("tokens")), path)
    return rd.read_corpus(spark, path).groupBy(F.array_join("tokens", " ").alias("line")).agg(F.count(F.lit(1)).alias("n"))


CORPUS_FILE = r"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
t AS (SELECT list_filter(string_split_regex(line, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM l)
SELECT array_to_string(ws, ' ') AS line, count(*) AS n FROM t WHERE len(ws) > 0 GROUP BY 1"""


def listed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with their brands as comments, appended twice to a list: its words, and the lines of each."""
    path = f"{workplace(spark)}/list"
    parts = table(spark, sf_dir, "part").select("p_size", F.concat("p_name", F.lit("  # "), "p_brand").alias("value"))
    for lines in (parts.where("p_size <= 25"), parts):  # the second has all of the first again
        wr.append_new(lines, spark, path)
    lines = spark.read.text(path).groupBy(F.btrim(F.split_part("value", F.lit("#"), F.lit(1))).alias("word")).agg(F.count(F.lit(1)).alias("lines"))
    return rd.read_list(spark, path).select("word").join(lines, "word")


LISTED_WORDS = "SELECT p_name AS word, count(DISTINCT p_brand) AS lines FROM part GROUP BY 1"


def excluded_pairs_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both words of part names as a list of excluded pairs, in the order that they have."""
    path = f"{workplace(spark)}/excluded"
    words = [F.split_part("p_name", F.lit(" "), F.lit(k)) for k in (2, 1)]
    table(spark, sf_dir, "part").select(F.concat_ws(" || ", *words)).write.text(path)
    return rd.read_excluded_pairs(spark, path)


EXCLUDED_PAIRS_FILE = """SELECT DISTINCT least(a, b) || '||' || greatest(a, b) AS pair_key
FROM (SELECT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)"""


def proposals_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals of a model in files of a thousand pairs, objects and bare lists in turn, that have allowed terms only."""
    path = f"{workplace(spark)}/proposals"
    pair = F.struct(
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("termAKey"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("termBKey"),
        _pick(("same", "BROADER", "narrower", "OTHER"), F.col("p_partkey")).alias("relationHint"), _pick(("HIGH", "medium", "LOW"), F.col("p_size")).alias("confidence"), F.lit("seen").alias("reason"),
    )
    files = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 1000).alias("file")).agg(F.collect_list(pair).alias("pairs"))
    text = F.when(F.col("file") % 2 == 0, F.to_json(F.struct("pairs"))).otherwise(F.to_json("pairs"))
    files.select("file", text.alias("value")).write.partitionBy("file").text(path)
    return rd.read_proposals(spark, path, part_terms(spark, sf_dir).where(F.length("term") > 4))


PROPOSALS_FILE = f"""WITH {TERMS}, p AS (SELECT split_part(p_name, ' ', 1) AS x, split_part(p_name, ' ', 2) AS y,
([1.0, 0.7, 0.7, 0.5]::DOUBLE[])[p_partkey % 4 + 1] * ([1.0, 0.7, 0.4]::DOUBLE[])[p_size % 3 + 1] AS s FROM part)
SELECT least(x, y) AS a, greatest(x, y) AS b, max(round(s, 4)) AS score FROM p WHERE x <> y AND x IN (SELECT term FROM terms WHERE length(term) > 4)
AND y IN (SELECT term FROM terms WHERE length(term) > 4) GROUP BY 1, 2"""


def user_dictionary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as the next round's user dictionary; how often each entry is there."""
    path = f"{workplace(spark)}/dictionary"
    wr.write_user_dictionary(table(spark, sf_dir, "part").select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("phrase")), path)
    return rd.read_user_dictionary(spark, path).groupBy("surface", "tag").agg(F.count(F.lit(1)).alias("n"))


USER_DICTIONARY_FILE = "SELECT p_name AS surface, 'NNP' AS tag, count(*) AS n FROM part GROUP BY 1"


# ---------------------------------------------------------------- sheets
def removal_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose row of a review sheet is marked for removal."""
    path = f"{workplace(spark)}/sheet"
    marks = ("x", "", " V ", "no", "제거", "TRUE", "?", "1", "keep")
    wr.write_sheet(table(spark, sf_dir, "customer").select("c_custkey", "c_name", _pick(marks, F.col("c_custkey")).alias("remove")), path, "errorifexists")
    return rd.read_marked(spark, path, "remove").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name")


REMOVAL_SHEET = "SELECT c_custkey, c_name FROM customer WHERE [true, false, true, false, true, true, false, true, false][c_custkey % 9 + 1]"


def label_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments as labels of a gold sheet, written in several ways; those without one are left out."""
    path = f"{workplace(spark)}/gold"
    label = F.when(F.col("c_nationkey") % 3 == 1, F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))).when(F.col("c_nationkey") % 3 == 2, F.col("c_mktsegment")).otherwise("")
    wr.write_sheet(table(spark, sf_dir, "customer").select("c_custkey", label.alias("label")), path)
    return rd.read_labels(spark, path).select(F.col("c_custkey").cast("long").alias("c_custkey"), "label")


LABEL_SHEET = "SELECT c_custkey, upper(c_mktsegment) AS label FROM customer WHERE c_nationkey % 3 <> 0"


def ground_truth_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with the pages that their documents were published as, as JSON; those in Spanish weren't."""
    path = f"{workplace(spark)}/truth"
    published = table(spark, sf_dir, "documents").where("lang <> 'es'").select(F.col("doc_id").alias("id"), F.concat(F.lit("p"), F.col("doc_id")).alias("page_id"))
    truth = ev.ground_truth(table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id"), published)
    truth.write.json(path)
    return spark.read.schema(truth.schema).json(path)


GROUND_TRUTH_FILE = "SELECT l.doc_id AS id, quality, toxic, CASE WHEN d.doc_id IS NOT NULL THEN 'p' || d.doc_id END AS page_id FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id AND lang <> 'es'"


# ---------------------------------------------------------------- tables
def corpus_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a corpus of modules by language; those in English have sources."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "source", "n_chars")
    others = docs.drop("source")
    return ev.registry([docs.where("lang = 'en'"), *[others.where(F.col("lang") == k) for k in ("de", "es", "fr")]])


CORPUS_REGISTRY = "SELECT doc_id AS id, lang, CASE lang WHEN 'en' THEN source END AS source, n_chars FROM documents WHERE lang IN ('en', 'de', 'es', 'fr')"


def evolved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of orders that gets rows with a column more, and without one of its own."""
    orders = table(spark, sf_dir, "orders")
    held = orders.where("o_orderstatus <> 'O'").select("o_orderkey", "o_custkey", "o_orderpriority")
    new = orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = f"{workplace(spark)}/evolved"
    wr.write_table(wr.evolve(held, new), path)
    return spark.read.parquet(path)


EVOLVED_ROWS = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority,
CASE WHEN o_orderstatus = 'O' THEN o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL"""


def saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies of tokens as a stored model, clustered by term."""
    path = f"{workplace(spark)}/model"
    wr.write_table(token_frequency(baskets(spark, sf_dir)), path, cluster=["term"])
    return rd.read_model(spark, path)


SAVED_MODEL = f"WITH {BASKET} SELECT token AS term, count(*) AS n FROM line GROUP BY 1"


def keyed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table of customers: building ones get new rows, customers of orders that it lacks are added."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    held = KeyedTable(spark, f"{workplace(spark)}/customers", ["c_custkey"], buckets=16)
    held.put(customers.where("c_mktsegment <> 'HOUSEHOLD'"))
    held.put(customers.where("c_mktsegment = 'BUILDING'").withColumn("c_name", F.lower("c_name")).withColumn("state", F.lit("new")))
    held.add(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("state", F.lit("added")))
    return held.read().select("c_custkey", "c_name", "c_mktsegment", "state")


KEYED_CUSTOMERS = """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN lower(c_name) ELSE c_name END AS c_name, c_mktsegment, CASE c_mktsegment WHEN 'BUILDING' THEN 'new' END AS state
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT DISTINCT o_custkey, NULL, NULL, 'added' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')"""


# ---------------------------------------------------------------- an analyser's tokens
def _by_shape(sentences: list[str]) -> list[list[tuple[str, str]]]:
    """Tags by a word's shape. Sentences with a run of symbols can't be told."""
    if any("%%%" in s for s in sentences):
        raise ValueError("symbols")
    tag = lambda w: "NNP" if re.match("[A-Z]", w) else "SN" if re.match("[0-9]", w) else "VV" if w.endswith("e") else "NNG"
    return [[(w, tag(w)) for w in s.split(" ")] for s in sentences]


def analysed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens that are kept of an analyser's, by sentence, and whether it failed there."""
    rows = te.tagged(page_sentences(spark, sf_dir), _by_shape)
    kept = te.kept_tokens(F.col("tagged"), tags=("NNG", "NNP", "VV"), stopwords=("the", "der"), min_stem=3)
    return rows.select("page_id", F.col("sentence_index").cast("int"), F.array_join(kept, " ").alias("tokens"), F.col("tag_error").isNotNull().alias("failed"))


ANALYSED_TOKENS = rf"""WITH {SENT}, w AS (SELECT doc_id, idx, contains(s, '%%%') AS failed, string_split(s, ' ') AS ws FROM sent)
SELECT doc_id AS page_id, idx::INT AS sentence_index, failed, CASE WHEN failed THEN '' ELSE array_to_string(list_filter(ws, lambda x: NOT regexp_matches(x, '^[0-9]')
AND x NOT IN ('', 'the', 'der') AND (length(x) >= 3 OR regexp_matches(x, '^[A-Z]') OR NOT ends_with(x, 'e'))), ' ') END AS tokens FROM w"""
