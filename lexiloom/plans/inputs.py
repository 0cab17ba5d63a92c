"""The driver's tables in the roles that the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.operators import terms as te
from lexiloom.session import spread, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of texts, whose transformations take time: over all cores."""
    return spread(table(spark, sf_dir, name))


def page_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of documents without guards and length limit (what both regex dialects share)."""
    docs = texts(spark, sf_dir).select("doc_id", "text")
    return te.sentences(docs, "doc_id", None, "text", max_length=1 << 30, guards=())


def page_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.tokenized(page_sentences(spark, sf_dir))


def stored_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_tokens, written: for queries that go through them several times."""
    return written(spark)(page_tokens(spark, sf_dir).select("page_id", "sentence_index", "tokens"), "tokens")


def part_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names and their initials as a small catalogue: (term, frequency)."""
    names = table(spark, sf_dir, "part").groupBy(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("term")).agg(F.count(F.lit(1)).alias("frequency"))
    initials = F.upper(F.concat(F.left("term", F.lit(1)), F.left(F.split_part("term", F.lit("_"), F.lit(2)), F.lit(1))))
    words = names.select(F.explode(F.split("term", "_")).alias("term"), "frequency")
    return names.union(names.select(initials.alias("term"), "frequency")).union(words).groupBy("term").agg(F.sum("frequency").alias("frequency"))


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as token sentences: (page_id, tokens), tokens being part names in line order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("token"))
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("page_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "token"))).alias("t"))
    return rows.select("page_id", F.transform("t", lambda x: x["token"]).alias("tokens"))


def token_frequency(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


#: DuckDB: sentences (sent: doc_id, idx, s) and tokens (tok: doc_id, idx, s, pos, term) of documents.
SENT = r"""
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents
), marked AS (
  SELECT doc_id, ln, string_split(regexp_replace(line, '([.!?…])(\s)', '\1' || chr(1) || '\2', 'g'), chr(1)) AS ps FROM lines
), pieces AS (
  SELECT doc_id, ln, unnest(ps) AS p, generate_subscripts(ps, 1) AS pn FROM marked
), tidy AS (
  SELECT doc_id, ln, pn, trim(regexp_replace(p, '\s+', ' ', 'g')) AS s FROM pieces
), sent AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ln, pn) - 1 AS idx, s FROM tidy WHERE length(s) >= 4 AND regexp_matches(s, '[0-9A-Za-z가-힣]')
)"""
TOK = (
    SENT
    + r""", bare AS (
  SELECT doc_id, idx, s, list_filter(list_transform(string_split(s, ' '), lambda x: trim(x, '.,!?()[]{}"''·')), lambda x: x <> '') AS words FROM sent
), tok AS (
  SELECT doc_id, idx, s, unnest(words) AS term, generate_subscripts(words, 1) AS pos FROM bare
)"""
)
TERMS = r"""
names AS (SELECT replace(p_name, ' ', '_') AS term, count(*) AS frequency FROM part GROUP BY 1),
terms AS (
  SELECT term, sum(frequency)::BIGINT AS frequency FROM (
    SELECT * FROM names
    UNION ALL SELECT upper(term[1] || split_part(term, '_', 2)[1]), frequency FROM names
    UNION ALL SELECT unnest(string_split(term, '_')), frequency FROM names) GROUP BY 1
)"""
BASKET = r"""
line AS (
  SELECT l_orderkey AS page_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos, replace(p_name, ' ', '_') AS token
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""
LIKE_SENTENCE = r"(length(trim({0})) >= 12 AND regexp_matches(trim({0}), '[.!?…]$|(다|요|음|임|까|죠|함|됨)[.!?]?$'))"
