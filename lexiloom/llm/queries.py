"""Queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm.bpe import decode, encode
from lexiloom.llm.collocations import collocations
from lexiloom.llm.exact_dedup import exact_dedup
from lexiloom.llm.fim import fill_in_middle, restored
from lexiloom.llm.language_id import language_id
from lexiloom.llm.line_dedup import line_dedup
from lexiloom.llm.packing import pack_documents
from lexiloom.llm.pii import KINDS, find_spans
from lexiloom.llm.pretok import vocab_path
from lexiloom.llm.quality import quality
from lexiloom.llm.simhash import near_dedup
from lexiloom.llm.store import small_batches
from lexiloom.llm.token_counts import token_count
from lexiloom.llm.token_store import crc_of, read_tokens, token_file
from lexiloom.llm.topk import top_k
from lexiloom.session import spread

#: Tokens that a document may have before it is said to be over the limit.
TOKEN_LIMIT = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("__lines.n_lines").alias("n_lines"), F.col("__lines.n_dropped").alias("n_dropped"), F.sha2(F.col("__lines.text"), 256).alias("kept_sha256"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_file(documents(spark, sf_dir), vocab_path(), end_id=2)
    return read_tokens(spark, path, crc_of, "long").withColumnRenamed("made", "ids_crc32")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = documents(spark, sf_dir).select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), token_count(F.col("text"), vocab_path()).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_id(spread(spark.read.parquet(f"{sf_dir}/pages.parquet")), documents(spark, sf_dir))
    return out.withColumnRenamed("id", "page_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = documents(spark, sf_dir).select("doc_id", find_spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda s: s["base"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.filter(base, lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = vocab_path()
    out = documents(spark, sf_dir).select("doc_id", encode(F.col("text"), path).alias("ids"))
    out = out.select("doc_id", "ids", decode(F.col("ids"), path).alias("decoded"))
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), vocab_path(), end_id=0, capacity=2048)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spread(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), k=10, every=100)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir), most=4, least=30, share=80, top=2000)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"), seed=7, rate=100, spm_rate=50).select("doc_id", "__fim.*")
    told = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *told)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)} | {"pipeline": corpus_pipeline.run}


OP1_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), common AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.pos, k.line, (c.key IS NOT NULL AND k.doc_id <> c.last) AS go FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE go) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT go), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP10_SQL = r"""
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), grouped AS (
  SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY text
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.text) AS text_sha256
FROM normal n JOIN grouped g ON n.text = g.text
"""


OP11_SQL = r"""
WITH whole AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS score
  FROM whole q JOIN whole c ON q.place <> c.place WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id ASC NULLS FIRST) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k))
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), total AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), frequent AS (
  SELECT * FROM f WHERE f >= 30
), cuts AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM frequent WHERE k > 1
), scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * c.a // (l.f::HUGEINT + r.f) AS BIGINT) AS score, c.cut
  FROM cuts c JOIN frequent l ON c.lang = l.lang AND array_to_string(c.w[1 : c.cut], ' ') = l.phrase
  JOIN frequent r ON c.lang = r.lang AND array_to_string(c.w[c.cut + 1 :], ' ') = r.phrase
), candidates AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, a AS longer, array_to_string(w[i : i + m - 1], ' ') AS phrase FROM (
    SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM (
      SELECT lang, a, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM candidates WHERE k > 2))
), held AS (
  SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY lang, phrase
), ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, encode(c.phrase)) AS rank
  FROM candidates c LEFT JOIN held h ON c.lang = h.lang AND c.phrase = h.phrase
  WHERE h.longer IS NULL OR 100::HUGEINT * h.longer < 80::HUGEINT * c.a
)
SELECT r.lang, CAST(r.rank AS INTEGER) AS rank, r.phrase, r.a, r.l, r.r, CAST(t.n AS BIGINT) AS n, r.score
FROM ranked r JOIN total t ON r.lang = t.lang WHERE r.rank <= 2000
"""

OP13_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units FROM documents
), numbers AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM drawn
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high FROM numbers
), parts AS (
  SELECT doc_id, text, n, h4, array_to_string(units[1 : low], '') AS prefix, array_to_string(units[low + 1 : high], '') AS middle,
         array_to_string(units[high + 1 :], '') AS suffix, text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 AS plain
  FROM cut
), formed AS (
  SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM parts
)
SELECT doc_id, n, form, CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars, CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op10_exact_dedup": OP10_SQL, "op11_exact_top_k": OP11_SQL, "op12_collocations": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
