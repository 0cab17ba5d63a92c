"""Queries of relations: sync, answers, decisions, dictionary, review, evaluation, corpus checks, runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import policy as po
from lexiloom.functions import text as tx
from lexiloom.operators import evaluate as ev
from lexiloom.operators import judgement as ju
from lexiloom.operators import sync as sy
from lexiloom.plans.inputs import TERMS, part_terms, table


# ---------------------------------------------------------------- sync
def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events as versions of a user's page: incoming are the last of all, cached the last of every other event."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("page_id"), "event_id", (F.col("event_id") % 5).alias("version"))
    newest = [F.desc("event_id")]
    return sy.latest(events, ["page_id"], newest).select("page_id", "version"), sy.latest(events.where("event_type <> 'error' and user_id % 3 <> 0"), ["page_id"], newest).select("page_id", "version")


def version_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sy.version_sync(*_versions(spark, sf_dir))


_SYNC = """WITH e AS (SELECT user_id AS page_id, event_id, event_id % 5 AS version, event_type FROM events),
i AS (SELECT page_id, max_by(version, event_id) AS version FROM e GROUP BY 1), c AS (SELECT page_id, max_by(version, event_id) AS version FROM e WHERE event_type <> 'error' AND page_id % 3 <> 0 GROUP BY 1),
s AS (SELECT i.page_id, i.version, CASE WHEN c.page_id IS NULL THEN 'created' WHEN i.version = c.version THEN 'unchanged' ELSE 'updated' END AS change FROM i LEFT JOIN c USING (page_id))"""
VERSION_SYNC = f"{_SYNC} SELECT * FROM s"


def sync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sy.sync_counts(version_sync(spark, sf_dir))


SYNC_COUNTS = f"""{_SYNC} SELECT count(*) AS seen, count(*) FILTER (WHERE change = 'created') AS created, count(*) FILTER (WHERE change = 'updated') AS updated, count(*) FILTER (WHERE change = 'unchanged') AS unchanged,
count(*) FILTER (WHERE change = 'failed') AS failed, count(*) FILTER (WHERE change IN ('created', 'updated')) AS changed FROM s"""


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sy.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], [F.desc("event_id")])


LATEST_VERSION = "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"


def content_hash_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", sy.content_hash(F.col("source"), F.col("text")).alias("hash"), "lang")
    stored = docs.where("doc_id % 4 <> 0").select("doc_id", F.when(F.col("lang") == "de", F.lit("0")).otherwise(F.col("hash")).alias("hash"))
    return sy.changed_content(docs, stored, "doc_id").drop("lang")


CONTENT_HASH_CHANGE = "SELECT doc_id, substr(sha256(source || ' ' || text), 1, 16) AS hash, CASE WHEN doc_id % 4 = 0 THEN 'new' WHEN lang = 'de' THEN 'changed' ELSE 'same' END AS state FROM documents"


def retain_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem").where("l_quantity >= 50 and l_returnflag = 'A'").select(F.col("l_partkey").alias("p_partkey"))
    return sy.retain_only(table(spark, sf_dir, "part"), keys, "p_partkey").select("p_partkey", "p_name")


RETAIN_ONLY = "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50 AND l_returnflag = 'A')"


def insert_new_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return sy.insert_new(lines.where("l_returnflag = 'N'").select("l_orderkey", "l_partkey"), lines.where("l_returnflag <> 'N'").select("l_orderkey", "l_partkey"), ["l_orderkey", "l_partkey"])


INSERT_NEW_CONTEXTS = "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem a WHERE l_returnflag <> 'N' AND NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'N' AND a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey)"


def term_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type of a brand is kept, its size is new."""
    part = table(spark, sf_dir, "part")
    old = part.where("p_size <= 30").groupBy("p_name").agg(F.min("p_type").alias("kind"), F.max("p_size").cast("long").alias("size"))
    new = part.where("p_size > 20").groupBy("p_name").agg(F.max("p_type").alias("kind"), F.sum("p_size").cast("long").alias("size"))
    return sy.upsert(old, new, ["p_name"], keep=["kind"])


TERM_UPSERT = """WITH o AS (SELECT p_name, min(p_type) AS kind, max(p_size)::BIGINT AS size FROM part WHERE p_size <= 30 GROUP BY 1), n AS (SELECT p_name, max(p_type) AS kind, sum(p_size)::BIGINT AS size FROM part WHERE p_size > 20 GROUP BY 1)
SELECT p_name, CASE WHEN o.p_name IS NOT NULL THEN o.kind ELSE n.kind END AS kind, coalesce(n.size, o.size) AS size FROM o FULL JOIN n USING (p_name)"""


def candidate_status_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    pending = orders.select("o_orderkey", F.lit("PENDING").alias("status"))
    done = orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "VALIDATED").when(F.col("o_custkey") % 2 == 0, "VALIDATION_FAILED").otherwise("SKIPPED").alias("status"))
    return sy.merge_status(pending, done, "o_orderkey")


CANDIDATE_STATUS_MERGE = "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'PENDING' WHEN o_orderstatus = 'F' THEN 'VALIDATED' WHEN o_custkey % 2 = 0 THEN 'VALIDATION_FAILED' ELSE 'SKIPPED' END AS status FROM orders"


# ---------------------------------------------------------------- answers
def llm_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "conversations").where("role = 'user'")
    return ju.batched(asked, 24, [F.col("conv_id"), F.col("turn")]).select("conv_id", "turn", "batch")


LLM_BATCHES = "SELECT conv_id, turn, ((row_number() OVER (ORDER BY conv_id, turn) - 1) // 24)::BIGINT AS batch FROM conversations WHERE role = 'user'"


def _asked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    talk = table(spark, sf_dir, "conversations")
    asked = talk.where("role = 'user'").select("conv_id", "turn", F.length("text").alias("asked"))
    return asked, talk.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.length("text").alias("answered"))


def answer_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, answers = _asked(spark, sf_dir)
    return asked.join(answers, ["conv_id", "turn"])


ANSWER_MATCH = "SELECT a.conv_id, a.turn, length(a.text)::INT AS asked, length(b.text)::INT AS answered FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn - 1 WHERE a.role = 'user' AND b.role = 'assistant'"


def answer_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, answers = _asked(spark, sf_dir)
    return asked.join(answers.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti")


ANSWER_MISSING = "SELECT conv_id, turn, length(text)::INT AS asked FROM conversations a WHERE role = 'user' AND NOT EXISTS (SELECT 1 FROM conversations b WHERE b.role = 'assistant' AND a.conv_id = b.conv_id AND a.turn = b.turn - 1)"


def extract_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Props, as an answer would wrap them."""
    kind = F.col("event_id") % 4
    text = F.when(kind == 0, F.col("props")).when(kind == 1, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(kind == 2, F.concat(F.lit("Here: "), "props", F.lit(" done"))).otherwise("none")
    return table(spark, sf_dir, "events").select("event_id", tx.dig(tx.extract_json(text), "k").alias("k"))


EXTRACT_JSON_PROPS = "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN json_extract_string(props, '$.k') END AS k FROM events"


def evidence_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    told = F.array(n, n % 40, n % 7, n % 40, F.lit(3).cast("long"))
    docs = table(spark, sf_dir, "documents").select("doc_id", told.alias("told"), F.sequence(F.lit(0).cast("long"), n % 20).alias("offered"))
    return docs.select("doc_id", F.array_join(ju.offered_only(F.col("told"), F.col("offered")).cast("array<string>"), ",").alias("evidence"))


EVIDENCE_FILTER = "SELECT doc_id, array_to_string(list_filter([doc_id, doc_id % 40, doc_id % 7, doc_id % 40, 3], lambda x: x <= doc_id % 20), ',') AS evidence FROM documents"


def classified_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity type stands with entities only."""
    rows = part_terms(spark, sf_dir).select("term", F.when(F.col("frequency") % 3 == 0, " entity ").when(F.col("frequency") % 3 == 1, "CONCEPT").otherwise("odd").alias("t"))
    kind = po.known(F.col("t"), ("ENTITY", "CONCEPT"), "UNKNOWN")
    return rows.select("term", kind.alias("term_type"), F.when(kind == "ENTITY", "SYSTEM").alias("entity_type"))


CLASSIFIED_TERMS = f"WITH {TERMS} SELECT term, CASE frequency % 3 WHEN 0 THEN 'ENTITY' WHEN 1 THEN 'CONCEPT' ELSE 'UNKNOWN' END AS term_type, CASE WHEN frequency % 3 = 0 THEN 'SYSTEM' END AS entity_type FROM terms"


# ---------------------------------------------------------------- decisions
def _pick(names: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (n % len(names) + 1).cast("int"))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as verdicts; types, confidence and directions follow from their keys."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", _pick(po.RELATION_TYPES, k).alias("relation_type"), _pick(po.CONFIDENCES, c).alias("confidence"), (k % 5 != 0).alias("safe_ab"), (c % 3 != 0).alias("safe_ba"), (k % 4).alias("patterns_a"), (c % 4).alias("patterns_b"), F.when(c % 3 == 0, "ENTITY").when(c % 3 == 1, "CONCEPT").otherwise("UNKNOWN").alias("term_type"),
        F.concat(F.lit("c"), c.cast("string")).alias("a"), F.concat(F.lit("n"), (k % 25).cast("string")).alias("b"), F.round(F.col("o_totalprice") / 1e6, 4).alias("similarity"),
    )


_TYPES = "['" + "', '".join(po.RELATION_TYPES) + "']"
_VERDICTS = f"""v AS (SELECT o_orderkey, ({_TYPES})[o_orderkey % {len(po.RELATION_TYPES)} + 1] AS relation_type, (['HIGH', 'MEDIUM', 'LOW'])[o_custkey % 3 + 1] AS confidence, o_orderkey % 5 <> 0 AS safe_ab, o_custkey % 3 <> 0 AS safe_ba,
o_orderkey % 4 AS patterns_a, o_custkey % 4 AS patterns_b, (['ENTITY', 'CONCEPT', 'UNKNOWN'])[o_custkey % 3 + 1] AS term_type, 'c' || o_custkey AS a, 'n' || (o_orderkey % 25) AS b, round(o_totalprice / 1e6, 4) AS similarity FROM orders),
d AS (SELECT *, CASE WHEN relation_type IN ('RELATED', 'ANTONYM', 'UNRELATED', 'UNKNOWN', 'BROADER') THEN false WHEN relation_type = 'NARROWER' THEN true ELSE safe_ab END AS ab,
CASE WHEN relation_type IN ('RELATED', 'ANTONYM', 'UNRELATED', 'UNKNOWN', 'NARROWER') THEN false WHEN relation_type = 'BROADER' THEN true ELSE safe_ba END AS ba,
CASE WHEN confidence = 'HIGH' AND relation_type IN ('SAME_ENTITY', 'EXACT_ALIAS', 'ALIAS', 'ABBREVIATION') AND least(patterns_a, patterns_b) < 2 THEN 'MEDIUM' ELSE confidence END AS guarded FROM v),
st AS (SELECT *, CASE WHEN relation_type IN ('UNRELATED', 'UNKNOWN') THEN 'REJECTED' WHEN relation_type NOT IN ('SAME_ENTITY', 'EXACT_ALIAS', 'ABBREVIATION') OR NOT (ab AND ba) THEN 'REVIEW' WHEN guarded = 'HIGH' THEN 'ACTIVE' WHEN guarded = 'MEDIUM' THEN 'REVIEW' ELSE 'REJECTED' END AS status FROM d),
ex AS (SELECT *, status = 'ACTIVE' AND CASE term_type WHEN 'ENTITY' THEN relation_type IN ('SAME_ENTITY', 'EXACT_ALIAS', 'ALIAS', 'ABBREVIATION') WHEN 'CONCEPT' THEN relation_type IN ('EXACT_ALIAS', 'SYNONYM', 'NEAR_SYNONYM', 'ABBREVIATION') ELSE false END AS expandable FROM st)"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _verdicts(spark, sf_dir)
    rows = rows.withColumn("safe", po.safe_directions(F.col("relation_type"), F.col("safe_ab"), F.col("safe_ba")))
    return rows.withColumn("confidence", po.guarded_confidence(F.col("relation_type"), F.col("confidence"), F.col("patterns_a"), F.col("patterns_b")))


def direction_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("o_orderkey", "safe.ab", "safe.ba")


DIRECTION_SANITIZE = f"WITH {_VERDICTS} SELECT o_orderkey, ab, ba FROM d"


def evidence_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("o_orderkey", "confidence")


EVIDENCE_GUARD = f"WITH {_VERDICTS} SELECT o_orderkey, guarded AS confidence FROM d"


def decide_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("o_orderkey", po.decide_status(F.col("relation_type"), F.col("confidence"), F.col("safe.ab") & F.col("safe.ba")).alias("status"))


DECIDE_STATUS = f"WITH {_VERDICTS} SELECT o_orderkey, status FROM st"


def decide_status_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With every type active and other statuses: what people decide stays theirs."""
    both = F.col("safe.ab") & F.col("safe.ba")
    status = po.decide_status(F.col("relation_type"), F.col("confidence"), both, active=po.RELATION_TYPES, need_both=False, related="REJECTED", by_confidence={"MEDIUM": "ACTIVE", "LOW": "REVIEW"})
    return _judged(spark, sf_dir).select("o_orderkey", status.alias("status"))


DECIDE_STATUS_WIDE = f"""WITH {_VERDICTS} SELECT o_orderkey, CASE WHEN relation_type IN ('UNRELATED', 'UNKNOWN', 'RELATED') THEN 'REJECTED' WHEN relation_type IN ('ANTONYM', 'BROADER', 'NARROWER') THEN 'REVIEW'
  WHEN guarded = 'LOW' THEN 'REVIEW' ELSE 'ACTIVE' END AS status FROM st"""


def replayed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as entries, with answers by id for some, by pair for others, and none for the rest."""
    orders = table(spark, sf_dir, "orders")
    entries = orders.select(F.col("o_orderkey").alias("pair_id"), F.col("o_custkey").alias("pair_key"))
    by_id = orders.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("pair_id"), F.col("o_orderpriority").alias("answer"))
    stored = orders.where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("pair_key"), F.col("o_orderstatus").alias("answer"), F.struct("o_orderdate", "o_orderkey").alias("seq"))
    return ju.replayed(entries, by_id, ju.latest_answers(stored, "pair_key", "seq"))


REPLAYED_ANSWERS = """WITH k AS (SELECT o_custkey AS pair_key, max_by(o_orderstatus, row(o_orderdate, o_orderkey)) AS answer FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1)
SELECT o_orderkey AS pair_id, o_custkey AS pair_key, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END, k.answer) AS answer, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END, k.answer) IS NULL AS missing
FROM orders LEFT JOIN k ON k.pair_key = o_custkey"""


def pairs_with_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer and supplier nations as pairs; contexts are names, and some have none."""
    pairs = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("a"), ((F.col("n_nationkey") * 7 + 3) % 30).alias("b"))
    contexts = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("term"), F.array("n_name").alias("contexts"))
    out = ju.with_contexts(pairs, contexts)
    return out.select("a", "b", "skipped", F.array_join("contexts_a", ",").alias("of_a"), F.array_join("contexts_b", ",").alias("of_b"))


PAIRS_WITH_CONTEXTS = """WITH c AS (SELECT n_nationkey AS term, n_name FROM nation WHERE n_nationkey % 5 <> 0)
SELECT p.n_nationkey AS a, (p.n_nationkey * 7 + 3) % 30 AS b, x.n_name IS NULL OR y.n_name IS NULL AS skipped, x.n_name AS of_a, y.n_name AS of_b
FROM nation p LEFT JOIN c x ON x.term = p.n_nationkey LEFT JOIN c y ON y.term = (p.n_nationkey * 7 + 3) % 30"""


def expandable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _judged(spark, sf_dir)
    status = po.decide_status(F.col("relation_type"), F.col("confidence"), F.col("safe.ab") & F.col("safe.ba"))
    return rows.select("o_orderkey", (F.col("safe.ab") & po.is_expandable(F.col("term_type"), F.col("relation_type"), status)).alias("expandable"))


EXPANDABLE = f"WITH {_VERDICTS} SELECT o_orderkey, ab AND expandable AS expandable FROM ex"


def directed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ju.directed(_judged(spark, sf_dir)).select("o_orderkey", "source", "target", "safe_expansion", "relation_type", "confidence", "status")


DIRECTED_ROWS = f"WITH {_VERDICTS} SELECT o_orderkey, a AS source, b AS target, ab AS safe_expansion, relation_type, guarded AS confidence, status FROM st UNION ALL SELECT o_orderkey, b, a, ba, relation_type, guarded, status FROM st"


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ju.review_queue(ju.directed(_judged(spark, sf_dir))).select("o_orderkey", "source", "target")


REVIEW_QUEUE = f"WITH {_VERDICTS} SELECT o_orderkey, least(a, b) AS source, greatest(a, b) AS target FROM st WHERE status = 'REVIEW'"


def proposal_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("a"), _pick(("SAME", "BROADER", "NARROWER", "OTHER"), F.col("o_orderkey")).alias("h"), _pick(("HIGH", "MEDIUM", "LOW", "NONE"), F.col("o_custkey")).alias("c"))
    return rows.groupBy("a").agg(F.max(po.proposal_score(F.col("h"), F.col("c"))).alias("score"))


PROPOSAL_SCORE = "SELECT o_custkey % 100 AS a, max(round(([1.0, 0.7, 0.7, 0.5]::DOUBLE[])[o_orderkey % 4 + 1] * ([1.0, 0.7, 0.4, 0.4]::DOUBLE[])[o_custkey % 4 + 1], 4)) AS score FROM orders GROUP BY 1"


# ---------------------------------------------------------------- relations and dictionary
def _relations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Directed relations between customers and nations, one for each ends and type (the last order), and both as terms."""
    rows = ju.directed(_judged(spark, sf_dir).withColumnRenamed("o_orderkey", "seq").drop("term_type"))
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("term"), F.col("c_custkey").alias("frequency"), _pick(("ENTITY", "CONCEPT", "UNKNOWN"), F.col("c_custkey")).alias("term_type"))
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("term"), F.col("n_nationkey").cast("long").alias("frequency"), F.lit("CONCEPT").alias("term_type"))
    terms = customers.where("term <> 'c7'").union(nations)
    return sy.save_relations(rows, terms), terms


_RELATIONS = f"""{_VERDICTS}, dr AS (SELECT o_orderkey AS seq, a AS source, b AS target, ab AS safe_expansion, relation_type, guarded AS confidence, status, similarity FROM st UNION ALL SELECT o_orderkey, b, a, ba, relation_type, guarded, status, similarity FROM st),
tm AS (SELECT 'c' || c_custkey AS term, c_custkey AS frequency, (['ENTITY', 'CONCEPT', 'UNKNOWN'])[c_custkey % 3 + 1] AS term_type FROM customer WHERE c_custkey <> 7 UNION ALL SELECT 'n' || n_nationkey, n_nationkey, 'CONCEPT' FROM nation),
re AS (SELECT * FROM dr WHERE source IN (SELECT term FROM tm) AND target IN (SELECT term FROM tm) QUALIFY row_number() OVER (PARTITION BY source, target, relation_type ORDER BY seq DESC) = 1)"""


def relations_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relations(spark, sf_dir)[0].select("seq", "source", "target", "relation_type", "status", "safe_expansion")


RELATIONS_SAVED = f"WITH {_RELATIONS} SELECT seq, source, target, relation_type, status, safe_expansion FROM re"


def relations_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ju.joined_relations(*_relations(spark, sf_dir), status="REVIEW").select("source", "target", "relation_type", "similarity", "source_type", "target_type")


RELATIONS_JOINED = f"WITH {_RELATIONS} SELECT source, target, relation_type, similarity, s.term_type AS source_type, t.term_type AS target_type FROM re JOIN tm s ON source = s.term JOIN tm t ON target = t.term WHERE status = 'REVIEW'"


def relations_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relations(spark, sf_dir)[0].groupBy("status").agg(F.count(F.lit(1)).alias("n"))


RELATIONS_BY_STATUS = f"WITH {_RELATIONS} SELECT status, count(*) AS n FROM re GROUP BY 1"


def relations_of_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _relations(spark, sf_dir)
    return rows.where(F.col("source").isin("n3", "c12") & F.col("status").isin("ACTIVE", "REVIEW")).select("source", "target", "relation_type", "status")


RELATIONS_OF_TERM = f"WITH {_RELATIONS} SELECT source, target, relation_type, status FROM re WHERE source IN ('n3', 'c12') AND status IN ('ACTIVE', 'REVIEW')"


def dictionary_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, terms = _relations(spark, sf_dir)
    entry = F.transform("relations", lambda e: F.concat_ws(":", e["termKey"], e["relationType"], e["expandable"].cast("string")))
    return ju.dictionary(terms, rows).select("term", "display", "term_type", "frequency", F.array_join(entry, ",").alias("relations"))


DICTIONARY_ENTRIES = f"""WITH {_RELATIONS}, ow AS (SELECT source AS term, target, relation_type, similarity, safe_expansion AND status = 'ACTIVE' AND CASE term_type WHEN 'ENTITY' THEN relation_type IN ('SAME_ENTITY', 'EXACT_ALIAS', 'ALIAS', 'ABBREVIATION')
WHEN 'CONCEPT' THEN relation_type IN ('EXACT_ALIAS', 'SYNONYM', 'NEAR_SYNONYM', 'ABBREVIATION') ELSE false END AS e FROM re JOIN tm ON source = term WHERE status IN ('ACTIVE', 'REVIEW')),
ls AS (SELECT term, string_agg(target || ':' || relation_type || ':' || e, ',' ORDER BY e DESC, similarity DESC, target, relation_type) AS relations FROM ow GROUP BY 1)
SELECT term, term AS display, term_type, frequency, coalesce(relations, '') AS relations FROM tm LEFT JOIN ls USING (term) WHERE relations IS NOT NULL OR term_type <> 'UNKNOWN'"""


# ---------------------------------------------------------------- review
def review_terms_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = part_terms(spark, sf_dir).select("term", "frequency", (F.col("frequency") % 9).alias("document_frequency"), F.lit(1.0).alias("sentence_ratio"), F.lit("").alias("excluded_reason"))
    pairs = table(spark, sf_dir, "part").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("a"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("b")).distinct()
    patterns = terms.where("frequency % 2 = 0").select("term", (F.col("frequency") % 5).alias("patterns"))
    terms = terms.withColumn("entity_type", F.when(F.col("frequency") % 3 == 0, "SYSTEM"))
    return ev.terms_sheet(terms, pairs, patterns).select("term", "display", "entity_type", "frequency", "pairs", "patterns", "hint")


REVIEW_TERMS_SHEET = f"""WITH {TERMS}, pr AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part), iv AS (SELECT term, count(*) AS pairs FROM (SELECT a AS term FROM pr UNION ALL SELECT b FROM pr) GROUP BY 1),
s AS (SELECT term, replace(term, '_', ' ') AS display, CASE WHEN frequency % 3 = 0 THEN 'SYSTEM' ELSE '' END AS entity_type, frequency, coalesce(pairs, 0) AS pairs, CASE WHEN frequency % 2 = 0 THEN frequency % 5 ELSE 0 END AS patterns FROM terms LEFT JOIN iv USING (term))
SELECT *, CASE WHEN length(replace(display, ' ', '')) <= 1 THEN 'one character' WHEN regexp_matches(display, '^[A-Za-z][A-Za-z0-9]*$') AND display = lower(display) THEN 'field name'
WHEN regexp_matches(display, '^[A-Za-z][A-Za-z0-9]*$') AND display = upper(display) THEN 'code value' WHEN patterns <= 1 AND frequency >= 5 THEN 'repeated phrase' ELSE '' END AS hint FROM s"""


def review_relations_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, terms = _relations(spark, sf_dir)
    pairs = rows.select(F.col("source").alias("a"), F.col("target").alias("b")).distinct().where("a < b").withColumn("sources", F.array(F.lit("LEXICAL")))
    # a fifth of the relations is left out, so some pairs are unjudged
    sheet = ev.relations_sheet(pairs, rows.where("seq % 5 <> 0").withColumn("reason", F.col("relation_type")), terms)
    return sheet.select("pair_key", "display_a", "display_b", "relation_type", "state", "expandable", "hint", "frequency_a", "frequency_b", "sources")


REVIEW_RELATIONS_SHEET = f"""WITH {_RELATIONS}, pr AS (SELECT DISTINCT source AS a, target AS b FROM re WHERE source < target), jd AS (SELECT * FROM re WHERE seq % 5 <> 0)
SELECT a || '||' || b AS pair_key, a AS display_a, b AS display_b, coalesce(relation_type, '') AS relation_type, coalesce(status, 'UNJUDGED') AS state, CASE WHEN safe_expansion THEN 'yes' ELSE '' END AS expandable,
CASE WHEN status = 'REJECTED' THEN 'judged unrelated' ELSE '' END AS hint, x.frequency AS frequency_a, y.frequency AS frequency_b, 'LEXICAL' AS sources
FROM pr LEFT JOIN jd ON source = a AND target = b JOIN tm x ON a = x.term JOIN tm y ON b = y.term"""


def _removed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows, _ = _relations(spark, sf_dir)
    terms = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("term"))
    pairs = table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), (F.col("s_suppkey") * 3).cast("string"), F.lit("||n"), F.col("s_nationkey").cast("string")).alias("pair_key")).distinct()
    return rows, terms, pairs


_REMOVED = f"{_RELATIONS}, gt AS (SELECT 'c' || s_suppkey AS term FROM supplier WHERE s_acctbal < 0), gp AS (SELECT DISTINCT 'c' || (s_suppkey * 3) || '||n' || s_nationkey AS k FROM supplier), fl AS (SELECT *, source IN (SELECT term FROM gt) OR target IN (SELECT term FROM gt) AS t, least(source, target) || '||' || greatest(source, target) IN (SELECT k FROM gp) AS p FROM re)"


def removal_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sy.removal_impact(*_removed(spark, sf_dir))


REMOVAL_IMPACT = f"WITH {_REMOVED} SELECT count(*) FILTER (WHERE t) AS by_term, count(*) FILTER (WHERE p AND NOT t) AS by_pair, count(*) FILTER (WHERE NOT t AND NOT p) AS remaining FROM fl"


def relations_after_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sy.without_terms(*_removed(spark, sf_dir)).select("source", "target", "relation_type")


RELATIONS_AFTER_REMOVAL = f"WITH {_REMOVED} SELECT source, target, relation_type FROM fl WHERE NOT t AND NOT p"


# ---------------------------------------------------------------- evaluation
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample: its size is the feature."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ev.stratified_sample(docs, F.col("lang"), 50, ["doc_id"], order=[F.col("doc_id")]).select("doc_id", "stratum")


STRATIFIED_SAMPLE = """WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents)
SELECT doc_id, lang AS stratum FROM r ORDER BY n <= 50 // (SELECT count(DISTINCT lang) FROM documents) DESC, doc_id LIMIT 50"""


def candidate_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_custkey")
    sources = F.when(n % 4 == 0, F.array(F.lit("FASTTEXT"))).when(n % 4 == 1, F.array(F.lit("CONTAINMENT"), F.lit("LEXICAL"))).when(n % 4 == 2, F.array(F.lit("LLM_PROPOSED"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "orders").groupBy(po.stratum(sources).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


CANDIDATE_STRATA = "SELECT (['embedding only', 'several paths', 'proposed only', 'none'])[o_custkey % 4 + 1] AS stratum, count(*) AS n FROM orders GROUP BY 1"


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("n_chars >= 500").select("doc_id", "lang", F.when(F.col("n_chars") > 3000, "ACTIVE").when(F.col("n_chars") > 1000, "REVIEW").otherwise("REJECTED").alias("status"))
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("positive"))
    rows = labels.join(docs, "doc_id", "left")
    return rows.withColumn("found", F.col("status").isNotNull())


_GOLD = "g AS (SELECT l.doc_id, quality = 1 AS positive, lang, CASE WHEN n_chars > 3000 THEN 'ACTIVE' WHEN n_chars > 1000 THEN 'REVIEW' WHEN n_chars >= 500 THEN 'REJECTED' END AS status FROM labels l LEFT JOIN (SELECT * FROM documents WHERE n_chars >= 500) USING (doc_id))"


def gold_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.gold_figures(_gold(spark, sf_dir))


GOLD_EVAL = f"""WITH {_GOLD}, c AS (SELECT count(*) FILTER (WHERE positive) AS positives, count(*) FILTER (WHERE positive AND status IS NOT NULL) AS found, count(*) FILTER (WHERE status = 'ACTIVE') AS active,
count(*) FILTER (WHERE positive AND status = 'ACTIVE') AS active_right, count(*) FILTER (WHERE positive AND status = 'REVIEW') AS in_review FROM g) SELECT *, round(found::DOUBLE / positives, 4) AS recall, round(active_right::DOUBLE / active, 4) AS precision FROM c"""


def gold_by_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.share_by(_gold(spark, sf_dir).where("found"), F.col("lang"), F.col("positive"))


GOLD_BY_STRATUM = f"WITH {_GOLD} SELECT lang AS stratum, count(*) AS n, count(*) FILTER (WHERE positive) AS positives, round(avg(positive::INT), 4) AS share FROM g WHERE status IS NOT NULL GROUP BY 1"


# ---------------------------------------------------------------- corpus and runs
def corpus_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.category_counts(table(spark, sf_dir, "documents"), "lang", {"en": 700, "fr": 100, "it": 10})


CORPUS_QA = """WITH c AS (SELECT lang AS category, count(*) AS n FROM documents GROUP BY 1), t(category, target) AS (VALUES ('en', 700), ('fr', 100), ('it', 10))
SELECT category, coalesce(n, 0) AS n, target::INT AS target, greatest(target - coalesce(n, 0), CASE WHEN target IS NOT NULL THEN 0 END)::BIGINT AS missing FROM c FULL JOIN t USING (category)"""


def duplicate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.duplicates(table(spark, sf_dir, "documents"), F.sha2("text", 256))


DUPLICATE_TEXTS = "SELECT sha256(text) AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1"


def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.length_buckets(table(spark, sf_dir, "documents"), F.length("text"), [500, 1000, 2000, 5000])


LENGTH_BUCKETS = "SELECT CASE WHEN length(text) < 500 THEN '<500' WHEN length(text) < 1000 THEN '500-999' WHEN length(text) < 2000 THEN '1000-1999' WHEN length(text) < 5000 THEN '2000-4999' ELSE '>=5000' END AS bucket, count(*) AS n FROM documents GROUP BY 1"


def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.missing_ids(table(spark, sf_dir, "labels"), "doc_id")


MISSING_IDS = "SELECT unnest(generate_series((SELECT min(doc_id) FROM labels), (SELECT max(doc_id) FROM labels))) AS id EXCEPT SELECT doc_id FROM labels"


def unlisted_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.unlisted_mentions(table(spark, sf_dir, "documents").withColumn("listed", F.array("lang")), "text", ["en", "token", "mail"], "listed", "doc_id")


UNLISTED_MENTIONS = "SELECT doc_id AS key, name FROM documents, (SELECT unnest(['en', 'token', 'mail']) AS name) WHERE contains(text, name) AND name <> lang"


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexiloom.sources.writers import run_record

    rows, _ = _relations(spark, sf_dir)
    names = {"documents": "documents", "terms": "part", "contexts": "lineitem", "candidates": "orders"}
    frames = {k: table(spark, sf_dir, v) for k, v in names.items()} | {s.lower(): rows.where(F.col("status") == s) for s in ("ACTIVE", "REVIEW", "REJECTED")}
    return run_record("run-1", {"failed": F.lit(0)}, frames)


RUN_METRICS = f"""WITH {_RELATIONS} SELECT 'run-1' AS run_id, 'COMPLETED' AS status, (SELECT count(*) FROM documents) AS documents, (SELECT count(*) FROM part) AS terms, (SELECT count(*) FROM lineitem) AS contexts, (SELECT count(*) FROM orders) AS candidates,
count(*) FILTER (WHERE status = 'ACTIVE') AS active, count(*) FILTER (WHERE status = 'REVIEW') AS review, count(*) FILTER (WHERE status = 'REJECTED') AS rejected, 0 AS failed FROM re"""


def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the limit is the feature."""
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value").orderBy(F.desc("event_id")).limit(10)


RECENT_RUNS = "SELECT event_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 10"


def context_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COUNT(*) of each table of a run."""
    names = ("documents", "pages", "part", "lineitem", "orders")
    return reduce(DataFrame.union, [table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in names])


CONTEXT_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in ("documents", "pages", "part", "lineitem", "orders"))


# ---------------------------------------------------------------- selections
def terms_in_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "part").where("p_size <= 10").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("a"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("b"))
    return ju.involved(part_terms(spark, sf_dir), pairs)


TERMS_IN_CANDIDATES = f"WITH {TERMS} SELECT * FROM terms WHERE term IN (SELECT unnest(string_split(p_name, ' ')) FROM part WHERE p_size <= 10)"


def proposal_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k selection: the limit is the feature."""
    return ju.proposal_terms(part_terms(spark, sf_dir).withColumn("excluded_reason", F.lit("")), 20, 10)


PROPOSAL_TERMS = f"WITH {TERMS} SELECT term, frequency, '' AS excluded_reason FROM terms WHERE frequency >= 10 ORDER BY frequency DESC, term LIMIT 20"


def answered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return ju.answered_only(orders.select("o_orderkey", "o_custkey"), orders.where("o_orderstatus = 'F'"), "o_orderkey")


ANSWERED_PAIRS = "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'"


def evidence_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("context_id"), F.col("l_orderkey").alias("relation_id")).distinct()
    contexts = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("context_id"))
    relations = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("relation_id"))
    return ju.cascaded(lines, contexts, relations)


EVIDENCE_CASCADE = "SELECT DISTINCT l_partkey AS context_id, l_orderkey AS relation_id FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey WHERE p_size > 25 AND o_orderstatus = 'O'"


def relation_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of every relation whose ends are in the catalogue, from all of its rows."""
    _, terms = _relations(spark, sf_dir)
    rows = ju.directed(_judged(spark, sf_dir)).withColumn("evidence", F.array(F.col("o_orderkey") % 40, F.col("o_orderkey") % 7))
    return sy.save_evidence(rows, terms)


RELATION_EVIDENCE = f"""WITH {_RELATIONS} SELECT DISTINCT md5(source || '||' || target || '||' || relation_type) AS relation_id, unnest([seq % 40, seq % 7]) AS context_id
FROM dr WHERE source IN (SELECT term FROM tm) AND target IN (SELECT term FROM tm)"""


def evidence_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved relations with their evidence, of contexts and relations that are still there."""
    rows, terms = _relations(spark, sf_dir)
    contexts = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").cast("long").alias("context_id"))
    rows = rows.where("status <> 'REJECTED'").withColumn("relation_id", sy.relation_id())
    listed = ju.with_evidence(rows, ju.cascaded(relation_evidence(spark, sf_dir), contexts, rows))
    return listed.select("source", "target", "relation_type", F.concat_ws(",", F.transform("evidence", lambda x: x.cast("string"))).alias("evidence"))


EVIDENCE_LISTED = f"""WITH {_RELATIONS}, al AS (SELECT DISTINCT source, target, relation_type, unnest([seq % 40, seq % 7]) AS c FROM dr),
ev AS (SELECT source, target, relation_type, string_agg(c::VARCHAR, ',' ORDER BY c) AS evidence FROM al JOIN nation ON c = n_nationkey WHERE n_regionkey <> 2 GROUP BY 1, 2, 3)
SELECT source, target, relation_type, coalesce(evidence, '') AS evidence FROM re LEFT JOIN ev USING (source, target, relation_type) WHERE status <> 'REJECTED'"""


def text_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexiloom.functions.variants import Variant, apply_variants, word_start

    rules = [Variant("the", F.col("lang") == "en", [(word_start("the"), "teh")]), Variant("de", F.col("lang") == "fr", [(word_start("de"), "von")])]
    text, counts = apply_variants(F.col("text"), rules)
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), counts["the"].alias("n_the"), counts["de"].alias("n_de"))


TEXT_VARIANTS = r"""SELECT doc_id, CASE lang WHEN 'en' THEN regexp_replace(text, '(^|[^0-9A-Za-z가-힣])the', '\1teh', 'g') WHEN 'fr' THEN regexp_replace(text, '(^|[^0-9A-Za-z가-힣])de', '\1von', 'g') ELSE text END AS text,
CASE WHEN lang = 'en' THEN len(regexp_extract_all(text, '(?:^|[^0-9A-Za-z가-힣])the')) ELSE 0 END::INT AS n_the, CASE WHEN lang = 'fr' THEN len(regexp_extract_all(text, '(?:^|[^0-9A-Za-z가-힣])de')) ELSE 0 END::INT AS n_de FROM documents"""
