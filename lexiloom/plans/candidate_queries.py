"""Queries of candidate pairs: lexical rules, profiles, vectors, fusion, selection, evaluation of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import text as tx
from lexiloom.operators import candidates as ca
from lexiloom.operators import embedding as em
from lexiloom.operators import evaluate as ev
from lexiloom.operators import index as ix
from lexiloom.plans.inputs import BASKET, TERMS, baskets, part_terms, table, token_frequency
from lexiloom.session import written

_PARTS = "list_filter(regexp_split_to_array(replace(term, '_', ' '), '[^0-9A-Za-z가-힣]+'), lambda x: x <> '')"
_P = f"{TERMS}, p AS (SELECT term, {_PARTS} AS parts, list_transform({_PARTS}, lambda x: lower(x)) AS low FROM terms)"


def lexical_word_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("term")).distinct()
    turned = names.select(F.concat_ws("_", F.split_part("term", F.lit("_"), F.lit(2)), F.split_part("term", F.lit("_"), F.lit(1))).alias("term"))
    return ca.word_order_pairs(names.union(turned).distinct())


LEXICAL_WORD_ORDER = """WITH n AS (SELECT DISTINCT replace(p_name, ' ', '_') AS term FROM part), t AS (SELECT term FROM n UNION SELECT split_part(term, '_', 2) || '_' || split_part(term, '_', 1) FROM n),
k AS (SELECT term, list_sort(list_distinct(string_split(lower(term), '_')))::VARCHAR AS k FROM t) SELECT x.term AS a, y.term AS b, 1.0::DOUBLE AS score FROM k x JOIN k y ON x.k = y.k AND x.term < y.term"""


def lexical_squash(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")).alias("term")).distinct()
    return ca.squash_pairs(names.union(names.select(F.initcap(F.replace(F.col("term"), F.lit("_"), F.lit("")))).toDF("term")).union(names.select(F.upper("term"))))


LEXICAL_SQUASH = """WITH n AS (SELECT DISTINCT replace(p_name, ' ', '_') AS term FROM part), t AS (SELECT term FROM n UNION SELECT upper(replace(term, '_', '')[1]) || replace(term, '_', '')[2:] FROM n UNION SELECT upper(term) FROM n),
k AS (SELECT term, lower(replace(term, '_', '')) AS k FROM t) SELECT x.term AS a, y.term AS b, 1.0::DOUBLE AS score FROM k x JOIN k y ON x.k = y.k AND x.term < y.term"""


def lexical_acronym(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.acronym_pairs(part_terms(spark, sf_dir))


_ACRONYM = """SELECT DISTINCT least(l.term, s.term) AS a, greatest(l.term, s.term) AS b, 0.9::DOUBLE AS score
FROM (SELECT term, upper(array_to_string(list_transform(parts, lambda x: x[1]), '')) AS k FROM p WHERE len(parts) >= 2) l JOIN (SELECT term, upper(replace(term, '_', '')) AS k FROM p WHERE regexp_matches(replace(term, '_', ''), '^[A-Z][A-Z0-9]{1,7}$')) s ON l.k = s.k AND l.term <> s.term"""
LEXICAL_ACRONYM = f"WITH {_P} {_ACRONYM}"


def lexical_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.containment_pairs(part_terms(spark, sf_dir))


_CONTAIN = """SELECT least(s.term, l.term) AS a, greatest(s.term, l.term) AS b, round(1.0 / len(l.parts), 4)::DOUBLE AS score FROM p s JOIN p l ON len(s.parts) = 1 AND length(s.parts[1]) >= 2 AND len(l.parts) >= 2 AND list_contains(l.low, s.low[1])"""
LEXICAL_CONTAINMENT = f"WITH {_P} {_CONTAIN}"


def lexical_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.lexical_pairs(part_terms(spark, sf_dir)).withColumn("sources", F.array_join("sources", ","))


_LEXICAL = f"""{_P}, wo AS (SELECT term, list_sort(list_distinct(low))::VARCHAR AS k FROM p WHERE len(parts) >= 2), sq AS (SELECT term, array_to_string(low, '') AS k FROM p),
lex AS (SELECT x.term AS a, y.term AS b, 1.0::DOUBLE AS score, 'LEXICAL' AS source FROM wo x JOIN wo y ON x.k = y.k AND x.term < y.term UNION ALL SELECT x.term, y.term, 1.0, 'LEXICAL' FROM sq x JOIN sq y ON x.k = y.k AND x.term < y.term
UNION ALL SELECT *, 'LEXICAL' FROM ({_ACRONYM}) UNION ALL SELECT *, 'CONTAINMENT' FROM ({_CONTAIN})),
lexical AS (SELECT a, b, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, max(score) AS score FROM lex GROUP BY 1, 2)"""
LEXICAL_MERGED = f"WITH {_LEXICAL} SELECT * FROM lexical"


# ---------------------------------------------------------------- profiles
WINDOW, LEAST = 5, 5


def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.cooccurrence(baskets(spark, sf_dir), window=WINDOW)


_CO = f"{BASKET}, co AS (SELECT x.token AS term, y.token AS ctx, count(*) AS n FROM line x JOIN line y ON x.page_id = y.page_id AND x.pos <> y.pos AND abs(x.pos - y.pos) <= {WINDOW} GROUP BY 1, 2)"
COOCCURRENCE = f"WITH {_CO} SELECT * FROM co"


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = baskets(spark, sf_dir)
    return ca.ppmi(ca.cooccurrence(rows, window=WINDOW), token_frequency(rows), LEAST)


def ppmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(spark, sf_dir).withColumn("weight", F.round("weight", 4))


_PPMI = f"""{_CO}, fr AS (SELECT token AS term, count(*) AS n FROM line GROUP BY 1), rw AS (SELECT co.* FROM co JOIN fr USING (term) WHERE fr.n >= {LEAST}),
w AS (SELECT term, ctx, ln(n::DOUBLE * (SELECT sum(n) FROM rw) / (sum(n) OVER (PARTITION BY term)::DOUBLE * sum(n) OVER (PARTITION BY ctx)) + 1e-12) AS weight FROM rw), pp AS (SELECT * FROM w WHERE weight > 0)"""
PPMI = f"WITH {_PPMI} SELECT term, ctx, round(weight, 4) AS weight FROM pp"


def ppmi_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.profile_neighbors(_weights(spark, sf_dir), top=10)


_PN = f"""{_PPMI}, nm AS (SELECT term, sqrt(sum(weight * weight)) AS norm FROM pp GROUP BY 1), un AS (SELECT pp.term, ctx, weight / norm AS u FROM pp JOIN nm USING (term)),
pd AS (SELECT x.term, y.term AS other, round(sum(x.u * y.u), 6) AS similarity FROM un x JOIN un y ON x.ctx = y.ctx AND x.term <> y.term GROUP BY 1, 2),
pn AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY similarity DESC, other) AS rank FROM pd QUALIFY rank <= 10)"""
PPMI_NEIGHBORS = f"WITH {_PN} SELECT term, other, similarity, rank::INT AS rank FROM pn"


# ---------------------------------------------------------------- factors of profiles
def _factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.factors(_weights(spark, sf_dir), size=48)


def factor_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours by the factors of the profiles' table, n-grams of the spelling added."""
    vectors = em.with_subwords(_factors(spark, sf_dir), token_frequency(baskets(spark, sf_dir)).withColumnRenamed("n", "frequency"))
    return ca.vector_neighbors(written(spark)(vectors, "vectors"), top=10, rounded=4)


def factor_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the profiles' own neighbours the factors alone find."""
    return ix.overlap(ca.vector_neighbors(written(spark)(_factors(spark, sf_dir), "vectors"), top=10), ppmi_neighbors(spark, sf_dir))


# ---------------------------------------------------------------- vectors
def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("term"), F.col("embedding").alias("vector"))


def vector_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.vector_neighbors(_vectors(spark, sf_dir), top=10, rounded=5)


def indexed_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ix.indexed_neighbors(_vectors(spark, sf_dir), top=10, rounded=5)


def indexed_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index beside the exact way."""
    return ix.recall(indexed_neighbors(spark, sf_dir), vector_neighbors(spark, sf_dir))


_VN = """vu AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)),
vd AS (SELECT x.vec_id AS term, y.vec_id AS other, round(list_dot_product(x.e, y.e) / (x.norm * y.norm), 5) AS similarity FROM vu x JOIN vu y ON x.vec_id <> y.vec_id),
vn AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY similarity DESC, other) AS rank FROM vd QUALIFY rank <= 10)"""
VECTOR_NEIGHBORS = f"WITH {_VN} SELECT term, other, similarity, rank::INT AS rank FROM vn"


def valid_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours that are in a catalogue, eligible and frequent enough, ranked anew."""
    terms = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("term"), (F.col("vec_id") % 7).alias("frequency"), F.when(F.col("vec_id") % 5 == 0, "short").otherwise("").alias("excluded_reason"))
    kept = ca.valid_neighbors(vector_neighbors(spark, sf_dir), terms, 2)
    return kept.select("term", "other", "similarity", "rank")


VALID_NEIGHBORS = f"""WITH {_VN} SELECT term, other, similarity, row_number() OVER (PARTITION BY term ORDER BY similarity DESC, other)::INT AS rank
FROM vn WHERE other % 7 >= 2 AND other % 5 <> 0"""


def neighbor_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of fixed size: neighbours of the 40 most frequent terms."""
    terms = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("term"), (F.col("vec_id") * 37 % 101).alias("frequency"), F.when(F.col("vec_id") % 5 == 0, "short").otherwise("").alias("excluded_reason"))
    near = ca.vector_neighbors(_vectors(spark, sf_dir), top=10, rounded=5, asked=ca.most_frequent(terms, 40))
    return ca.probe(terms, near, most=40, top=5)


NEIGHBOR_PROBE = f"""WITH {_VN}, p AS (SELECT vec_id FROM embeddings WHERE vec_id % 5 <> 0 ORDER BY vec_id * 37 % 101 DESC, vec_id LIMIT 40)
SELECT term, other, similarity, rank::INT AS rank FROM vn WHERE rank <= 5 AND other % 5 <> 0 AND term IN (SELECT vec_id FROM p)"""


def mutual_rank_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = written(spark)(vector_neighbors(spark, sf_dir), "near")  # ranks and rows are read from it
    rows = ca.neighbor_pairs(near, "FASTTEXT", 0.2)
    return ca.mutual_pairs(rows, 5, 2).groupBy("a", "b").agg(F.max("similarity").alias("similarity"), F.min("rank_ab").alias("rank_ab"), F.min("rank_ba").alias("rank_ba"))


_MUTUAL = f"""{_VN}, vp AS (SELECT least(term, other) AS a, greatest(term, other) AS b, max(similarity) AS similarity, min(rank) FILTER (WHERE term < other) AS rank_ab, min(rank) FILTER (WHERE term > other) AS rank_ba FROM vn WHERE similarity >= 0.2 GROUP BY 1, 2),
mp AS (SELECT * FROM vp WHERE (rank_ab <= 5 AND rank_ba <= 5) OR least(rank_ab, rank_ba) <= 2)"""
MUTUAL_RANK_PAIRS = f"WITH {_MUTUAL} SELECT a, b, similarity, rank_ab::INT AS rank_ab, rank_ba::INT AS rank_ba FROM mp"


# ---------------------------------------------------------------- fusion
def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexical = ca.lexical_pairs(part_terms(spark, sf_dir))
    paths = [ca.scored_pairs(lexical.where(F.array_contains("sources", s)), s, "lexical") for s in ("LEXICAL", "CONTAINMENT")]
    return ca.fuse([*paths, ca.neighbor_pairs(ca.profile_neighbors(_weights(spark, sf_dir), top=10), "CONTEXT_PROFILE", 0.1)])


_FUSED = f"""{_LEXICAL}, {_PN}, fu AS (
  SELECT a, b, unnest(string_split(sources, ',')) AS source, score AS lexical, NULL AS rank_ab, NULL AS rank_ba FROM lexical
  UNION ALL SELECT least(term, other), greatest(term, other), 'CONTEXT_PROFILE', NULL, CASE WHEN term < other THEN rank END, CASE WHEN term > other THEN rank END FROM pn WHERE similarity >= 0.1),
fg AS (SELECT a, b, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(DISTINCT source) AS ns, coalesce(max(lexical), 0.0) AS lexical, min(rank_ab) AS rank_ab, min(rank_ba) AS rank_ba FROM fu GROUP BY 1, 2),
fp AS (SELECT *, round(round(0.45 * lexical + 0.30 * (coalesce(1.0::DOUBLE / rank_ab, 0) + coalesce(1.0::DOUBLE / rank_ba, 0)) / 2 + CASE WHEN rank_ab IS NOT NULL AND rank_ba IS NOT NULL THEN 0.15 ELSE 0.0 END + 0.15 * (ns - 1), 6), 4) AS priority FROM fg)"""


def candidate_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir).select("a", "b", F.array_join("sources", ",").alias("sources"), "lexical", "rank_ab", "rank_ba")


CANDIDATE_FUSION = f"WITH {_FUSED} SELECT a, b, sources, lexical, rank_ab::INT AS rank_ab, rank_ba::INT AS rank_ba FROM fp"


def candidate_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(spark, sf_dir).select("a", "b", F.round("priority", 4).alias("priority"))


CANDIDATE_PRIORITY = f"WITH {_FUSED} SELECT a, b, priority FROM fp"


def corroborated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.corroborated(_fused(spark, sf_dir)).select("a", "b", F.array_join("sources", ",").alias("sources"))


CORROBORATED = f"WITH {_FUSED} SELECT a, b, sources FROM fp WHERE sources <> 'CONTEXT_PROFILE'"


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.source_counts(_fused(spark, sf_dir))


SOURCE_COUNTS = f"WITH {_FUSED} SELECT unnest(string_split(sources, ',')) AS source, count(*) AS n FROM fp GROUP BY 1"


def excluded_pairs_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ca.containment_pairs(part_terms(spark, sf_dir))
    gone = table(spark, sf_dir, "part").where("p_size <= 5").select(tx.pair_key(F.split_part("p_name", F.lit(" "), F.lit(1)), F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))).alias("pair_key"))
    return ca.without_excluded(pairs, gone.distinct()).select("a", "b", "score")


EXCLUDED_PAIRS_ANTIJOIN = f"""WITH {_P}, c AS ({_CONTAIN}), x AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS s, replace(p_name, ' ', '_') AS l FROM part WHERE p_size <= 5)
SELECT a, b, score FROM c WHERE NOT EXISTS (SELECT 1 FROM x WHERE a = least(s, l) AND b = greatest(s, l))"""


def top_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the limit is the feature."""
    return ca.top_pairs(_fused(spark, sf_dir).withColumn("priority", F.round("priority", 4)), 100).select("a", "b", "priority")


TOP_CANDIDATES = f"WITH {_FUSED} SELECT a, b, priority FROM fp ORDER BY priority DESC, a, b LIMIT 100"


def degree_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ca.neighbor_pairs(vector_neighbors(spark, sf_dir), "FASTTEXT", 0.0).groupBy("a", "b").agg(F.max("similarity").alias("priority"))
    put = written(spark)
    return ca.degree_capped(put(pairs, "pairs"), 3, put)


#: The scan from the best pair down, as a fold over the list of all pairs.
_ENDS = "len(list_filter(acc, lambda y: y.a = x[1].{0} OR y.b = x[1].{0}))"
DEGREE_CAPPED = f"""WITH {_VN}, vp AS (SELECT least(term, other) AS a, greatest(term, other) AS b, max(similarity) AS priority FROM vn WHERE similarity >= 0.0 GROUP BY 1, 2),
listed AS (SELECT list({{'a': a, 'b': b, 'priority': priority}} ORDER BY priority DESC, a, b) AS rows FROM vp),
taken AS (SELECT unnest(list_reduce(list_transform(rows, lambda x: [x]), lambda acc, x: CASE WHEN {_ENDS.format("a")} >= 3 OR {_ENDS.format("b")} >= 3 THEN acc ELSE list_concat(acc, x) END)) AS p FROM listed)
SELECT p.a AS a, p.b AS b, p.priority AS priority FROM taken"""


def candidate_upsert_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexiloom.operators.sync import upsert_max

    rows = table(spark, sf_dir, "lineitem").select(F.concat_ws("||", F.least("l_partkey", "l_suppkey"), F.greatest("l_partkey", "l_suppkey")).alias("pair_key"), F.col("l_discount").alias("similarity"), F.col("l_returnflag").alias("status"), F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag").alias("seq"))
    return upsert_max(rows, ["pair_key"], "similarity", "seq", ["status"])


CANDIDATE_UPSERT_MAX = """SELECT least(l_partkey, l_suppkey)::VARCHAR || '||' || greatest(l_partkey, l_suppkey)::VARCHAR AS pair_key, max(l_discount) AS similarity,
max_by(l_returnflag, row(l_shipdate, l_orderkey, l_linenumber, l_returnflag)) AS status FROM lineitem GROUP BY 1"""


def similarity_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.threshold_shares(vector_neighbors(spark, sf_dir), "similarity", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 0.9])


SIMILARITY_THRESHOLDS = f"WITH {_VN}, t AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 0.9]::DOUBLE[]) AS threshold) SELECT threshold, count(*) FILTER (WHERE similarity >= threshold) AS n, round(count(*) FILTER (WHERE similarity >= threshold)::DOUBLE / count(*), 4) AS share FROM vn, t GROUP BY 1"


def parameter_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = ca.profile_neighbors(_weights(spark, sf_dir), top=10)
    return ev.grid_counts(near, token_frequency(baskets(spark, sf_dir)), [(0.5, 1000, 3), (0.3, 900, 5), (0.2, 500, 8), (0.1, 300, 10)])


PARAMETER_GRID = f"""WITH {_PN}, g(min_similarity, min_frequency, per_term) AS (VALUES (0.5::DOUBLE, 1000, 3), (0.3, 900, 5), (0.2, 500, 8), (0.1, 300, 10)),
c AS (SELECT min_similarity, min_frequency, per_term, least(term, other) AS a, greatest(term, other) AS b FROM g, pn JOIN fr x USING (term) JOIN fr y ON y.term = other WHERE similarity >= min_similarity AND x.n >= min_frequency AND y.n >= min_frequency AND rank <= per_term)
SELECT g.min_similarity, g.min_frequency, g.per_term, count(DISTINCT (a, b)) FILTER (WHERE a IS NOT NULL) AS pairs FROM g LEFT JOIN c USING (min_similarity, min_frequency, per_term) GROUP BY 1, 2, 3"""
