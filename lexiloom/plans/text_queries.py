"""Queries over pages and documents: cleaning, normalising, sentences, tokens, terms, contexts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import lexicon as lx
from lexiloom.functions import text as tx
from lexiloom.operators import splitter as sp
from lexiloom.operators import terms as te
from lexiloom.plans.inputs import LIKE_SENTENCE, SENT, TERMS, TOK, page_sentences, page_tokens, part_terms, stored_tokens, table, texts
from lexiloom.session import written
from lexiloom.sources.readers import url_parameter


def term_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.term_statistics(page_tokens(spark, sf_dir)).orderBy(F.desc("frequency"), "term")


TERM_CATALOG = f"""WITH {TOK}, good AS (SELECT *, {LIKE_SENTENCE.format("s")} AS g FROM tok),
one AS (SELECT DISTINCT term, doc_id, idx, g FROM good),
freq AS (SELECT term, count(*) AS frequency, count(DISTINCT doc_id) AS document_frequency FROM tok GROUP BY term),
ratio AS (SELECT term, round(avg(g::INT), 4) AS sentence_ratio FROM one GROUP BY term)
SELECT term, frequency, document_frequency, sentence_ratio FROM freq JOIN ratio USING (term)"""


def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = tx.clean_text(F.col("html"), all_entities=False)
    return texts(spark, sf_dir, "pages").select("page_id", text.alias("clean_text")).where(F.length("clean_text") >= 10)


_DROP = "html"
for _t in (*tx.DROP_TAGS, tx.MACRO_TAG):
    _DROP = f"regexp_replace({_DROP}, '(?is)<{_t}\\b.*?</{_t}>', ' ', 'g')"
_DROP = f"regexp_replace({_DROP}, '(?i)</?(?:{'|'.join(tx.BLOCK_TAGS)})\\b[^>]*>', chr(10), 'g')"
_DROP = f"regexp_replace({_DROP}, '<[^>]+>', ' ', 'g')"
for _a, _b in tx.ENTITIES:
    _DROP = f"replace({_DROP}, '{_a}', {'chr(160)' if _a == '&nbsp;' else chr(39) + _b.replace(chr(39), chr(39) * 2) + chr(39)})"
CLEAN_PAGES = f"""WITH t AS (SELECT page_id, regexp_replace(replace(replace(regexp_replace({_DROP}, '[▶◆■□○●▲△★☆※]+', ' ', 'g'), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \\t\\x{{a0}}]+', ' ', 'g') AS x FROM pages),
l AS (SELECT page_id, list_filter(list_transform(string_split(x, chr(10)), lambda y: trim(y)), lambda y: y <> '') AS ls FROM t)
SELECT page_id, array_to_string(ls, chr(10)) AS clean_text FROM l WHERE length(array_to_string(ls, chr(10))) >= 10"""


def pages_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "pages").select("page_id", tx.html_to_markdown(F.col("html")).alias("markdown"))


def pages_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "pages").select("page_id", tx.clean_text(F.col("html")).alias("clean_text"))


def pages_element_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "pages").select("page_id", tx.clean_text(F.col("html"), output="dom").alias("clean_text"))


def documents_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents").select("doc_id", tx.markdown_to_storage(F.col("text")).alias("storage"))


def page_url_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "pages").select("page_id", url_parameter(F.col("url"), "page").alias("page"))


PAGE_URL_PARAM = r"""SELECT page_id, CASE WHEN regexp_matches(url, '\?([^#]*&)?page=') THEN regexp_extract(url, '\?(?:[^#]*&)?page=([^&#]*)', 1) END AS page FROM pages"""


def _replaced(spark: SparkSession, sf_dir: str, made) -> DataFrame:
    return texts(spark, sf_dir, "documents").select("doc_id", made(F.col("text")).alias("normalized"))


def normalize_url_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, lambda c: tx.normalize_emails(tx.normalize_urls(c)))


NORMALIZE_URL_EMAIL = r"""SELECT doc_id, regexp_replace(regexp_replace(text, '(?i)\bhttps?://[^\s<>"'']+|\bwww\.[^\s<>"'']+', '<URL>', 'g'), '\b[\w.+-]+@[\w-]+\.[\w.-]+\b', '<EMAIL>', 'g') AS normalized FROM documents"""


def normalize_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, tx.normalize_times)


_CLOCK = r"regexp_replace({0}, '(^|[^0-9:])(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9])?($|[^0-9:])', '\1<TIME>\2', 'g')"
NORMALIZE_TIME = f"SELECT doc_id, {_CLOCK.format(_CLOCK.format('text'))} AS normalized FROM documents"


def normalize_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, tx.normalize_numbers)


#: A word boundary is the same as the two lookarounds where no underscore stands beside a number.
NORMALIZE_NUMBER = r"SELECT doc_id, regexp_replace(text, '\b[0-9]{2,}(?:,[0-9]{3})*(?:\.[0-9]+)?\b', '<NUMBER>', 'g') AS normalized FROM documents"


def normalize_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, tx.normalize_text)


_URLS = r"""regexp_replace(regexp_replace(text, '(?i)\bhttps?://[^\s<>"'']+|\bwww\.[^\s<>"'']+', '<URL>', 'g'), '\b[\w.+-]+@[\w-]+\.[\w.-]+\b', '<EMAIL>', 'g')"""
_YEAR, _LEAP = "(?:199[0-9]|20[0-9][0-9]|2100)", "(?:199[26]|20(?:[02468][048]|[13579][26]))"
_LONG_DATE = "|".join(
    [f"{_YEAR}[-./]{m}[-./]{d}" for m, d in (("(?:0?[13578]|1[02])", "(?:0?[1-9]|[12][0-9]|3[01])"), ("(?:0?[469]|11)", "(?:0?[1-9]|[12][0-9]|30)"), ("0?2", "(?:0?[1-9]|1[0-9]|2[0-8])"))] + [f"{_LEAP}[-./]0?2[-./]29"]
)
_SHORT_DATE = f"{_YEAR}(?:(?:0[13578]|1[02])(?:0[1-9]|[12][0-9]|3[01])|(?:0[469]|11)(?:0[1-9]|[12][0-9]|30)|02(?:0[1-9]|1[0-9]|2[0-8]))|{_LEAP}0229"
_SHORT = rf"regexp_replace({{0}}, '(^|[^0-9A-Za-z])(?:{_SHORT_DATE})($|[^0-9A-Za-z])', '\1<DATE>\2', 'g')"
_DATED = _SHORT.format(_SHORT.format(rf"regexp_replace({_URLS}, '\b(?:{_LONG_DATE})\b', '<DATE>', 'g')"))
NORMALIZE_NATIVE = rf"SELECT doc_id, regexp_replace({_CLOCK.format(_CLOCK.format(_DATED))}, '\b[0-9]{{2,}}(?:,[0-9]{{3}})*(?:\.[0-9]+)?\b', '<NUMBER>', 'g') AS normalized FROM documents"


def normalize_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir, tx.normalize_protected)


#: Protected spans as one pattern; a span gets a character of its own (of the private use area), unless it is a date.
_SPAN = r"(?:[A-Za-z]*[A-Z]{2}[0-9]+(?:\.[0-9]+)+|[A-Za-z]*(?:[A-Z]{2}[0-9]+|K8s)(?:[A-Za-z]+[0-9]+(?:\.[0-9]+)*)*[A-Za-z]*|[A-Za-z]+[0-9]+(?:\.[0-9]+)*|[0-9]+(?:\.[0-9]+)+)+"
NORMALIZE_FULL = rf"""WITH p AS (SELECT doc_id, string_split_regex(text, '{_SPAN}') AS gaps, regexp_extract_all(text, '{_SPAN}') AS held FROM documents),
h AS (SELECT doc_id, held, array_to_string(list_transform(gaps, lambda g, i: g || CASE WHEN i > len(held) THEN '' WHEN regexp_full_match(held[i], '{_LONG_DATE}') THEN held[i] ELSE chr(57344 + i::INT) END), '') AS text FROM p),
n AS (SELECT doc_id, held, regexp_replace({_CLOCK.format(_CLOCK.format(_DATED))}, '\b[0-9]{{2,}}(?:,[0-9]{{3}})*(?:\.[0-9]+)?\b', '<NUMBER>', 'g') AS text FROM h),
r AS (SELECT doc_id, held, string_split_regex(text, '[\x{{E000}}-\x{{F8FF}}]') AS gaps, regexp_extract_all(text, '[\x{{E000}}-\x{{F8FF}}]') AS ids FROM n)
SELECT doc_id, array_to_string(list_transform(gaps, lambda g, i: g || CASE WHEN i > len(ids) THEN '' ELSE held[unicode(ids[i]) - 57344] END), '') AS normalized FROM r"""


def placeholder_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = tx.normalize_times(tx.normalize_emails(tx.normalize_urls(F.col("text"))))
    rows = texts(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(text, F.lit("(<(?:URL|EMAIL|TIME)>)"), F.lit(1))).alias("placeholder"))
    return rows.groupBy("placeholder").agg(F.count(F.lit(1)).alias("n"))


PLACEHOLDER_COUNTS = rf"""WITH t AS (SELECT regexp_replace(regexp_replace(text, '(?i)\bhttps?://[^\s<>"'']+|\bwww\.[^\s<>"'']+', '<URL>', 'g'), '\b[\w.+-]+@[\w-]+\.[\w.-]+\b', '<EMAIL>', 'g') AS x FROM documents),
u AS (SELECT {_CLOCK.format(_CLOCK.format("x"))} AS y FROM t)
SELECT placeholder, count(*) AS n FROM (SELECT unnest(regexp_extract_all(y, '<(?:URL|EMAIL|TIME)>')) AS placeholder FROM u) GROUP BY 1"""


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_sentences(spark, sf_dir)


SENTENCES = f"WITH {SENT} SELECT doc_id AS page_id, idx::INT AS sentence_index, s AS sentence FROM sent"


def sentence_guard_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guards that the texts have, so that pieces are put back."""
    return te.sentences(texts(spark, sf_dir, "documents"), "doc_id", None, "text", guards=("the", "la", "de", "der"))


def sentence_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.sentences(texts(spark, sf_dir, "documents"), "doc_id", None, "text", max_length=80)


def _folded_sentences(guards: tuple[str, ...], most: int) -> str:
    """Sentences with guards and a length limit: both are folds over a list, from its first entry on."""
    guard = "(?:" + "|".join(guards) + ")[. ]*$"
    return rf"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM documents),
cut AS (SELECT doc_id, ln, string_split(regexp_replace(line, '([.!?…])(\s)', '\1' || chr(1) || '\2', 'g'), chr(1)) AS ps FROM lines),
bare AS (SELECT doc_id, ln, list_filter(list_transform(ps, lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS ps FROM cut),
joined AS (SELECT doc_id, ln, list_reduce(list_transform(ps, lambda x: [x]), lambda acc, x: CASE WHEN regexp_matches(acc[-1], '{guard}') THEN list_concat(acc[1:len(acc) - 1], [acc[-1] || ' ' || x[1]]) ELSE list_concat(acc, x) END) AS ps FROM bare WHERE len(ps) > 0),
tidy AS (SELECT doc_id, ln, list_transform(ps, lambda x: regexp_replace(x, '\s+', ' ', 'g')) AS ps FROM joined),
one AS (SELECT doc_id, ln, unnest(ps) AS s, generate_subscripts(ps, 1) AS pn FROM tidy),
chunk AS (SELECT doc_id, ln, pn, CASE WHEN length(s) <= {most} THEN [s] ELSE list_reduce(list_transform(string_split(s, ' '), lambda w: [w]), lambda acc, w: CASE WHEN length(acc[-1]) + length(w[1]) + 1 > {most} AND acc[-1] <> '' THEN list_concat(acc, w) ELSE list_concat(acc[1:len(acc) - 1], [trim(acc[-1] || ' ' || w[1])]) END) END AS cs FROM one),
flat AS (SELECT doc_id, ln, pn, unnest(cs) AS s, generate_subscripts(cs, 1) AS cn FROM chunk)
SELECT doc_id AS page_id, (row_number() OVER (PARTITION BY doc_id ORDER BY ln, pn, cn) - 1)::INT AS sentence_index, s AS sentence FROM flat WHERE length(s) >= 4 AND regexp_matches(s, '[0-9A-Za-z가-힣]')"""


SENTENCE_GUARD_MERGE = _folded_sentences(("the", "la", "de", "der"), 400)
SENTENCE_CHUNKS = _folded_sentences(tx.GUARDS, 80)


def sentence_likeness_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = page_sentences(spark, sf_dir).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(tx.looks_like_sentence(F.col("sentence"))).alias("good"))
    return rows.select("page_id", "n", F.round(F.col("good") / F.col("n"), 4).alias("ratio"))


SENTENCE_LIKENESS_RATIO = f"WITH {SENT} SELECT doc_id AS page_id, count(*) AS n, round(avg({LIKE_SENTENCE.format('s')}::INT), 4) AS ratio FROM sent GROUP BY 1"


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = page_tokens(spark, sf_dir).select("page_id", "sentence_index", F.posexplode("tokens").alias("pos", "token"))
    return rows.withColumn("tag", tx.token_tag(F.col("token")))


TOKENS = f"WITH {TOK} SELECT doc_id AS page_id, idx::INT AS sentence_index, (pos - 1)::INT AS pos, term AS token, CASE WHEN regexp_matches(term, '^[A-Za-z][A-Za-z0-9]*$') THEN 'SL' ELSE 'NNG' END AS tag FROM tok"


def corpus_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.corpus(page_tokens(spark, sf_dir)).select("page_id", "sentence_index", F.array_join("tokens", " ").alias("line"))


CORPUS_SENTENCES = f"WITH {TOK} SELECT doc_id AS page_id, idx::INT AS sentence_index, string_agg(term, ' ' ORDER BY pos) AS line FROM tok GROUP BY 1, 2 HAVING count(*) >= 2"


def verb_only_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.concat_ws("-", F.get_json_object("props", "$.k"), "user_id")
    events = table(spark, sf_dir, "events").withColumn("k", token)
    return te.verb_only(events, "k", F.col("event_type").isin("click", "view", "signup", "purchase"))


VERB_ONLY_TOKENS = "SELECT concat_ws('-', json_extract_string(props, '$.k'), user_id) AS token FROM events GROUP BY 1 HAVING bool_and(event_type IN ('click', 'view', 'signup', 'purchase'))"


def bigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.phrase_scores(stored_tokens(spark, sf_dir), min_count=5, threshold=10.0, rounded=4)


_BIGRAM = """, nx AS (SELECT *, lead(term) OVER (PARTITION BY doc_id, idx ORDER BY pos) AS nxt FROM tok),
uni AS (SELECT term, count(*) AS n FROM tok GROUP BY 1), bi AS (SELECT term AS a, nxt AS b, count(*) AS n FROM nx WHERE nxt IS NOT NULL GROUP BY 1, 2),
sz AS (SELECT (SELECT count(*) FROM uni) + (SELECT count(*) FROM bi) AS v),
scored AS (SELECT a, b, bi.n, (bi.n - 5)::DOUBLE / (ua.n::DOUBLE * ub.n) * v AS sc FROM bi JOIN uni ua ON a = ua.term JOIN uni ub ON b = ub.term, sz WHERE bi.n >= 5),
phrase AS (SELECT a, b, n, round(sc, 4) AS score FROM scored WHERE sc > 10)"""
BIGRAM_SCORES = f"WITH {TOK}{_BIGRAM} SELECT * FROM phrase"


def phrase_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_tokens(spark, sf_dir)
    phrases = written(spark)(te.phrase_scores(rows, min_count=5, threshold=10.0), "phrases")
    merged = te.merged_tokens(rows, phrases, ["page_id", "sentence_index"])
    return merged.select("page_id", "sentence_index", F.posexplode("tokens").alias("pos", "word"))


PHRASE_MERGE = f"""WITH {TOK}{_BIGRAM}, f AS (SELECT nx.*, phrase.a IS NOT NULL AS hit FROM nx LEFT JOIN phrase ON nx.term = a AND nxt = b),
i AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, idx, hit ORDER BY pos) AS island FROM f),
r AS (SELECT *, hit AND (row_number() OVER (PARTITION BY doc_id, idx, hit, island ORDER BY pos) - 1) % 2 = 0 AS merge FROM i),
g AS (SELECT *, coalesce(lag(merge) OVER (PARTITION BY doc_id, idx ORDER BY pos), false) AS gone FROM r)
SELECT doc_id AS page_id, idx::INT AS sentence_index, (row_number() OVER (PARTITION BY doc_id, idx ORDER BY pos) - 1)::INT AS pos, CASE WHEN merge THEN term || '_' || nxt ELSE term END AS word FROM g WHERE NOT gone"""


def term_contexts_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.context_places(page_tokens(spark, sf_dir)).select("term", "rank", F.col("page_id").cast("string").alias("page_id"), "sentence_index")


def _contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.term_contexts(written(spark)(page_tokens(spark, sf_dir).select("page_id", "sentence_index", "sentence", "tokens"), "tokens"))


_CTX = """, once AS (SELECT DISTINCT term, doc_id::VARCHAR AS page_id, idx, s FROM tok),
ctx AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY page_id, idx) AS rank FROM once QUALIFY rank <= 50)"""
TERM_CONTEXTS_TOP50 = f"WITH {TOK}{_CTX} SELECT term, rank::INT AS rank, page_id, idx::INT AS sentence_index FROM ctx"


def context_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _contexts(spark, sf_dir)
    return rows.select("term", "page_id", "sentence_index", tx.pattern_signature(F.col("sentence"), F.col("term")).alias("signature"))


_SIG = r"""lower(array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(replace(replace(s, term, ' '), replace(term, '_', ' '), ' '), '<[A-Z]+>', ' ', 'g'), '[^0-9A-Za-z가-힣<>_ ]+', ' ', 'g'), '[0-9]+', ' ', 'g'), ' '), lambda x: x <> '')[1:8], ' '))"""
CONTEXT_SIGNATURES = f"WITH {TOK}{_CTX} SELECT term, page_id, idx::INT AS sentence_index, {_SIG} AS signature FROM ctx"


def pattern_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.pattern_counts(_contexts(spark, sf_dir))


PATTERN_COUNTS = f"WITH {TOK}{_CTX}, g AS (SELECT term, {_SIG} AS sig FROM ctx) SELECT term, count(DISTINCT sig) FILTER (WHERE sig <> '') AS patterns FROM g GROUP BY 1"


def contexts_diversified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return te.diversified(_contexts(spark, sf_dir))


def _picked(start: str, full: str) -> str:
    seen = "(x[1].sig <> '' AND len(list_filter(acc, lambda y: y.sig = x[1].sig)) > 0)"
    return f"list_reduce(list_transform(rows, lambda x: [x]), lambda acc, x: CASE WHEN len(acc) >= 5 OR {seen} OR {full} THEN acc ELSE list_concat(acc, x) END, {start})"


CONTEXTS_DIVERSIFIED = f"""WITH {TOK}{_CTX}, signed AS (SELECT term, page_id, idx, s, {_SIG} AS sig FROM ctx),
listed AS (SELECT term, list({{'page_id': page_id, 'idx': idx, 's': s, 'sig': sig}} ORDER BY page_id, idx) AS rows FROM signed GROUP BY term),
first AS (SELECT term, rows, {_picked("rows[1:0]", "len(list_filter(acc, lambda y: y.page_id = x[1].page_id)) >= 2")} AS acc0 FROM listed),
both_passes AS (SELECT term, {_picked("acc0", "len(list_filter(acc, lambda y: y.page_id = x[1].page_id AND y.idx = x[1].idx)) > 0")} AS picked FROM first),
flat AS (SELECT term, unnest(picked) AS c, generate_subscripts(picked, 1) AS k FROM both_passes)
SELECT term, (k - 1)::INT AS rank, c.page_id AS page_id, c.idx::INT AS sentence_index, c.s AS sentence FROM flat"""


def indexable_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of texts with placeholders, which are no terms, as stopwords are none."""
    docs = texts(spark, sf_dir).select("doc_id", tx.normalize_times(F.col("text")).alias("text"))
    rows = te.tokenized(te.sentences(docs, "doc_id", None, "text", max_length=1 << 30, guards=()))
    return te.term_statistics(rows, stopwords=("the", "de", "la", "der")).select("term", "frequency", "document_frequency")


INDEXABLE_TERMS = f"""WITH documents AS (SELECT doc_id, normalized AS text FROM ({NORMALIZE_TIME.replace("FROM documents", "FROM main.documents")})), {TOK},
apart AS (SELECT doc_id, idx, list_filter(list_transform(string_split(regexp_replace(s, '(<[A-Z]+>)', ' \1 ', 'g'), ' '), lambda x: CASE WHEN x IN ('<DATE>', '<TIME>', '<NUMBER>', '<URL>', '<EMAIL>') THEN x ELSE trim(x, '.,!?()[]{{}}"''·') END), lambda x: x <> '') AS words FROM sent),
term AS (SELECT doc_id, unnest(words) AS term FROM apart)
SELECT term, count(*) AS frequency, count(DISTINCT doc_id) AS document_frequency FROM term WHERE term NOT IN ('<DATE>', '<TIME>', '<NUMBER>', '<URL>', '<EMAIL>', 'the', 'de', 'la', 'der') GROUP BY 1"""


def eligibility_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = te.term_statistics(page_tokens(spark, sf_dir))
    stop = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct().union(spark.createDataFrame([("the",), ("de",), ("la",)], "word string"))
    return te.annotated(stats, stop, min_ratio=0.5).select("term", "is_stopword", "excluded_reason")


ELIGIBILITY_REASONS = f"""{TERM_CATALOG.replace("SELECT term, frequency, document_frequency, sentence_ratio FROM freq JOIN ratio USING (term)", "").rstrip()},
stop AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part UNION SELECT unnest(['the', 'de', 'la'])),
j AS (SELECT freq.term, sentence_ratio, word IS NOT NULL AS is_stopword, list_filter(regexp_split_to_array(freq.term, '[_ ]'), lambda x: x <> '') AS parts FROM freq JOIN ratio USING (term) LEFT JOIN stop ON freq.term = word)
SELECT term, is_stopword, CASE WHEN term IN ('<DATE>', '<TIME>', '<NUMBER>', '<URL>', '<EMAIL>') THEN 'placeholder' WHEN is_stopword THEN 'stopword' WHEN NOT regexp_matches(term, '[0-9A-Za-z가-힣]') THEN 'no meaning'
  WHEN sentence_ratio < 0.5 THEN 'no sentence' WHEN regexp_matches(replace(term, '_', ' '), '^[0-9]+\\s*(%)$') THEN 'measure'
  WHEN length(term) < 2 AND NOT regexp_matches(term, '^[A-Z][A-Z0-9]{{0,7}}$') THEN 'too short' ELSE '' END AS excluded_reason FROM j"""


#: Terms that part names don't have: placeholders, broken phrases, measures, and one-letter terms.
ODD_TERMS = ("<DATE>", "<NUMBER>", "매장_가", "가_매장", "매장_오픈", "12 개", "3차", "-_-", "x", "X")


def eligibility_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names and odd terms, with verbs: every reason occurs."""
    odd = spark.createDataFrame([(t, 7) for t in ODD_TERMS], "term string, frequency long")
    terms = part_terms(spark, sf_dir).unionByName(odd).withColumn("sentence_ratio", (F.col("frequency") % 10) / 10.0)
    verbs = table(spark, sf_dir, "part").where("p_size <= 10").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("token")).where("token < 'c'").distinct()
    return te.annotated(terms, None, verbs, min_ratio=0.3).select("term", "excluded_reason")


ELIGIBILITY_MARKED = f"""WITH {TERMS}, verbs AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS token FROM part WHERE p_size <= 10 AND split_part(p_name, ' ', 2) < 'c'),
every AS (SELECT term, frequency FROM terms UNION ALL SELECT unnest({list(ODD_TERMS)}), 7),
j AS (SELECT term, (frequency % 10) / 10.0::DOUBLE AS ratio, list_filter(regexp_split_to_array(term, '[_ ]'), lambda x: x <> '') AS parts FROM every)
SELECT term, CASE WHEN term IN ('<DATE>', '<TIME>', '<NUMBER>', '<URL>', '<EMAIL>') THEN 'placeholder' WHEN NOT regexp_matches(term, '[0-9A-Za-z가-힣]') THEN 'no meaning' WHEN ratio < 0.3 THEN 'no sentence'
  WHEN term IN (SELECT token FROM verbs) OR parts[-1] IN (SELECT token FROM verbs) THEN 'verb stem'
  WHEN len(parts) >= 2 AND (len(list_filter(parts[1:len(parts) - 1], lambda p: regexp_matches(p, '^[가-힣]$'))) > 0 OR parts[-1] IN {te.END_PARTICLES}) THEN 'malformed'
  WHEN regexp_matches(replace(term, '_', ' '), '{te.MEASURE}') THEN 'measure' WHEN length(term) < 2 AND NOT regexp_matches(term, '^[A-Z][A-Z0-9]{{0,7}}$') THEN 'too short' ELSE '' END AS excluded_reason FROM j"""


def labels_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir, "documents")
    date = F.concat((F.col("doc_id") % 5 + 2020).cast("string"), F.lit("-01-01"))
    labels = tx.label_list(F.lit("Wiki Page"), F.col("source"), F.array(F.lower("lang"), F.col("source"), F.lit("X y")), date, F.col("doc_id") % 7 == 0)
    return docs.select("doc_id", F.array_join(labels, ",").alias("labels"))


LABELS_SLUG = """WITH l AS (SELECT doc_id, ['wiki-page', lower(source), lower(lang), (doc_id % 5 + 2020)::VARCHAR] AS a, doc_id % 7 = 0 AS d FROM documents)
SELECT doc_id, array_to_string(CASE WHEN d THEN list_append(a, 'deprecated') ELSE a END, ',') AS labels FROM l"""


def removal_suggestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexiloom.functions.policy import removal_hint

    return part_terms(spark, sf_dir).select("term", removal_hint(F.col("term"), F.col("frequency") % 4, F.col("frequency")).alias("hint"))


REMOVAL_SUGGESTION = f"""WITH {TERMS}, d AS (SELECT *, replace(term, '_', ' ') AS shown FROM terms)
SELECT term, CASE WHEN length(replace(shown, ' ', '')) <= 1 THEN 'one character' WHEN regexp_matches(shown, '^[A-Za-z][A-Za-z0-9]*$') AND shown = lower(shown) THEN 'field name'
  WHEN regexp_matches(shown, '^[A-Za-z][A-Za-z0-9]*$') AND shown = upper(shown) THEN 'code value' WHEN frequency % 4 <= 1 AND frequency >= 5 THEN 'repeated phrase' ELSE '' END AS hint FROM d"""


def abbreviation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.abbreviation_scores(texts(spark, sf_dir)).withColumn("score", F.round("score", 3))


ABBREVIATION_SCORES = r"""WITH t AS (SELECT unnest(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '')) AS t FROM documents),
e AS (SELECT lower(regexp_replace(t, '\.$', '')) AS word, t LIKE '%.' AS stop, regexp_matches(t, '^\p{L}+(\.\p{L}+)*\.?$') AS fine FROM t),
a AS (SELECT count(*) AS total, count_if(stop) AS stops FROM e),
w AS (SELECT word, count(*) AS n, count_if(stop) AS stopped FROM e WHERE fine GROUP BY 1 HAVING count_if(stop) > 0 AND word <> ''),
l AS (SELECT *, length(regexp_replace(word, '[^.]', '', 'g')) AS inside, n - stopped AS open, stops::DOUBLE / total AS p FROM w, a)
SELECT word, n::BIGINT AS n, stopped::BIGINT AS stopped, round(-2 * ((stopped * ln(p) + open * ln(1 - p)) - (stopped * ln(0.99) + open * ln(1 - 0.99)))
  * exp(-(length(word) - inside)::DOUBLE) * (inside + 1) * pow((length(word) - inside)::DOUBLE, -open::DOUBLE), 3) + 0.0 AS score FROM l"""


def lexicon_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often documents have the dictionary's phrases: the first three words of each benchmark text."""
    words = table(spark, sf_dir, "benchmark").select(F.array_join(F.slice(F.split("text", " "), 1, 3), " ").alias("w")).distinct()
    lexicon = lx.Lexicon(r["w"] for r in words.collect())  # a dictionary is held by the driver
    found = texts(spark, sf_dir).select(F.explode(lx.matches(F.col("text"), lexicon)).alias("m"))
    return found.groupBy(F.col("m.word").alias("word")).agg(F.count(F.lit(1)).alias("n"))


LEXICON_MATCHES = r"""WITH d AS (SELECT DISTINCT array_to_string(string_split(text, ' ')[1:3], ' ') AS word FROM benchmark),
f AS (SELECT word, sum(len(regexp_extract_all(text, '(?:^|[^\p{L}\p{N}])' || regexp_escape(word)))) AS n FROM documents, d WHERE contains(text, word) GROUP BY 1)
SELECT word, n::BIGINT AS n FROM f WHERE n > 0"""
