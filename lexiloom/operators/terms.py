"""Sentences, tokens, phrases, term catalogue and evidence contexts as DataFrame operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lexiloom.functions import text as tx
from lexiloom.session import written

# --- Fixed values: what disqualifies a term, and why ---
REASONS = {"placeholder": "placeholder", "stopword": "stopword", "meaning": "no meaning", "ratio": "no sentence", "verb": "verb stem", "malformed": "malformed", "measure": "measure", "short": "too short"}
END_PARTICLES = ("로", "을", "를", "이", "가", "은", "는", "에", "의", "와", "과", "도", "만", "서", "고", "나", "며", "야", "라", "죠", "함", "됨", "임", "음")
MEASURE = r"^\d+\s*(년|월|일|시|분|초|개|건|명|원|만원|주|회|차|번|배|위|%)$"
ABBREVIATION = "^[A-Z][A-Z0-9]{0,7}$"
# --- end of fixed values ---


def sentences(docs: DataFrame, id_col: str = "page_id", title_col: str | None = None, text_col: str = "clean_text", **options: object) -> DataFrame:
    """(page_id, sentence_index, sentence) of pages; narrow, no shuffle."""
    title = F.col(title_col) if title_col else None
    return docs.select(F.col(id_col).alias("page_id"), F.posexplode(tx.document_sentences(title, F.col(text_col), **options)).alias("sentence_index", "sentence"))


def tokenized(rows: DataFrame, stopwords: Sequence[str] = (), min_length: int = 1) -> DataFrame:
    """Adds tokens to sentences; those without any go."""
    # as a generator's output, tokens are made once and not again for the filter
    made = F.explode(F.array(tx.fallback_tokens(F.col("sentence"), stopwords, min_length)))
    return rows.select(*[c for c in rows.columns if c != "tokens"], made.alias("tokens")).where(F.size("tokens") > 0)


#: Kinds of morphemes that a morphological analyser's tokens are kept of, and those that are stems.
KEPT_TAGS = ("NNG", "NNP", "SL", "SH", "VV", "VA", "XR")
STEM_TAGS = ("VV", "VA")


def tagged(rows: DataFrame, analyser: Callable[[list[str]], list[list[tuple[str, str]]]], text: str = "sentence") -> DataFrame:
    """Adds tagged, an array of (token, tag), what ``analyser`` gives for a batch of sentences, and tag_error. A
    batch that fails is tried by sentences; one that can't be read has no tokens, and the error."""

    @F.arrow_udf("struct<tagged:array<struct<token:string,tag:string>>,tag_error:string>")
    def of(texts: pa.Array) -> pa.Array:
        asked = [t or "" for t in texts.to_pylist()]
        try:
            out = [(told, None) for told in analyser(asked)]
            if len(out) != len(asked):
                raise ValueError(f"{len(out)} answers for {len(asked)} sentences")
        except Exception:  # noqa: BLE001  each by itself: the sentence is left out, the others go on
            out = [_tried(analyser, t) for t in asked]
        each = pa.array([[{"token": m, "tag": g} for m, g in told] for told, _ in out], pa.list_(pa.struct([("token", pa.string()), ("tag", pa.string())])))
        return pa.StructArray.from_arrays([each, pa.array([e for _, e in out], pa.string())], names=["tagged", "tag_error"])

    rest = [c for c in rows.columns if c not in ("tagged", "tag_error")]
    return rows.select(*rest, of(F.col(text)).alias("__t")).select(*rest, "__t.*")


def _tried(analyser: Callable[[list[str]], list[list[tuple[str, str]]]], text: str) -> tuple[list[tuple[str, str]], str | None]:
    try:
        return analyser([text])[0], None
    except Exception as e:  # noqa: BLE001  the row carries it
        return [], f"{type(e).__name__}: {e}"[:500]


def kept_tokens(tagged: Column, tags: Sequence[str] = KEPT_TAGS, stopwords: Sequence[str] = (), min_length: int = 1, min_stem: int = 2, delimiter: str = "_") -> Column:
    """Tokens of the kept kinds, without stopwords, short ones and short stems; blanks within one are the delimiter."""
    own = F.transform(tagged, lambda x: F.struct(F.btrim(x["token"]).alias("token"), F.upper(x["tag"]).alias("tag")))
    long = lambda x: (F.length(x["token"]) >= min_length) & (~x["tag"].isin(*STEM_TAGS) | (F.length(x["token"]) >= min_stem))
    own = F.filter(own, lambda x: x["tag"].isin(*tags) & (x["token"] != "") & long(x) & ~x["token"].isin(*stopwords))
    return F.transform(own, lambda x: F.regexp_replace(x["token"], r"\s+", delimiter))


def corpus(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Sentences of at least two tokens."""
    return rows.where(F.size(tokens) >= 2)


def verb_only(tagged: DataFrame, token: str, is_verb: Column) -> DataFrame:
    """Tokens that are seen as verbs only."""
    return tagged.groupBy(F.col(token).alias("token")).agg(F.bool_and(is_verb).alias("verb")).where("verb").select("token")


def indexable(tokens: Column, stopwords: Sequence[str] = ()) -> Column:
    """The tokens that may be terms: no placeholders, stopwords or blanks."""
    return F.filter(tokens, lambda t: ~t.isin(*tx.PLACEHOLDERS, *stopwords) & (F.btrim(t) != ""))


def term_statistics(rows: DataFrame, tokens: str = "tokens", shown: str = "sentence", stopwords: Sequence[str] = ()) -> DataFrame:
    """(term, frequency, document_frequency, sentence_ratio) of indexable tokens. A sentence gives a row for each distinct
    token with its count, so nothing is deduplicated by a shuffle; sums go page first, then term."""
    told = rows.select("page_id", indexable(F.col(tokens), stopwords).alias("all"), tx.looks_like_sentence(F.col(shown)).cast("long").alias("good"))  # once for a sentence
    each = told.select("page_id", "all", "good", F.explode(F.array_distinct("all")).alias("term"))
    each = each.withColumn("n", F.size("all") - F.size(F.array_remove("all", F.col("term"))))
    page = each.groupBy("term", "page_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("found"), F.sum("good").alias("good"))
    term = page.groupBy("term").agg(F.sum("n").alias("frequency"), F.count(F.lit(1)).alias("document_frequency"), F.sum("good").alias("good"), F.sum("found").alias("found"))
    return term.select("term", "frequency", "document_frequency", F.round(F.col("good") / F.col("found"), 4).alias("sentence_ratio"))


# ---------------------------------------------------------------- phrases
def word_counts(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    return rows.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs of an array, as structs a, b."""
    rest = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(F.slice(tokens, F.lit(1), rest).alias("a"), F.slice(tokens, F.lit(2), rest).alias("b"))


#: Words that a task counts the pairs of at once; pairs of a bucket at most, on average, which one task sums.
CHUNK, BUCKET = 1 << 20, 1 << 20
#: Buckets that the pairs of one first word go to; what a chunk's pairs of a bucket are sent as: a first word stands once.
DEALT, LAID_OUT = 32, ("text_a", "size_a", "text_b", "size_b", "times", "n")


def pair_counts(rows: DataFrame, tokens: str, min_count: int) -> DataFrame:
    """(a, b, n) of adjacent pairs found often enough; a row without a and b has how many there are in all of a bucket. Pairs
    are counted in chunks, and what is shuffled is a chunk's pairs of a bucket, in order and compressed."""
    total = rows.agg(F.sum(F.greatest(F.size(tokens) - 1, F.lit(0)))).first()[0] or 0
    buckets = -(-total // BUCKET) or 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def given() -> Iterator[pa.RecordBatch]:
            lists = pa.concat_arrays(held)
            held.clear()
            words = lists.flatten().dictionary_encode()
            place = first_of_pairs(lists)
            if not place.size:
                return
            code = words.indices.to_numpy().astype(np.int64)
            pair, n = np.unique(code[place] << 32 | code[place + 1], return_counts=True)
            a, b = pair >> 32, pair & 0xFFFFFFFF
            hashed = pd.util.hash_array(words.dictionary.to_numpy(zero_copy_only=False))
            bucket = ((hashed[a] // np.uint64(DEALT) + hashed[b] % np.uint64(DEALT)) % np.uint64(buckets)).astype(np.int32)
            rank = np.empty(len(hashed), np.int64)
            rank[pc.sort_indices(words.dictionary).to_numpy()] = np.arange(rank.size)
            order = np.lexsort((rank[b], rank[a], bucket))
            names, starts = np.unique(bucket[order], return_index=True)
            for at, own in zip(names, np.split(order, starts[1:]), strict=True):
                first = np.flatnonzero(np.diff(a[own], prepend=-1))
                times = np.diff(first, append=own.size)
                texts = (_laid_out(words.dictionary.take(pa.array(x))) for x in (a[own][first], b[own]))
                row = pa.table({name: [x] for name, x in zip(LAID_OUT, (*(y for x in texts for y in x), times, n[own]), strict=True)})
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(row)
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["bucket", "pairs"])

        size = 0
        for batch in batches:
            held.append(batch.column(0))
            size += len(batch.column(0).flatten())
            if size >= CHUNK:
                yield from given()
                size = 0
        if size:
            yield from given()

    def summed(group: pa.Table) -> pa.Table:
        parts = []
        for x in group.column("pairs"):
            row = pa.ipc.open_stream(x.as_buffer()).read_all()
            text_a, size_a, text_b, size_b, times, n = (row.column(c)[0] for c in LAID_OUT)
            a = _as_words(text_a, size_a).take(pa.array(np.repeat(np.arange(len(times)), times.values.to_numpy())))
            parts.append(pa.table({"a": a, "b": _as_words(text_b, size_b), "n": n.values}))
        pairs = pa.concat_tables(parts).group_by(["a", "b"]).aggregate([("n", "sum")]).select(["a", "b", "n_sum"]).rename_columns(["a", "b", "n"])
        often = pairs.filter(pc.greater_equal(pairs["n"], min_count))
        return pa.concat_tables([often, pa.table({"a": [None], "b": [None], "n": [pairs.num_rows]}, schema=often.schema)])

    return rows.select(tokens).mapInArrow(count, "bucket int, pairs binary").groupBy("bucket").applyInArrow(summed, "a string, b string, n long")


def _laid_out(words: pa.Array) -> tuple[bytes, np.ndarray]:
    """The words behind each other, and their lengths, which compress better than Arrow's own places."""
    return b"".join(words.cast(pa.binary()).to_pylist()), pc.binary_length(words).to_numpy()


def _as_words(text: pa.Scalar, sizes: pa.Scalar) -> pa.Array:
    size = sizes.values.to_numpy()
    places = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(size.size, pa.py_buffer(places), text.as_buffer())


def first_of_pairs(lists: pa.Array) -> np.ndarray:
    """Places of the words of all lists that have another one behind them in their list."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    more = np.ones(size.sum(), bool)
    more[np.cumsum(size)[size > 0] - 1] = False
    return np.flatnonzero(more)


def phrase_scores(rows: DataFrame, tokens: str = "tokens", min_count: int = 5, threshold: float = 10.0, rounded: int = 6) -> DataFrame:
    """(a, b, n, score) of pairs found often enough and scoring above the threshold.
    score = (n - min_count) / (n(a) n(b)) * (distinct words + distinct pairs). Of both counts only what is found often is
    written, for no word is rarer than a pair with it; the others go into the sizes."""
    put = written(rows.sparkSession)
    seen = Observation()
    words = put(word_counts(rows, tokens).observe(seen, F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count), "words")
    pairs = put(pair_counts(rows, tokens, min_count), "pairs")
    size = seen.get["n"] + (pairs.where("a is null").agg(F.sum("n")).first()[0] or 0)
    often = pairs.where("a is not null")
    joined = often.join(words.select(F.col("word").alias("a"), F.col("n").alias("na")), "a").join(words.select(F.col("word").alias("b"), F.col("n").alias("nb")), "b")
    score = (F.col("n") - min_count).cast("double") / (F.col("na").cast("double") * F.col("nb")) * size
    return joined.withColumn("score", score).where(F.col("score") > threshold).select("a", "b", "n", F.round("score", rounded).alias("score"))


#: Phrases that could be sent to every executor as rows, at most; so many times as many are sent as two numbers each, beside a
#: list of their words. More of them are joined by a shuffle.
MOST_SENT, AS_NUMBERS = 200_000, 16


def merged_tokens(rows: DataFrame, phrases: DataFrame, key: Sequence[str], tokens: str = "tokens", delimiter: str = "_") -> DataFrame:
    """(key, tokens) of sentences with phrases (a, b) merged greedily from the left: a sentence takes every place that its last
    one left free. Phrases go to every task if they are few enough, and nothing is shuffled. Else the places of
    phrases are, not the words."""
    if phrases.count() <= AS_NUMBERS * MOST_SENT:
        return _merged_by_list(rows, phrases.select("a", "b").distinct().toArrow(), key, tokens, delimiter)
    known = phrases.select(F.struct("a", "b").alias("p"))
    places = rows.select(*key, F.posexplode(bigrams(F.col(tokens))).alias("at", "p")).join(known, "p", "left_semi")
    places = places.groupBy(*key).agg(F.sort_array(F.collect_list("at")).alias("at"))

    def step(taken: Column, at: Column) -> Column:
        return F.when(F.coalesce(F.try_element_at(taken, F.lit(-1)), F.lit(-2)) + 1 < at, F.concat(taken, F.array(at))).otherwise(taken)

    taken = places.select(*key, F.aggregate("at", F.array().cast("array<int>"), step).alias("taken"))
    # the words between two merged pairs stay as they are: one slice for each pair, and the rest
    own, taken_at = F.col(tokens), F.col("taken")
    begin = lambda k: F.coalesce(F.try_element_at(taken_at, F.when(k > 0, k)) + 2, F.lit(0))
    pair = lambda at: F.concat_ws(delimiter, F.try_element_at(own, at + 1), F.try_element_at(own, at + 2))
    parts = F.transform(taken_at, lambda at, k: F.concat(F.slice(own, begin(k) + 1, at - begin(k)), F.array(pair(at))))
    rest = F.slice(own, F.element_at(taken_at, -1) + 3, F.size(own))
    merged = F.when(taken_at.isNull(), own).otherwise(F.concat(F.flatten(parts), rest))
    return rows.join(taken, list(key), "left").select(*key, merged.alias(tokens))


def _merged_by_list(rows: DataFrame, phrases: pa.Table, key: Sequence[str], tokens: str, delimiter: str) -> DataFrame:
    """merged_tokens by a list of phrases: of places one behind another each second is taken, from the first on."""
    listed = pa.chunked_array([*phrases["a"].chunks, *phrases["b"].chunks], pa.string()).unique()
    code = lambda x: pc.fill_null(pc.index_in(x, value_set=listed), -1).to_numpy().astype(np.int64)
    known = np.sort(code(phrases["a"]) << 32 | code(phrases["b"]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(key))
            flat = lists.flatten()
            own, place = code(flat), first_of_pairs(lists)
            place = place[(own[place] >= 0) & (own[place + 1] >= 0)]
            place = place[np.isin(own[place] << 32 | own[place + 1], known)]
            chained = np.flatnonzero(np.diff(place, prepend=-2) != 1)  # where places don't follow the one before
            behind = np.arange(place.size) - np.repeat(chained, np.diff(chained, append=place.size))
            # a sentence's last place has no pair, so places of two sentences never follow each other
            place = place[behind % 2 == 0]
            stays = np.ones(len(flat), bool)
            stays[place + 1] = False
            both = pc.binary_join_element_wise(flat.take(pa.array(place)), flat.take(pa.array(place + 1)), delimiter)
            merged = np.zeros(len(flat), bool)
            merged[place] = True
            words = pc.replace_with_mask(flat, pa.array(merged), both).filter(pa.array(stays))
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            before = np.concatenate([[0], np.cumsum(stays)])
            ends = np.concatenate([[0], before[np.cumsum(size)]]).astype(np.int32)
            out = pa.ListArray.from_arrays(pa.array(ends), words)
            if lists.null_count:
                out = pc.if_else(lists.is_valid(), out, pa.scalar(None, out.type))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(key)], out], [*key, tokens])

    kinds = dict(rows.dtypes)
    return rows.select(*key, tokens).mapInArrow(merge, ", ".join(f"`{c}` {kinds[c]}" for c in [*key, tokens]))


def unmerge_forbidden(tokens: Column, forbidden: Sequence[str], delimiter: str = "_") -> Column:
    """Takes phrases with a forbidden part apart again."""
    parts = lambda t: F.split(t, delimiter)
    return F.flatten(F.transform(tokens, lambda t: F.when(F.exists(parts(t), lambda p: p.isin(*forbidden)), parts(t)).otherwise(F.array(t))))


# ---------------------------------------------------------------- contexts
def context_places(rows: DataFrame, tokens: str = "tokens", most: int = 50, stopwords: Sequence[str] = ()) -> DataFrame:
    """(term, page_id, sentence_index, rank): where the first contexts of each indexable term are, one for
    each sentence, by page id as text and sentence index. Ranks are limited within tasks first."""
    each = rows.select("page_id", "sentence_index", F.explode(F.array_distinct(indexable(F.col(tokens), stopwords))).alias("term"))
    w = Window.partitionBy("term").orderBy(F.col("page_id").cast("string"), "sentence_index")
    return each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def term_contexts(rows: DataFrame, tokens: str = "tokens", most: int = 50, stopwords: Sequence[str] = (), carried: Sequence[str] = ()) -> DataFrame:
    """context_places with the sentences, and further columns of theirs (carried). Sentences are joined to
    the places that are left, so no sentence is sorted once for each of its words; ``rows`` is read twice."""
    places = context_places(rows, tokens, most, stopwords)
    shown = rows.select("page_id", "sentence_index", "sentence", *carried)
    out = places.join(shown, ["page_id", "sentence_index"])
    return out.select(F.col("page_id").cast("string").alias("page_id"), "sentence_index", "sentence", *carried, "term", "rank")


def diversified(contexts: DataFrame, limit: int = 5, per_page: int = 2, base: str = "sentence") -> DataFrame:
    """Contexts of each term with new sentence patterns and few from one page; where these are too
    few, new patterns only. A term has few contexts (term_contexts), so it is one fold."""
    sig = tx.pattern_signature(F.col(base), F.col("term"))
    rows = contexts.withColumn("sig", sig).groupBy("term").agg(F.sort_array(F.collect_list(F.struct("page_id", "sentence_index", "sentence", "sig"))).alias("all"))
    kind = "struct<page_id:string,sentence_index:int,sentence:string,sig:string>"
    empty = F.array().cast(f"array<{kind}>")

    def fold(quota: bool):
        def step(acc: Column, x: Column) -> Column:
            seen = (x["sig"] != "") & F.exists(acc, lambda y: y["sig"] == x["sig"])
            taken = F.exists(acc, lambda y: (y["page_id"] == x["page_id"]) & (y["sentence_index"] == x["sentence_index"]))
            full = F.size(F.filter(acc, lambda y: y["page_id"] == x["page_id"])) >= per_page if quota else taken
            return F.when((F.size(acc) >= limit) | seen | full, acc).otherwise(F.concat(acc, F.array(x)))

        return step

    first = F.aggregate("all", empty, fold(True))
    rows = rows.withColumn("first", first)
    rows = rows.withColumn("picked", F.aggregate("all", F.col("first"), fold(False)))
    return rows.select("term", F.posexplode("picked").alias("rank", "c")).select("term", F.col("rank"), "c.page_id", "c.sentence_index", "c.sentence")


def pattern_counts(contexts: DataFrame, base: str = "sentence") -> DataFrame:
    """(term, patterns): distinct sentence frames of a term's contexts, empty ones aside. base: what frames
    are taken from; in a build the sentence as it was processed."""
    # the generator makes a frame once for a row; as a grouping key it would stand in every step of the count
    framed = contexts.select("term", F.explode(F.array(tx.pattern_signature(F.col(base), F.col("term")))).alias("frame"))
    return framed.groupBy("term").agg(F.count_distinct(F.nullif("frame", F.lit(""))).alias("patterns"))


# ---------------------------------------------------------------- eligibility
def reason(key: Column, ratio: Column, stopwords: Sequence[str] = (), verb_stems: Column | None = None, min_ratio: float = 0.0, min_length: int = 2, delimiter: str = "_") -> Column:
    """Why a term is no candidate, the first reason that holds; empty if it is one.
    verb_stems: a column that tells whether the term or its last part is a verb stem."""
    parts = F.filter(F.split(key, f"[{delimiter} ]"), lambda p: p != "")
    lone = F.exists(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.regexp_like(p, F.lit("^[가-힣]$")))
    broken = (F.size(parts) >= 2) & (lone | F.element_at(parts, -1).isin(*END_PARTICLES))
    out = F.when(key.isin(*tx.PLACEHOLDERS), REASONS["placeholder"])
    if stopwords:
        out = out.when(key.isin(*stopwords), REASONS["stopword"])
    out = out.when(~F.regexp_like(key, F.lit(tx.MEANING)), REASONS["meaning"]).when(ratio < min_ratio, REASONS["ratio"])
    if verb_stems is not None:
        out = out.when(verb_stems, REASONS["verb"])
    out = out.when(broken, REASONS["malformed"]).when(F.regexp_like(F.replace(key, F.lit(delimiter), F.lit(" ")), F.lit(MEASURE)), REASONS["measure"])
    return out.when((F.length(key) < min_length) & ~F.regexp_like(key, F.lit(ABBREVIATION)), REASONS["short"]).otherwise("")


def annotated(terms: DataFrame, stopwords: DataFrame | None = None, verbs: DataFrame | None = None, key: str = "term", **options: object) -> DataFrame:
    """Terms with is_stopword and excluded_reason; none goes. stopwords (word) and verbs (token) are
    tables of any size; both joins are on the term or its last part."""
    out = terms
    stop = F.lit(False)
    if stopwords is not None:
        out = out.join(stopwords.select(F.col("word").alias(key), F.lit(True).alias("__stop")).distinct(), key, "left")
        stop = F.coalesce("__stop", F.lit(False))
    verb = None
    if verbs is not None:
        own = verbs.select(F.col("token")).distinct()
        last = F.element_at(F.split(key, "[_ ]"), -1)
        out = out.join(own.select(F.col("token").alias(key), F.lit(True).alias("__v1")), key, "left").withColumn("__last", last).join(own.select(F.col("token").alias("__last"), F.lit(True).alias("__v2")), "__last", "left")
        verb = F.coalesce("__v1", "__v2", F.lit(False))
    why = reason(F.col(key), F.col("sentence_ratio"), verb_stems=verb, **options)
    why = F.when(F.col(key).isin(*tx.PLACEHOLDERS), REASONS["placeholder"]).when(stop, REASONS["stopword"]).otherwise(why)
    return out.withColumn("is_stopword", stop).withColumn("excluded_reason", why).select(*terms.columns, "is_stopword", "excluded_reason")
