"""The whole build: pages to dictionary, each stage a written table, so that a lost executor or a
later command starts from tables and not from the pages."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexiloom.functions import lexicon as lx
from lexiloom.functions import policy as po
from lexiloom.functions import text as tx
from lexiloom.operators import candidates as ca
from lexiloom.operators import embedding as em
from lexiloom.operators import index as ix
from lexiloom.operators import judgement as ju
from lexiloom.operators import sync as sy
from lexiloom.operators import terms as te
from lexiloom.session import ship
from lexiloom.sources import readers as rd
from lexiloom.sources import writers as wr
from lexiloom.sources.keyed import KeyedTable


@dataclass
class Config:
    """Figures of a build. answers: verdict rows (JUDGED results) stored by pair key."""

    output: str = "text"
    min_text: int = 10
    max_sentence: int = 400
    guards: tuple[str, ...] = tx.GUARDS
    protected: tuple[str, ...] = tx.PROTECTED
    stopwords: tuple[str, ...] = ()
    phrase_min: int = 5
    phrase_threshold: float = 10.0
    forbidden: tuple[str, ...] = ()  # words that are no part of a phrase
    min_frequency: int = 1
    min_ratio: float = 0.0
    window: int = 5
    neighbors: int = 20
    min_similarity: float = 0.35
    mutual: int = 0
    strong: int = 0
    cap: int = 0
    max_total: int = 0
    need_corroboration: bool = False
    contexts: int = 50
    asked: int = 20
    shown: int = 5
    proposed: int = 2000
    analyser: Callable[[list[str]], list[list[tuple[str, str]]]] | None = None
    tags: tuple[str, ...] = te.KEPT_TAGS
    dictionary: str = ""  # a user dictionary's file, beside the one that the last build wrote
    vectors: int = 0  # columns of a vector model of the build's own, 0 for none
    indexed: bool = False  # its neighbours by an index
    buckets: int = 64  # partitions of a new table of pages
    names: dict[str, str] = field(default_factory=dict)


class Build:
    """Stages of a build in a folder: ``run()`` does all, ``rebuild()`` the dictionary only."""

    def __init__(self, spark: SparkSession, folder: str, config: Config | None = None):
        self.spark, self.folder, self.config = spark, folder.rstrip("/"), config or Config()
        self.counts: dict[str, int] = {}  # of what this object has written
        ship(spark)

    def put(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        """Writes a table; its rows, and further counts, are taken while it is written."""
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        self.counts |= {name if k == "rows" else k: v for k, v in seen.get.items()}
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def has(self, name: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def stopwords(self) -> tuple[str, ...]:
        """Those of the settings, and the terms that reviews have removed (a list that people make)."""
        removed = [r["value"] for r in self.spark.read.text(f"{self.folder}/stopwords").distinct().collect()] if self.has("stopwords") else []
        return (*self.config.stopwords, *sorted(removed))

    def phrases(self) -> lx.Lexicon:
        """Words of several parts of the user dictionaries, which people review."""
        paths = [p for p in (self.config.dictionary, f"{self.folder}/user_dictionary" if self.has("user_dictionary") else "") if p]
        words = [r["surface"] for p in paths for r in rd.read_user_dictionary(self.spark, p).where("surface LIKE '% %'").select("surface").distinct().collect()]
        return lx.Lexicon(words)

    def excluded(self, more: DataFrame | None = None) -> DataFrame | None:
        """(pair_key) of the pairs that reviews have removed, and of ``more``."""
        if not self.has("excluded_pairs"):
            return more
        own = rd.read_excluded_pairs(self.spark, f"{self.folder}/excluded_pairs")
        return own.union(more.select("pair_key")).distinct() if more is not None else own

    def pages(self) -> DataFrame:
        return KeyedTable(self.spark, f"{self.folder}/pages", ["page_id"]).read()

    def collect(self, pages: DataFrame, run_id: str = "run") -> DataFrame:
        """Merges new versions of pages into the table of pages; gives the counts."""
        table = KeyedTable(self.spark, f"{self.folder}/pages", ["page_id"], self.config.buckets)
        synced = sy.version_sync(pages, table.read()) if table.exists() else pages.withColumn("change", F.lit("created"))
        # written first, for the table changes under it; only partitions with a changed page are written again
        synced = self.put(synced, "synced", errors=self._failed(pages))
        table.put(synced.where("change <> 'unchanged'").drop("change"))
        return self.put(sy.sync_counts(synced), f"sync/{run_id}", changed=F.sum("changed"))

    def _failed(self, rows: DataFrame) -> Column:
        return F.count_if(F.col("error").isNotNull()) if "error" in rows.columns else F.lit(0).cast("long")

    def preprocess(self) -> DataFrame:
        c, stopwords = self.config, self.stopwords()
        clean = self.pages().withColumn("clean_text", tx.clean_text(F.col("body"), output=c.output)).where(F.length("clean_text") >= c.min_text)
        rows = te.sentences(clean, "page_id", "title", "clean_text", max_length=c.max_sentence, guards=c.guards)
        rows = rows.withColumn("normalized", tx.normalize_protected(F.col("sentence"), protected=c.protected))
        phrases = self.phrases()
        if phrases.words:
            rows = rows.withColumn("normalized", lx.joined(F.col("normalized"), phrases))
        if c.analyser:  # an analyser's tokens, of the kept kinds; stems that are seen as such only are no terms
            rows = te.tagged(rows, c.analyser, "normalized").withColumn("tokens", te.kept_tokens(F.col("tagged"), c.tags, stopwords))
        else:
            rows = rows.withColumn("tokens", tx.fallback_tokens(F.col("normalized"), stopwords))
        unread = {"unread": F.count_if(F.col("tag_error").isNotNull())} if c.analyser else {}
        kept = F.size("tokens") > 0
        base = self.put(rows.where(kept | F.col("tag_error").isNotNull() if c.analyser else kept), "sentences", **unread).where(kept)
        if c.analyser:
            each = base.select(F.explode("tagged").alias("x")).select("x.token", F.upper("x.tag").isin(*te.STEM_TAGS).alias("stem"))
            self.put(te.verb_only(each, "token", F.col("stem")), "verbs")
        merged = base
        for step in (1, 2):  # pairs, then triples over merged tokens
            phrases = self.put(te.phrase_scores(merged, "tokens", c.phrase_min, c.phrase_threshold).where(~F.col("a").isin(*tx.PLACEHOLDERS) & ~F.col("b").isin(*tx.PLACEHOLDERS)), f"phrases{step}")
            again = te.merged_tokens(merged.select("page_id", "sentence_index", "tokens"), phrases, ["page_id", "sentence_index"])
            if c.forbidden:
                again = again.withColumn("tokens", te.unmerge_forbidden(F.col("tokens"), c.forbidden))
            merged = self.put(base.drop("tokens").join(again, ["page_id", "sentence_index"]), f"merged{step}")
        return merged

    def catalog(self) -> DataFrame:
        c, rows, stopwords = self.config, self.get("merged2"), self.stopwords()
        # frames are taken from the processed sentence: placeholders and merged phrases as they were indexed
        processed = rows.withColumn("processed", F.array_join("tokens", " "))
        self.put(te.term_contexts(processed, most=c.contexts, stopwords=stopwords, carried=("processed",)), "contexts")
        self.put(te.pattern_counts(self.get("contexts"), "processed"), "patterns")
        self.cascade()
        verbs = self.get("verbs") if c.analyser else None
        terms = te.annotated(te.term_statistics(rows, stopwords=stopwords), verbs=verbs, min_ratio=c.min_ratio)
        return self.put(terms, "terms", vocabulary=F.count_if(F.col("frequency") >= c.min_frequency))

    def shown(self) -> DataFrame:
        """(term, contexts, context_ids): sentences of each term to show, of different frames and pages."""
        rows = te.diversified(self.get("contexts"), self.config.shown, base="processed").withColumn("id", ju.context_id())
        lists = rows.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("rank", "sentence", "id"))).alias("c"))
        return lists.select("term", F.col("c.sentence").alias("contexts"), F.col("c.id").alias("context_ids"))

    def cascade(self) -> None:
        """Evidence goes with its context or its relation."""
        if self.has("evidence"):
            contexts = self.get("contexts").select(ju.context_id().alias("context_id"))
            left = ju.cascaded(self.get("evidence"), contexts, self.get("relations"))
            self.put(self.put(left, "cascaded"), "evidence")  # a table isn't written while it is read

    def prompts(self, kind: str) -> DataFrame:
        """Requests of a kind (classify, propose, judge) as text files, a folder for each, and their manifest."""
        c, shown, size = self.config, self.shown(), self.config.asked
        if kind == "judge":
            rows = ju.with_contexts(self.get("candidates"), shown).where("not skipped")
            rows = ju.batched(rows.withColumn("pair_id", tx.pair_key(F.col("a"), F.col("b"))), size, [F.desc("priority"), F.col("a"), F.col("b")])
            texts, key = ju.relation_prompt(rows, ju.head_of(kind)), F.col("pair_id")
        else:
            terms = self.get("terms").where("excluded_reason = ''")
            terms = ju.proposal_terms(self.get("terms"), c.proposed, c.min_frequency) if kind == "propose" else ju.involved(terms, self.get("candidates"))
            rows = ju.batched(terms.join(shown, "term", "left"), size, [F.desc("frequency"), F.col("term")])
            texts, key = ju.term_prompt(rows, ju.head_of(kind), c.shown), F.col("term")
        texts.write.mode("overwrite").partitionBy("batch").text(f"{self.folder}/prompts/{kind}")
        return self.put(ju.manifest(rows, kind, key), f"manifests/{kind}")

    def replay(self, kind: str, path: str) -> DataFrame:
        """Stored answers (files, later ones count more) of requests of a kind, as the stages take them."""
        return self.replayed(kind, rd.read_answers(self.spark, path).withColumnRenamed("file", "batch"))

    def ask(self, kind: str, client: Callable[[str], str]) -> DataFrame:
        """Sends the requests of a kind to a model, a function of a request's text, and takes its answers as ``replay``
        does. All answers and errors stay in a table; requests that failed have no answer."""
        asked = self.spark.read.text(f"{self.folder}/prompts/{kind}", wholetext=True).select("batch", F.col("value").alias("prompt"))
        told = self.put(ju.call_batches(asked, client), f"asked/{kind}", unanswered=F.count_if(F.col("error").isNotNull()))
        return self.replayed(kind, told.where("answer is not null").select("batch", "answer"))

    def replayed(self, kind: str, answers: DataFrame) -> DataFrame:
        if kind == "propose":
            return self.put(ju.proposals(answers, self.get("terms").where("excluded_reason = ''")), "proposals")
        if kind == "classify":
            rows = ju.parsed(answers, ju.CLASSIFIED, "results").groupBy(F.col("termKey").alias("term")).agg(F.max_by(F.struct("termType", "entityType"), "batch").alias("k"))
            rows = rows.select("term", F.col("k.termType").alias("term_type"), F.col("k.entityType").alias("entity_type"))
            return self.put(rows, "types")
        rows = ju.parsed(answers, ju.JUDGED, "results")
        rows = rows.withColumn("answer", F.struct("relationType", "confidence", "safeAToB", "safeBToA", "reason", "evidenceContextIds"))
        by_id = ju.latest_answers(rows.where("pairId <> ''").withColumnRenamed("pairId", "pair_id"), "pair_id", "batch")
        named = rows.where("termA is not null and termB is not null").withColumn("pair_key", tx.pair_key(F.col("termA"), F.col("termB")))
        asked = self.get("candidates").select("pair_key", F.col("pair_key").alias("pair_id"))
        found = ju.replayed(asked, by_id, ju.latest_answers(named, "pair_key", "batch"))
        return self.put(found.where("not missing").select("pair_key", "answer.*"), "answers")

    def candidates(self, neighbors: DataFrame | None = None, proposals: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
        """neighbors (term, other, similarity, rank): any vector model's; proposals (a, b, score)."""
        c, rows, terms = self.config, self.get("merged2"), self.get("terms")
        good = terms.where("excluded_reason = ''").select("term")
        lexical = ca.lexical_pairs(good)
        paths = [ca.scored_pairs(lexical.where(F.array_contains("sources", s)), s, "lexical") for s in ("LEXICAL", "CONTAINMENT")]
        weights = ca.ppmi(ca.cooccurrence(te.corpus(rows), window=c.window), terms.select("term", F.col("frequency").alias("n")).join(good, "term", "left_semi"), c.min_frequency)
        profile = ca.valid_neighbors(ca.profile_neighbors(weights, c.neighbors), terms, c.min_frequency)
        paths.append(ca.neighbor_pairs(profile, "CONTEXT_PROFILE", c.min_similarity))
        if neighbors is None and c.vectors:
            known = terms.join(good, "term", "left_semi").select("term", "frequency")
            vectors = self.put(em.with_subwords(em.factors(weights, c.vectors), known), "vectors")
            neighbors = (ix.indexed_neighbors if c.indexed else ca.vector_neighbors)(vectors, top=c.neighbors)
        if neighbors is not None:
            near = ca.neighbor_pairs(ca.valid_neighbors(neighbors, terms, c.min_frequency), "FASTTEXT", c.min_similarity)
            paths.append(ca.mutual_pairs(near, c.mutual, c.strong) if c.mutual else near)
        if proposals is not None:
            own = proposals
            for side in ("a", "b"):
                own = own.join(good.select(F.col("term").alias(side)), side, "left_semi")
            paths.append(ca.scored_pairs(own, "LLM_PROPOSED", "llm"))
        pairs = ca.fuse(paths)
        pairs = ca.corroborated(pairs) if c.need_corroboration else pairs
        excluded = self.excluded(excluded)
        pairs = ca.without_excluded(pairs, excluded) if excluded is not None else pairs.withColumn("pair_key", tx.pair_key(F.col("a"), F.col("b")))
        pairs = self.put(pairs, "fused")
        if c.cap:
            pairs = ca.degree_capped(pairs, c.cap, lambda df, name: self.put(df, f"rounds/{name}"))
        pairs = ca.top_pairs(pairs, c.max_total) if c.max_total else pairs
        return self.put(pairs.withColumn("status", F.lit("PENDING")), "candidates")

    def judge(self, answers: DataFrame, types: DataFrame | None = None) -> DataFrame:
        """answers (pair_key, relationType, confidence, safeAToB, safeBToA, reason, evidenceContextIds), types (term,
        term_type, entity_type); the last column of each may be missing. Evidence counts only if its context was shown."""
        pairs, patterns = self.get("candidates"), self.get("patterns")
        asked = ju.with_contexts(pairs, self.shown())
        told = F.col("evidenceContextIds") if "evidenceContextIds" in answers.columns else F.array().cast("array<bigint>")
        got = answers.select(
            "pair_key", F.col("relationType").alias("relation_type"), "confidence", F.coalesce("safeAToB", F.lit(False)).alias("safe_ab"), F.coalesce("safeBToA", F.lit(False)).alias("safe_ba"),
            F.substring("reason", 1, 1000).alias("reason"), told.alias("told"),
        )
        offered = asked.where("not skipped").select("pair_key", "a", "b", "similarity", F.concat("context_ids_a", "context_ids_b").alias("offered"))
        matched = ju.matched(offered, got, "pair_key").withColumn("evidence", ju.offered_only(F.col("told"), F.col("offered"))).drop("told", "offered")
        verdicts = ju.judged(matched, patterns)
        state = F.when(F.col("skipped"), "SKIPPED").when(F.col("__v").isNotNull(), "VALIDATED").otherwise("VALIDATION_FAILED")
        outcome = asked.join(verdicts.select("pair_key", F.lit(1).alias("__v")), "pair_key", "left").select("pair_key", state.alias("status"))
        self.put(sy.merge_status(pairs, outcome, "pair_key"), "judged_candidates", validated=F.count_if(F.col("status") == "VALIDATED"))
        terms = self.get("terms")
        if types is not None:
            kind = po.known(F.col("term_type"), ("ENTITY", "CONCEPT"), "UNKNOWN")
            of = F.when((kind == "ENTITY") & (F.col("entity_type") != ""), po.known(F.col("entity_type"), po.ENTITY_TYPES, "OTHER")) if "entity_type" in types.columns else F.lit(None).cast("string")
            typed = terms.join(types.select("term", kind.alias("term_type"), of.alias("entity_type")), "term", "left")
        else:
            typed = terms.withColumns({"term_type": F.lit("UNKNOWN"), "entity_type": F.lit(None).cast("string")})
        self.put(typed.fillna("UNKNOWN", ["term_type"]), "typed_terms")
        each = {s.lower(): F.count_if(F.col("status") == s) for s in ("ACTIVE", "REVIEW", "REJECTED")}
        columns = ("source", "target", "relation_type", "confidence", "status", "safe_expansion", "similarity", "reason")
        rows = self.put(ju.directed(verdicts).select(sy.relation_id().alias("relation_id"), *columns, "evidence"), "verdicts")
        self.put(sy.save_evidence(rows, terms), "evidence")
        return self.put(rows.drop("evidence"), "relations", **each)

    def rebuild(self) -> DataFrame:
        terms, relations = self.get("typed_terms"), ju.with_evidence(self.get("relations"), self.get("evidence"))
        wr.write_review_queue(ju.review_queue(relations), f"{self.folder}/review_queue")
        entries = self.put(ju.dictionary(terms, relations), "dictionary")
        wr.write_dictionary(entries, f"{self.folder}/dictionary_json")
        phrases = terms.where(F.contains("term", F.lit("_")) & (F.col("excluded_reason") == ""))
        wr.write_user_dictionary(phrases, f"{self.folder}/user_dictionary", "term")
        return entries

    def run(self, pages: DataFrame | None, answers: DataFrame | None = None, types: DataFrame | None = None, run_id: str = "run", **paths: DataFrame) -> DataFrame:
        """The run's record (wr.RUN_FIELDS); a failure is recorded and raised."""
        began, self.counts, status, message = time.time(), {}, "COMPLETED", "done"
        try:
            if pages is not None:
                self.collect(pages, run_id)
            self.preprocess()
            self.catalog()
            self.candidates(**paths)
            if answers is not None:
                self.judge(answers, types)
                self.rebuild()
        except Exception as e:
            status, message = "FAILED", f"{type(e).__name__}: {e}"[:2000]
            raise
        finally:
            record = self._record(run_id, began, status, message)
        return record

    def _record(self, run_id: str, began: float, status: str, message: str) -> DataFrame:
        n = self.counts
        n = n | {"phrases": n.get("phrases1", 0) + n.get("phrases2", 0), "failed": n.get("errors", 0) + n.get("unread", 0)}
        counts = {f: n.get(stage, 0) for f, stage in wr.RUN_COUNTS.items()}
        if KeyedTable(self.spark, f"{self.folder}/pages", ["page_id"]).exists():
            counts["document_count"] = self.pages().count()  # of the table, which a run changes in part only
        at = lambda t: datetime.fromtimestamp(t, UTC)
        now = time.time()
        values = {"run_id": run_id, "started_at": at(began), "completed_at": at(now), "status": status, "duration_seconds": round(now - began, 2), "message": message} | counts
        row = self.spark.createDataFrame([tuple(values[f.split()[0]] for f in wr.RUN_FIELDS)], ", ".join(wr.RUN_FIELDS))
        row.write.mode("overwrite").parquet(f"{self.folder}/runs/{run_id}")
        return self.get(f"runs/{run_id}")
