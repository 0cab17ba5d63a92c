"""Decisions on relations as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: names of types and the default policy ---
RELATION_TYPES = ("SAME_ENTITY", "EXACT_ALIAS", "ALIAS", "ABBREVIATION", "SYNONYM", "NEAR_SYNONYM", "BROADER", "NARROWER", "RELATED", "ANTONYM", "UNRELATED", "UNKNOWN")
CONFIDENCES = ("HIGH", "MEDIUM", "LOW")
ACTIVE_TYPES = ("SAME_ENTITY", "EXACT_ALIAS", "ABBREVIATION")
NEVER_EXPANDED = ("RELATED", "ANTONYM", "UNRELATED", "UNKNOWN")
ENTITY_EXPANDED = ("SAME_ENTITY", "EXACT_ALIAS", "ALIAS", "ABBREVIATION")
CONCEPT_EXPANDED = ("EXACT_ALIAS", "SYNONYM", "NEAR_SYNONYM", "ABBREVIATION")
ENTITY_TYPES = ("PROJECT", "SYSTEM", "PRODUCT", "SERVICE", "ORGANIZATION", "PERSON", "LOCATION", "EVENT", "DOCUMENT", "DOMAIN_TERM", "OTHER")
IDENTITY_TYPES = ("SAME_ENTITY", "EXACT_ALIAS", "ALIAS", "ABBREVIATION")
STATUS_OF = {"HIGH": "ACTIVE", "MEDIUM": "REVIEW", "LOW": "REJECTED"}
HINT_SCORES = {"SAME": 1.0, "BROADER": 0.7, "NARROWER": 0.7}
CONFIDENCE_SCORES = {"HIGH": 1.0, "MEDIUM": 0.7, "LOW": 0.4}
STRATA = {"FASTTEXT": "embedding only", "CONTEXT_PROFILE": "profile only", "CONTAINMENT": "containment only", "LEXICAL": "lexical only", "LLM_PROPOSED": "proposed only"}
REMOVAL_MARKS = ("x", "X", "o", "O", "v", "V", "1", "y", "Y", "제거", "삭제", "true", "TRUE")
# --- end of fixed values ---


def known(value: Column, names: tuple[str, ...], default: str) -> Column:
    """A value of a closed vocabulary; anything else is the default."""
    v = F.upper(F.btrim(value))
    return F.when(v.isin(*names), v).otherwise(F.lit(default))


def decide_status(kind: Column, confidence: Column, bidirectional: Column, active: tuple[str, ...] = ACTIVE_TYPES, need_both: bool = True, related: str = "REVIEW", by_confidence: dict[str, str] | None = None) -> Column:
    """The status of a relation. by_confidence: statuses in place of STATUS_OF's."""
    of = STATUS_OF | (by_confidence or {})
    by = F.when(confidence == "HIGH", of["HIGH"]).when(confidence == "MEDIUM", of["MEDIUM"]).otherwise(of["LOW"])
    out = F.when(kind.isin("UNRELATED", "UNKNOWN"), "REJECTED").when(kind == "RELATED", related)
    # these are people's to decide, whatever the active types
    out = out.when(kind.isin("ANTONYM", "BROADER", "NARROWER") | ~kind.isin(*active), "REVIEW")
    return (out.when(~bidirectional, "REVIEW") if need_both else out).otherwise(by)


def is_expandable(term_type: Column, kind: Column, status: Column) -> Column:
    allowed = F.when(term_type == "ENTITY", kind.isin(*ENTITY_EXPANDED)).when(term_type == "CONCEPT", kind.isin(*CONCEPT_EXPANDED)).otherwise(F.lit(False))
    return (status == "ACTIVE") & ~kind.isin(*NEVER_EXPANDED) & allowed


def safe_directions(kind: Column, ab: Column, ba: Column) -> Column:
    """Struct (ab, ba): never for some types, one way for broader and narrower, else as judged."""
    never = kind.isin(*NEVER_EXPANDED)
    to = F.when(never | (kind == "BROADER"), False).when(kind == "NARROWER", True).otherwise(ab)
    back = F.when(never | (kind == "NARROWER"), False).when(kind == "BROADER", True).otherwise(ba)
    return F.struct(to.alias("ab"), back.alias("ba"))


def guarded_confidence(kind: Column, confidence: Column, patterns_a: Column, patterns_b: Column, least: int = 2) -> Column:
    """HIGH becomes MEDIUM for an identity with too few distinct sentence patterns on either side."""
    weak = (confidence == "HIGH") & kind.isin(*IDENTITY_TYPES) & (F.least(patterns_a, patterns_b) < least)
    return F.when(weak, "MEDIUM").otherwise(confidence)


def proposal_score(hint: Column, confidence: Column) -> Column:
    told = lambda column, scores, other: F.coalesce(*[F.when(column == k, v) for k, v in scores.items()], F.lit(other))
    return F.round(told(hint, HINT_SCORES, 0.5) * told(confidence, CONFIDENCE_SCORES, 0.4), 4)


def stratum(sources: Column) -> Column:
    only = F.when(F.size(sources) == 0, "none").when(F.size(sources) > 1, "several paths")
    for source, name in STRATA.items():
        only = only.when(sources[0] == source, name)
    return only.otherwise(sources[0])


def removal_hint(key: Column, patterns: Column, frequency: Column) -> Column:
    """Why a reviewer may want to remove a term; empty if nothing speaks against it."""
    shown = F.replace(key, F.lit("_"), F.lit(" "))
    word = F.regexp_like(shown, F.lit("^[A-Za-z][A-Za-z0-9]*$"))
    out = F.when(F.regexp_like(key, F.lit("^<(DATE|TIME|NUMBER|URL|EMAIL)>$")), "placeholder").when(F.length(F.replace(shown, F.lit(" "), F.lit(""))) <= 1, "one character")
    out = out.when(word & (shown == F.lower(shown)), "field name").when(word & (shown == F.upper(shown)), "code value")
    return out.when((patterns <= 1) & (frequency >= 5), "repeated phrase").otherwise("")


def is_removal_mark(cell: Column) -> Column:
    return F.btrim(F.coalesce(cell, F.lit(""))).isin(*REMOVAL_MARKS)
