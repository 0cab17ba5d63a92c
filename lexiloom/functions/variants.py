"""Rule-based spelling variants of texts: code stays, Korean particles follow the new word."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code spans, and particles after a final consonant and after a vowel.
CODE = r"(?s)```.*?```|`[^`\n]+`"
AFTER_CONSONANT = {"가": "이", "는": "은", "를": "을", "와": "과", "로": "으로"}
AFTER_VOWEL = {"이": "가", "은": "는", "을": "를", "과": "와", "으로": "로"}

#: The rules of the package, a list of objects.
RULES = resources.files("lexiloom.functions") / "variant_rules.json"


@dataclass
class Variant:
    """A rule: where it applies (a boolean column) and (pattern, replacement) pairs in order."""

    name: str
    when: Column
    substitutions: list[tuple[str, str]] = field(default_factory=list)


def word_start(term: str, not_before: str = "") -> str:
    """A pattern of a term where a word begins."""
    return rf"(?<![0-9A-Za-z가-힣]){re.escape(term)}" + (f"(?!{not_before})" if not_before else "")


def fix_particles(text: Column, word: str) -> Column:
    """Particles behind ``word`` as its last syllable asks for, where no Hangul follows them."""
    code = ord(word[-1:] or " ")
    if not 0xAC00 <= code <= 0xD7A3:
        return text
    for wrong, right in (AFTER_CONSONANT if (code - 0xAC00) % 28 else AFTER_VOWEL).items():
        text = F.regexp_replace(text, f"{re.escape(word)}{wrong}(?![가-힣])", word + right)
    return text


def rules_of(text: str | None = None) -> list[Variant]:
    """Rules from a JSON list of objects: name, canonical, variant, axis, when (a condition in SQL over a
    document's columns), not_before (what a canonical term isn't followed by). None: the rules of the package."""
    text = RULES.read_text("utf-8") if text is None else text
    return [Variant(r["name"], F.expr(r["when"]), [(word_start(r["canonical"], r.get("not_before", "")), r["variant"])]) for r in json.loads(text)]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that stands in it once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _state(text: Column, rules: list[Variant]) -> Column:
    """(gaps between code with the rules applied, a count for each substitution)."""
    out = F.struct(F.split(text, CODE, -1).alias("gaps"), F.array().cast("array<int>").alias("counts"))
    for rule in rules:
        for pattern, new in rule.substitutions:
            out = _let(out, _applied(rule.when, pattern, new))
    return out


def _applied(when: Column, pattern: str, new: str) -> Callable[[Column], Column]:
    """A substitution in every gap of a state; particles are put right in all of them if it was found in any."""

    def of(state: Column) -> Column:
        gaps = state["gaps"]
        found = F.aggregate(gaps, F.lit(0), lambda acc, g: acc + F.regexp_count(g, F.lit(pattern)))
        replaced = F.transform(gaps, lambda g: fix_particles(F.regexp_replace(g, pattern, new), new))
        return _let(
            F.when(when, found).otherwise(0),
            lambda n: F.struct(F.when(n > 0, replaced).otherwise(gaps).alias("gaps"), F.concat(state["counts"], F.array(n)).alias("counts")),
        )

    return of


def _joined(gaps: Column, text: Column) -> Column:
    spans = F.regexp_extract_all(text, F.lit(f"({CODE})"), F.lit(1))
    return F.array_join(F.zip_with(gaps, spans, lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")


def _counted(counts: Column, rules: list[Variant]) -> dict[str, Column]:
    out, at = {}, 0
    for rule in rules:
        own = [F.get(counts, F.lit(at + k)) for k in range(len(rule.substitutions))]
        out[rule.name], at = sum(own, F.lit(0)), at + len(own)
    return out


def apply_variants(text: Column, rules: list[Variant]) -> tuple[Column, dict[str, Column]]:
    """(the text with the rules applied in order outside code, the number of replacements of each rule).
    Conditions see the text as it was. A null text is an empty one; a condition that is null doesn't hold."""
    text = F.coalesce(text, F.lit(""))
    state = _state(text, rules)
    return _joined(state["gaps"], text), _counted(state["counts"], rules)


def with_variants(docs: DataFrame, rules: list[Variant], column: str = "body", counts: str = "replaced") -> DataFrame:
    """Documents with the rules applied to a column, and a map of the rules' replacements; the rules are
    worked out once for a document."""
    text = F.coalesce(column, F.lit(""))
    out = docs.withColumn("__state", _state(text, rules))
    each = _counted(F.col("__state.counts"), rules)
    return out.withColumns({column: _joined(F.col("__state.gaps"), text), counts: F.create_map(*[x for k, n in each.items() for x in (F.lit(k), n)])}).drop("__state")


def variant_counts(varied: DataFrame, counts: str = "replaced") -> DataFrame:
    """(name, documents, replaced): what each rule has changed."""
    rows = varied.select(F.explode(counts).alias("name", "n"))
    return rows.groupBy("name").agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("replaced"))
