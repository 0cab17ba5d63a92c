"""A morphological analyser of its own: the cheapest way through a lattice of words.

A run of characters between blanks is cut into morphemes. Entries (surface, tag) and pairs of
neighbouring tags have costs, the negative logarithms of smoothed shares in tagged sentences;
``trained`` counts them by grouped aggregation. Every place of a run has the entries that begin there
(found by one automaton), and an unknown morpheme for each length of a stretch of one class
of characters, so there is always a way. Viterbi keeps the cheapest way to each place and
tag. Entries of a user dictionary cost nothing and are offered as wholes, also across blanks.

Bounds: the model has the ``most`` most frequent entries and the pairs of tags, and is shipped to the
workers; a worker remembers ``HELD`` runs, so frequent words are cut once.

Cases: a null or empty sentence has no morphemes; ties go to the longer first morpheme, then to the
tag that comes first; runs longer than ``LONGEST`` characters are cut into stretches of one
class without a search; a model without entries cuts by classes only.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.lexicon import Lexicon

#: The longest run that is searched, the longest unknown morpheme, and runs that a worker remembers.
LONGEST, UNKNOWN_LENGTH, HELD = 200, 12, 200_000
#: What an unknown morpheme costs, and each of its characters beyond the first.
UNKNOWN_COST, MORE_COST = 14.0, 1.5
#: Kinds of unknown morphemes by class of characters.
CLASS_TAGS = {"hangul": "NNG", "latin": "SL", "digit": "SN", "han": "SH", "other": "SW"}
BEGIN = "^"


def class_of(c: str) -> str:
    if "가" <= c <= "힣" or "ㄱ" <= c <= "ㅣ":
        return "hangul"
    if "一" <= c <= "鿿":
        return "han"
    if c.isdigit():
        return "digit"
    return "latin" if c.isalpha() else "other"


class Analyser:
    """A function of sentences for Build's settings: lists of (morpheme, tag)."""

    def __init__(self, entries: Iterable[tuple[str, str, float]], pairs: dict[tuple[str, str], float], user: Iterable[tuple[str, str]] = (), no_pair: float = 8.0):
        self.pairs, self.no_pair = dict(pairs), no_pair
        self.entries: dict[str, list[tuple[str, float]]] = {}
        for surface, tag, cost in sorted(entries):
            if surface and not any(map(str.isspace, surface)):
                self.entries.setdefault(surface, []).append((tag, cost))
        own = dict(user)
        self.user = {k.strip(): v for k, v in own.items() if k.strip()}
        self.lexicon = Lexicon(self.user)
        self.longest = max(map(len, self.entries), default=0)
        self.cut = lru_cache(maxsize=HELD)(self._cut)

    def __reduce__(self):
        rows = [(s, t, c) for s, told in self.entries.items() for t, c in told]
        return Analyser, (rows, self.pairs, list(self.user.items()), self.no_pair)

    def __call__(self, sentences: list[str]) -> list[list[tuple[str, str]]]:
        return [self.sentence(s) for s in sentences]

    def sentence(self, text: str | None) -> list[tuple[str, str]]:
        text, out, at = text or "", [], 0
        for start, end, k in self.lexicon.matches(text):
            word = self.lexicon.words[k]
            out += [x for run in text[at:start].split() for x in self.cut(run)]
            out.append((word, self.user[word]))
            at = end
        return out + [x for run in text[at:].split() for x in self.cut(run)]

    def offers(self, run: str, start: int) -> list[tuple[int, str, float]]:
        """(end, tag, cost) of the morphemes that may begin at a place."""
        out = [(start + n, tag, cost) for n in range(1, min(self.longest, len(run) - start) + 1) for tag, cost in self.entries.get(run[start : start + n], ())]
        kind = class_of(run[start])
        for n in range(1, min(UNKNOWN_LENGTH, len(run) - start) + 1):
            if class_of(run[start + n - 1]) != kind:
                break
            out.append((start + n, CLASS_TAGS[kind], UNKNOWN_COST + MORE_COST * (n - 1)))
        return out

    def _cut(self, run: str) -> tuple[tuple[str, str], ...]:
        if len(run) > LONGEST:
            edges = [0, *(k for k in range(1, len(run)) if class_of(run[k]) != class_of(run[k - 1])), len(run)]
            return tuple((run[a:b], CLASS_TAGS[class_of(run[a])]) for a, b in zip(edges[:-1], edges[1:], strict=True))
        ways: list[dict[str, tuple]] = [{} for _ in range(len(run) + 1)]  # tag of the morpheme behind: (cost, its end, its tag)
        ways[-1] = {"": (0.0, -1, "")}
        for start in range(len(run) - 1, -1, -1):
            for end, tag, cost in self.offers(run, start):
                for following, (rest, *_) in ways[end].items():
                    link = self.pairs.get((tag, following), self.no_pair) if following else 0.0
                    told = (cost + link + rest, -end, following)
                    if tag not in ways[start] or told < ways[start][tag]:
                        ways[start][tag] = told
        first = min(ways[0], key=lambda t: (ways[0][t][0] + self.pairs.get((BEGIN, t), self.no_pair), ways[0][t][1], t))
        out, at, tag = [], 0, first
        while at < len(run):
            _, end, following = ways[at][tag]
            out.append((run[at:-end], tag))
            at, tag = -end, following
        return tuple(out)


def trained(tagged: DataFrame, column: str = "tagged", most: int = 200_000, smooth: float = 0.5, user: Iterable[tuple[str, str]] = ()) -> Analyser:
    """An analyser with costs of ``tagged`` sentences: arrays of (token, tag), one for each run."""
    rows = tagged.select(F.transform(column, lambda x: F.struct(x["token"].alias("token"), F.upper(x["tag"]).alias("tag"))).alias("t"))
    each = rows.select(F.explode("t").alias("x")).select("x.token", "x.tag")
    counts = each.groupBy("token", "tag").agg(F.count(F.lit(1)).alias("n"))
    totals = {r["tag"]: (r["n"], r["kinds"]) for r in counts.groupBy("tag").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()}
    share = lambda n, total, kinds: -math.log((n + smooth) / (total + smooth * (kinds + 1)))
    entries = [(r["token"], r["tag"], share(r["n"], *totals[r["tag"]])) for r in counts.orderBy(F.desc("n"), "token", "tag").limit(most).collect()]
    tags: Column = F.concat(F.array(F.lit(BEGIN)), F.transform("t", lambda x: x["tag"]))
    both = F.transform(F.sequence(F.lit(1), F.size(tags) - 1), lambda k: F.struct(F.get(tags, k - 1).alias("a"), F.get(tags, k).alias("b")))
    links = rows.where(F.size("t") > 0).select(F.explode(both).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict[str, int] = {}
    for r in links:
        out[r["a"]] = out.get(r["a"], 0) + r["n"]
    pairs = {(r["a"], r["b"]): share(r["n"], out[r["a"]], len(totals)) for r in links}
    return Analyser(entries, pairs, user)
