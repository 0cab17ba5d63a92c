"""Large dictionaries over texts: one automaton for all words, one pass over a text.

An Aho-Corasick automaton is built once, in the driver, and goes to the tasks as bytes; a Python
worker opens it once. Matches are leftmost-longest: of the matches that may stand, the one that
begins first counts, the longest of those, and the next begins behind it. A match may stand where
no letter or digit comes before it; with ``whole`` none may come behind it either (words of
languages with particles have theirs attached).

Bounds: the dictionary is held by the driver and by each worker, some 100 bytes for a character of it; a text's
matches are found in time that grows with the text and its matches, whatever the number of words.

Cases: a null text has no matches and stays null; words are taken as they are written, without blanks at
their ends; empty words and repeats count for nothing; an empty dictionary changes nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=4)
def _opened(packed: bytes) -> ahocorasick.Automaton:
    return pickle.loads(packed)


class Lexicon:
    """Words, and where texts have them."""

    def __init__(self, words: Iterable[str], whole: bool = False):
        self.words, self.whole = sorted({w.strip() for w in words} - {""}), whole
        built = ahocorasick.Automaton()
        for k, w in enumerate(self.words):
            built.add_word(w, k)
        if self.words:
            built.make_automaton()
        self.packed = pickle.dumps(built)

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, number of the word), in order."""
        if not self.words or not text:
            return []
        longest: dict[int, tuple[int, int]] = {}
        for last, k in _opened(self.packed).iter(text):
            start = last + 1 - len(self.words[k])
            if start and text[start - 1].isalnum() or self.whole and text[last + 1 : last + 2].isalnum():
                continue
            longest[start] = max(longest.get(start, (0, 0)), (last + 1, k))
        out, at = [], 0
        for start in sorted(longest):
            if start >= at:
                at, k = longest[start]
                out.append((start, at, k))
        return out

    def joined(self, text: str | None, delimiter: str = "_") -> str | None:
        """The text with the blanks within its matches replaced, so that a word of several parts is one token."""
        if text is None:
            return None
        parts, at = [], 0
        for start, end, _ in self.matches(text):
            parts += [text[at:start], delimiter.join(text[start:end].split())]
            at = end
        return "".join([*parts, text[at:]])


def matches(text: Column, lexicon: Lexicon) -> Column:
    """Array of (start, end, word) of a text's matches; offsets in code points, end exclusive."""

    @F.arrow_udf("array<struct<start:int,end:int,word:string>>")
    def of(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("word", pa.string())]))
        return pa.array([[(a, b, lexicon.words[k]) for a, b, k in lexicon.matches(t or "")] for t in texts.to_pylist()], kind)

    return of(text)


def joined(text: Column, lexicon: Lexicon, delimiter: str = "_") -> Column:
    """Texts whose dictionary words of several parts are one token each."""

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([lexicon.joined(t, delimiter) for t in texts.to_pylist()], pa.string())

    return of(text)
