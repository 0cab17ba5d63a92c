"""Splitting of texts for the byte-level BPE vocabulary, and memoised encoders.

``Pretokenizer.split`` gives the same pieces as the library's own
pre-tokenizer. Texts made only of *plain* characters (see ``plain_class``) go
through one compiled pattern of the standard ``re`` module; any other text is
split by the library itself. Special strings of the vocabulary are cut out
first, as the library does by default.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import pairwise

import numpy as np

#: The pre-tokenizer's alternatives, written for ``re`` (letters,
#: decimal digits and the rest are told apart alike for plain characters).
PIECES = r"'(?:[sdmt]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: The white space for which ``re`` and the library agree.
SPACES = "\t\n\x0b\x0c\r \xa0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u3000"
DEFAULT_VOCAB = "byte_bpe_50k.json"


def vocab_path(name: str = DEFAULT_VOCAB) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def plain_class() -> str:
    """A character class of what is *not* plain. Plain are long-assigned letters,
    marks, punctuation and symbols of the basic plane, decimal digits and SPACES:
    those whose class is certain to be the same in every Unicode release."""
    old = unicodedata.ucd_3_2_0
    ranges: list[list[int]] = []
    for cp in range(0x10000):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind != old.category(c):
            ok = False
        elif kind[0] == "L":
            ok = c.isalpha() and not c.isdecimal()
        elif kind == "Nd":
            ok = True
        elif kind in ("No", "Nl", "Cn", "Cs", "Co"):
            ok = False
        elif c.isspace():
            ok = c in SPACES
        elif kind == "Cc":
            ok = 0 < cp < 0x1C
        else:
            ok = not c.isalnum() and kind != "Cf"
        if ok:
            continue
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    ranges.append([0x10000, 0x10FFFF])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]"


class Pretokenizer:
    """Pieces of a text, special strings included as pieces of their own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path}: a byte-level vocabulary without normalizer is expected")
        if spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"{path}: add_prefix_space is not supported")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens with options are not supported")
        self.library = Tokenizer.from_file(path)
        self._find = re.compile(PIECES).findall
        self._odd = re.compile(plain_class()).search
        own = rf"(?:(?!{plain_class()})\S)"
        self._safe = re.compile(rf"(?<={own})[ \n](?={own})").finditer
        names = sorted(self.special, key=len, reverse=True)
        self._marked = all(s.startswith("<|") for s in names)
        self._cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def _plain(self, text: str) -> list[str]:
        if self._odd(text) is None:
            return self._find(text)
        at = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in at]

    def split(self, text: str) -> list[str]:
        if not self._special(text):
            return self._plain(text)
        out: list[str] = []
        for i, part in enumerate(self._cut.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out.extend(self._plain(part))
        return out

    def segments(self, text: str, most: int) -> list[tuple[str, bool]]:
        """(part, whether it is simple) of a text whose pieces are those of its parts. Simple: of
        plain characters only, without special strings, and of ``most`` characters at most. A text
        is cut at special strings, and before a single blank or newline between plain characters that
        are no white space: a piece always begins there, whatever lies around."""
        if self._odd(text) is None and len(text) <= most and not self._special(text):
            return [(text, True)]
        out: list[tuple[str, bool]] = []
        parts = self._cut.split(text) if self._special(text) else [text]
        for i, part in enumerate(parts):
            if i % 2:
                out.append((part, False))
                continue
            if not part:
                continue
            cuts = [0, *(m.start() for m in self._safe(part)), len(part)]
            begin = 0
            kind = self._odd(part, 0, cuts[1]) is None
            for a, b in pairwise(cuts[1:]):
                own = self._odd(part, a, b) is None
                if own != kind or b - begin > most:
                    out.append((part[begin:a], kind and a - begin <= most))
                    begin, kind = a, own
            out.append((part[begin:], kind and len(part) - begin <= most))
        return out

    def _special(self, text: str) -> bool:
        return self._cut is not None and (not self._marked or "<|" in text) and any(s in text for s in self.special)


def load_ranks(path: str) -> tuple[dict[bytes, int], dict[tuple[int, int], tuple[int, int]], list[int]]:
    """(ids by bytes, (left id, right id) -> (rank, merged id), id of each single byte)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    back = byte_of_char()
    raw = lambda s: bytes(back[c] for c in s)
    vocab = {raw(s): i for s, i in model["vocab"].items()}
    ids = model["vocab"]
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
    return vocab, merges, [vocab[bytes([b])] for b in range(256)]


def byte_of_char() -> dict[str, int]:
    """The byte that each character of the vocabulary stands for: printable
    Latin-1 stands for itself, the others follow from U+0100 in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Classes of characters for PieceMemo: 0 between texts, then letter, digit, white space, other.
LETTER, DIGIT, BLANK, OTHER = 1, 2, 3, 4
#: The endings that the pattern cuts off behind a lone apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Pieces of more characters than this are never kept by their hash.
LONGEST = 64
#: Characters handled at a time.
CHUNK = 1 << 19
NOTHING = np.zeros(0, np.uint32)
#: Masks of none to four characters of 16 bits.
FIRST_CHARS = np.array([(1 << 16 * k) - 1 for k in range(5)], np.uint64)


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    out = np.full(0x10000, OTHER, np.uint8)
    for cp in range(0x10000):
        c = chr(cp)
        if c.isspace():
            out[cp] = BLANK
        elif c.isdecimal():
            out[cp] = DIGIT
        elif c.isalpha():
            out[cp] = LETTER
    out[0] = 0
    return out


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64, for a chunk's places."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    n = CHUNK + 2 * LONGEST
    grow = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]), dtype=np.uint64)
    return grow(base), grow(inverse)


class PieceMemo:
    """Values of pieces, computed once for each distinct piece.

    ``fill(pieces)`` gives (flat uint32 values, number of values of each piece); without
    ``values``, the numbers only.
    Whole chunks of text are split and looked up with numpy: class boundaries give
    the pieces, a prefix sum of a polynomial hash gives each piece's key, and an
    open-addressing table gives its entry. An entry keeps the piece's characters,
    and every hit is compared with them: a piece whose key is taken by another piece,
    or that is longer than LONGEST, is computed for its chunk only. The memo holds at
    most ``most`` pieces and starts anew when it is full. Parts of texts with
    characters that are not plain are split by the library, and their pieces are
    kept by a dictionary.
    """

    def __init__(self, pre: Pretokenizer, fill: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 700_000, values: bool = True):
        self.pre, self.fill, self.most, self.values = pre, fill, most, values
        self.slots = 1 << int(2 * most - 1).bit_length()
        self.shift = np.uint64(64 - self.slots.bit_length() + 1)
        self.mix = np.uint64(0xD6E8FEB86659FD93)
        self.reset()

    def reset(self) -> None:
        self.keys = np.zeros(self.slots, np.uint64)
        self.vals = np.zeros(self.slots, np.int32)
        # of an entry: place and number of its values, place and number of its characters
        self.at, self.size, self.text_at, self.text_size = (np.zeros(1024, np.int64) for _ in range(4))
        self.pool, self.chars = np.zeros(4096, np.uint32), np.zeros(4096, np.uint16)
        self.first, self.last = np.zeros(1024, np.uint64), np.zeros(1024, np.uint64)  # an entry's four first and last characters
        self.n = self.used = self.spelt = 0
        self.odd: dict[str, tuple[np.ndarray, int]] = {}

    def _first(self, h: np.ndarray) -> np.ndarray:
        return ((h * self.mix) >> self.shift).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry numbers, -1 for unknown keys."""
        slot = self._first(h)
        key = self.keys[slot]
        out = np.where(key == h, self.vals[slot], np.int32(-1))
        rest = np.flatnonzero((key != h) & (key != 0))
        while rest.size:
            slot[rest] = (slot[rest] + 1) & (self.slots - 1)
            key = self.keys[slot[rest]]
            hit = key == h[rest]
            out[rest[hit]] = self.vals[slot[rest[hit]]]
            rest = rest[~hit & (key != 0)]
        return out

    def _insert(self, h: np.ndarray, flat: np.ndarray, size: np.ndarray, spelling: np.ndarray, length: np.ndarray, ends: tuple[np.ndarray, np.ndarray]) -> None:
        m = len(h)
        while self.n + m > len(self.at):
            self.at, self.size, self.text_at, self.text_size = (np.resize(x, 2 * len(x)) for x in (self.at, self.size, self.text_at, self.text_size))
            self.first, self.last = np.resize(self.first, 2 * len(self.first)), np.resize(self.last, 2 * len(self.last))
        self._room(len(flat))
        while self.spelt + len(spelling) > len(self.chars):
            self.chars = np.resize(self.chars, 2 * len(self.chars))
        self.pool[self.used : self.used + len(flat)] = flat
        self.chars[self.spelt : self.spelt + len(spelling)] = spelling
        new = slice(self.n, self.n + m)
        self.size[new], self.text_size[new] = size, length
        self.first[new], self.last[new] = ends
        self.at[new], self.text_at[new] = self.used + np.cumsum(size) - size, self.spelt + np.cumsum(length) - length
        entry = np.arange(self.n, self.n + m, dtype=np.int32)
        self.n, self.used, self.spelt = self.n + m, self.used + len(flat), self.spelt + len(spelling)
        slot, rest = self._first(h), np.arange(m)
        while rest.size:
            s = slot[rest]
            free = self.keys[s] == 0
            self.keys[s[free]] = h[rest[free]]
            mine = self.keys[s] == h[rest]
            self.vals[s[mine]] = entry[rest[mine]]
            rest = rest[~mine]
            slot[rest] = (slot[rest] + 1) & (self.slots - 1)

    def _room(self, n: int) -> None:
        while self.used + n > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))

    def _cut(self, cp: np.ndarray) -> np.ndarray:
        """Places where pieces and the gaps between texts begin."""
        kind = char_classes()[cp]
        start = np.empty(len(cp), bool)
        start[0] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        gap = cp == 0
        start |= gap
        first = np.flatnonzero(start[1:] & (kind[:-1] == BLANK) & ~gap[1:]) + 1
        start[first - 1] = True  # the last blank goes off by itself, or with what follows
        start[first] = cp[first - 1] != 32
        quote = np.flatnonzero(cp == 39)
        if quote.size:
            quote = quote[start[quote]]
            quote = quote[quote + 1 < len(cp)]
            quote = quote[kind[quote + 1] == LETTER]
            text = cp.tolist() if quote.size > 2000 else cp
            for q in quote:
                for e in ENDINGS:
                    k = q + 1 + len(e)
                    if k <= len(cp) and all(text[q + 1 + i] == ord(c) for i, c in enumerate(e)):
                        start[q + 1] = False
                        if k < len(cp) and kind[k] == LETTER:
                            start[k] = True
                        break
        return np.flatnonzero(start)

    @staticmethod
    def _keys(cp: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        up, down = powers()
        total = np.zeros(len(cp) + 1, np.uint64)
        np.cumsum(cp * up[: len(cp)], dtype=np.uint64, out=total[1:])
        h = (total[end] - total[begin]) * down[begin]
        h[h == 0] = 1
        return h

    @staticmethod
    def _spread(at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The places at[k], at[k] + 1 ... (size[k] of them) of all k, one after the other."""
        ends = np.cumsum(size)
        return np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)

    @staticmethod
    def _ends(cp: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The four first and the four last characters of pieces (all of a shorter one), as numbers."""
        four = np.zeros(len(cp) + 3, np.uint64)
        four[: len(cp)] = cp
        four[:-1] |= four[1:] << np.uint64(16)
        four[:-2] |= four[2:] << np.uint64(32)
        mask = FIRST_CHARS[np.minimum(length, 4)]
        return four[begin] & mask, four[begin + np.maximum(length - 4, 0)] & mask

    def _verified(self, entry: np.ndarray, cp: np.ndarray, begin: np.ndarray, length: np.ndarray, ends: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The entries, -2 where an entry's characters are not those of the piece (and where there is none)."""
        sure = (entry >= 0) & (self.text_size[entry] == length) & (self.first[entry] == ends[0]) & (self.last[entry] == ends[1])
        own = np.flatnonzero(sure & (length > 8))  # shorter ones are all in their ends
        if own.size:
            n = length[own]
            same = self.chars[self._spread(self.text_at[entry[own]], n)] == cp[self._spread(begin[own], n)]
            sure[own] = np.logical_and.reduceat(same, np.cumsum(n) - n)
        return np.where(sure, entry, np.int32(-2))

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat values, number of values) of simple texts; the texts have CHUNK characters at most."""
        joined = "\0".join(texts) + "\0"
        cp = np.frombuffer(joined.encode("utf-16-le", "surrogatepass"), "<u2")
        begin = self._cut(cp)
        end = np.append(begin[1:], len(cp))
        real = cp[begin] != 0
        begin, end = begin[real], end[real]
        length = end - begin
        h, ends = self._keys(cp, begin, end), self._ends(cp, begin, length)
        entry = self._find(h)
        entry[length > LONGEST] = -2
        new = np.flatnonzero(entry == -1)
        if new.size:
            key, where = np.unique(h[new], return_index=True)
            if self.n + len(key) > self.most and self.n:
                self.reset()
                return self._chunk(texts)
            first = new[where]
            flat, size = self.fill([joined[b:e] for b, e in zip(begin[first].tolist(), end[first].tolist(), strict=True)])
            self._insert(key, flat, size, cp[self._spread(begin[first], length[first])], length[first], (ends[0][first], ends[1][first]))
            entry[new] = self._find(h[new])
        entry = self._verified(entry, cp, begin, length, ends)
        size, at = self.size[entry], self.at[entry]
        other = np.flatnonzero(entry == -2)
        if other.size:  # these have their values behind the pool's, for this chunk
            pieces = [joined[b:e] for b, e in zip(begin[other].tolist(), end[other].tolist(), strict=True)]
            own = {p: k for k, p in enumerate(dict.fromkeys(pieces))}
            flat, sizes = self.fill(list(own))
            which = np.array([own[p] for p in pieces])
            size[other] = sizes[which]
            at[other] = self.used + (np.cumsum(sizes) - sizes)[which]
            self._room(len(flat))
            self.pool[self.used : self.used + len(flat)] = flat
        owner = np.searchsorted(np.flatnonzero(cp == 0), begin)
        counts = np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64)
        return self.pool[self._spread(at, size)] if self.values else NOTHING, counts

    def _slow(self, text: str) -> tuple[np.ndarray, int]:
        """Values of a part of a text, and their number, piece after piece by the library's splitting."""
        if text in self.pre.special:
            return np.array([self.pre.special[text]], np.uint32), 1
        pieces = self.pre.split(text)
        own = {p: self.odd.get(p) for p in dict.fromkeys(pieces)}
        missing = [p for p, v in own.items() if v is None]
        if missing:
            flat, size = self.fill(missing)
            ends = np.cumsum(size).tolist() if self.values else [0] * len(missing)
            made = {p: (flat[max(0, e - n) : e], n) for p, e, n in zip(missing, ends, size.tolist(), strict=True)}
            own |= made
            if len(self.odd) + len(made) > self.most // 4:
                self.odd = {}
            self.odd |= {p: (v.copy(), n) for p, (v, n) in made.items() if len(p) <= LONGEST}
        return np.concatenate([NOTHING, *(own[p][0] for p in pieces)]), sum(own[p][1] for p in pieces)

    def _simple(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same as __call__ of simple texts, a chunk at a time."""
        flats, counts, begin, chars = [NOTHING], [np.zeros(0, np.int64)], 0, 0
        for k, t in enumerate([*texts, None]):
            if t is None or chars + len(t) + 1 > CHUNK:
                if k > begin:
                    f, c = self._chunk(texts[begin:k])
                    flats.append(f)
                    counts.append(c)
                begin, chars = k, 0
            chars += len(t or "") + 1
        return np.concatenate(flats), np.concatenate(counts)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat values, number of values of each text)."""
        parts: list[str] = []
        plain: list[bool] = []
        stops = []
        for t in texts:
            for part, simple in self.pre.segments(t or "", CHUNK - 1):
                parts.append(part)
                plain.append(simple)
            stops.append(len(parts))
        if not parts:
            return NOTHING, np.zeros(len(texts), np.int64)
        easy = np.array(plain)
        counts = np.zeros(len(parts), np.int64)
        flat, counts[easy] = self._simple([p for p, e in zip(parts, plain, strict=True) if e])
        if not easy.all():
            odd = [self._slow(parts[k]) for k in np.flatnonzero(~easy).tolist()]
            counts[~easy] = [n for _, n in odd]
            if self.values:
                mine = np.repeat(easy, counts)
                whole = np.empty(len(mine), np.uint32)
                whole[mine], whole[~mine] = flat, np.concatenate([v for v, _ in odd])
                flat = whole
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        return flat, np.diff(total[np.array([0, *stops])])


class LibraryFill:
    """Ids of pieces by the library's own model, for PieceMemo: a piece isn't split again, and no threads are started."""

    def __init__(self, pre: Pretokenizer):
        self.special, self.model = pre.special, pre.library.model
        self.chars = {b: ord(c) for c, b in byte_of_char().items()}

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        size: list[int] = []
        tokenize, chars = self.model.tokenize, self.chars
        for p in pieces:
            ids = [self.special[p]] if p in self.special else [t.id for t in tokenize(p.encode().decode("latin-1").translate(chars))]
            flat += ids
            size.append(len(ids))
        return np.array(flat, np.uint32), np.array(size, np.int64)


@lru_cache(maxsize=2)
def library_memo(path: str) -> PieceMemo:
    """A worker's own memo of library ids; it lives as long as the worker."""
    pre = Pretokenizer(path)
    return PieceMemo(pre, LibraryFill(pre))
