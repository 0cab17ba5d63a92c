"""Byte-pair encoding and decoding, with a segment tree over adjacent pair ranks.

The leaves are a piece's adjacent pairs, each with its rank and place (none: beyond
all). The root is then the leftmost pair of the lowest rank. A merge changes three
leaves: its own, its left neighbour's, and that of the symbol that went; each update
takes logarithmic time. It ends when the root is a pair that doesn't merge.

Cases: null and empty texts have no ids; no ids decode to the empty text; null ids
decode as none; special strings of the vocabulary inside a text are their own id;
bytes that aren't UTF-8 decode to U+FFFD, as the library has it; ids beyond the
vocabulary are left out; a text's bytes that aren't UTF-8 are encoded as U+FFFD; texts
of any length are taken whole; an empty table gives an empty result; repeated rows are
rows of their own; further columns don't matter, whatever their names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.llm.pretok import PieceMemo, Pretokenizer, load_ranks
from lexiloom.llm.store import whole_text

NONE = 1 << 62


class TreeEncoder:
    """Ids of pieces, as the ``fill`` of a PieceMemo."""

    def __init__(self, path: str):
        _, self.merges, self.first = load_ranks(path)

    def encode(self, raw: bytes) -> list[int]:
        symbol = [self.first[b] for b in raw]
        n = len(symbol)
        if n < 2:
            return symbol
        get, wide = self.merges.get, 1 << (n - 2).bit_length()
        shift = wide.bit_length()
        tree = [NONE] * (2 * wide)
        for i in range(n - 1):
            if (m := get((symbol[i], symbol[i + 1]))) is not None:
                tree[wide + i] = m[0] << shift | i
        for k in range(wide - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(at: int, value: int) -> None:
            k = wide + at
            if tree[k] == value:
                return
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    return
                tree[k] = low
                k >>= 1

        while tree[1] != NONE:
            i = tree[1] & ((1 << shift) - 1)
            j = after[i]
            made = symbol[i] = get((symbol[i], symbol[j]))[1]
            symbol[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                put(j, NONE)
            if k < n:
                before[k] = i
                m = get((made, symbol[k]))
                put(i, NONE if m is None else m[0] << shift | i)
            else:
                put(i, NONE)
            if (h := before[i]) >= 0:
                m = get((symbol[h], made))
                put(h, NONE if m is None else m[0] << shift | h)
        return [s for s in symbol if s >= 0]

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        size = []
        for p in pieces:
            ids = self.encode(p.encode())
            flat += ids
            size.append(len(ids))
        return np.array(flat, np.uint32), np.array(size, np.int64)


class Decoder:
    """Texts of ids: the ids' bytes are gathered with numpy and read as UTF-8."""

    def __init__(self, path: str):
        pre = Pretokenizer(path)
        of = {i: raw for raw, i in load_ranks(path)[0].items()} | {i: s.encode() for s, i in pre.special.items()}
        most = max(of) + 1
        self.size = np.zeros(most + 1, np.int64)  # the last is any id beyond the vocabulary
        for i, raw in of.items():
            self.size[i] = len(raw)
        self.at = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(of.get(i, b"") for i in range(most)) + b"\0", np.uint8)

    def __call__(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        ids = np.minimum(flat.astype(np.int64) & 0xFFFFFFFF, len(self.size) - 1)
        size = self.size[ids]
        ends = np.cumsum(size)
        raw = self.pool[np.repeat(self.at[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        stops = np.concatenate([np.zeros(1, np.int64), ends])[np.cumsum(counts)].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip([0, *stops[:-1]], stops, strict=True)] if stops else []


@lru_cache(maxsize=2)
def _memo(path: str) -> PieceMemo:
    return PieceMemo(Pretokenizer(path), TreeEncoder(path))


@lru_cache(maxsize=2)
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(text: Column, path: str) -> Column:
    """array<int> of a text column's token ids; ``path`` is the vocabulary's, on every executor."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        flat, counts = _memo(path)(texts.to_pylist())
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat.astype(np.int32)))

    return ids(whole_text(text))


def decode(ids: Column, path: str) -> Column:
    """The text of an array<int> column of token ids, special strings included."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array(_decoder(path)(lists.flatten().to_numpy(zero_copy_only=False), counts), pa.string())

    return texts(ids)
