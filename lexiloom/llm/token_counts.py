"""Token counts by heap-and-linked-list byte-pair merging.

A piece's bytes are the first symbols, in a doubly linked list. A heap holds the
adjacent pairs that merge, by rank and then place; the lowest is popped again and
again, and an entry whose pair has changed meanwhile is passed over. The count of
tokens is the number of first symbols less the number of merges: no identifier of
a token is given out. Distinct pieces are counted once for each worker's memo.

Cases: null and empty texts have 0 tokens and 0 bytes; special strings of the
vocabulary inside a text are one token each, as the library has it; a text of any
length is counted whole; bytes that aren't UTF-8 count as U+FFFD; an empty table gives
an empty result; repeated rows are counted one by one; further columns don't matter,
whatever their names.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.llm.pretok import PieceMemo, Pretokenizer, load_ranks
from lexiloom.llm.store import whole_text


class HeapCounter:
    """Numbers of tokens of pieces, as the ``fill`` of a PieceMemo."""

    def __init__(self, path: str):
        _, self.merges, self.first = load_ranks(path)

    def count(self, raw: bytes) -> int:
        symbol = [self.first[b] for b in raw]
        n = len(symbol)
        merges, get = 0, self.merges.get
        heap = []
        for i in range(n - 1):
            if (m := get((symbol[i], symbol[i + 1]))) is not None:
                heap.append((m[0], i, m[1]))
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, i, made = heappop(heap)
            j = after[i] if symbol[i] >= 0 else n
            if j >= n or (m := get((symbol[i], symbol[j]))) is None or m[0] != rank:
                continue
            merges += 1
            symbol[i], symbol[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := get((made, symbol[k]))) is not None:
                    heappush(heap, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := get((symbol[h], made))) is not None:
                heappush(heap, (m[0], h, m[1]))
        return n - merges

    def __call__(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(0, np.uint32), np.array([self.count(p.encode()) for p in pieces], np.int64)


@lru_cache(maxsize=2)
def _memo(path: str) -> PieceMemo:
    return PieceMemo(Pretokenizer(path), HeapCounter(path), values=False)


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of a text column; ``path`` is the vocabulary's, on every executor."""

    @F.arrow_udf("long")
    def counts(texts: pa.Array) -> pa.Array:
        return pa.array(_memo(path)(texts.to_pylist())[1], pa.int64())

    return counts(whole_text(text))
