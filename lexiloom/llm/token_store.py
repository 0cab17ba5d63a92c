"""Token-id files: static range asymmetric numeral coding in independent blocks.

Documents are range-partitioned and sorted by id, and each task writes its part of
the file: a row for each segment. A segment is one frequency table, counted over the
segment's ids and scaled to 2**SCALE, and the blocks that share it. A block holds whole documents, is
coded on its own by LANES interleaved states, and has checkpoints: at every
STEPS-th step the place in the word stream and all states, so that the pieces
between checkpoints decode in parallel or from the middle. Each piece has a CRC-32
of its ids, and the block has one of all its bytes.

A file is a Parquet folder, since only Spark is sure to reach the shared folder:
columns part, seq (order within the part), first (ids of the part before it), n_docs,
n_tokens, payload. Segments are read without regard to each other. Segment payload:
numbers of table and block bytes, table, blocks. Block payload: header, document directory (id presence, ids, counts), lane
states, checkpoints, piece checksums, words (all little-endian). Parts and sequence
numbers ascend with the document id.

Cases: a null or empty text has its end id only; bytes that aren't UTF-8 are encoded as
U+FFFD; ids are integers (any other type is refused); a null id comes first; rows with
one id lie together, each with its own tokens; a text of any length makes one block; an
empty table makes an empty file; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lexiloom.llm.pretok import library_memo
from lexiloom.llm.store import Shelf, small_batches, whole_text

SCALE, LANES, STEPS = 20, 512, 128
LOW = np.uint64(1 << 31)
#: Ids of a segment, and of a block, at least (the last one has what is left).
SEGMENT, BLOCK = 1 << 21, 1 << 18
HEADER = struct.Struct("<4sHHIIIII")
MAGIC = b"RANS"
FILE = "part int, seq int, first long, n_docs int, n_tokens long, payload binary"


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of sum 2**scale, 1 at least for a symbol that is found."""
    total, room = int(counts.sum()), 1 << scale
    if not total:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * room // total), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    over = int(freq.sum()) - room
    for s in order:  # the most frequent give or take the rest
        if not over:
            break
        cut = over if over < 0 else min(over, int(freq[s]) - 1)
        freq[s] -= cut
        over -= cut
    if over:
        raise ValueError("more symbols than the scale has room for")
    return freq


class Table:
    """A shared frequency table: symbols that are found, and their frequencies."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self._symbols: np.ndarray | None = None

    @property
    def symbols(self) -> np.ndarray:
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbols

    def to_bytes(self) -> bytes:
        own = np.flatnonzero(self.freq)
        return struct.pack("<II", len(self.freq), len(own)) + own.astype("<u4").tobytes() + self.freq[own].astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        n, m = struct.unpack_from("<II", raw)
        own, f = np.frombuffer(raw, "<u4", m, 8), np.frombuffer(raw, "<u4", m, 8 + 4 * m)
        freq = np.zeros(n, np.int64)
        freq[own] = f
        return cls(freq)


def encode_ids(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(first states of the decoder, words, checkpoints) of ids. Step t codes ids[t * LANES :]
    with lane i for the i-th; steps are coded from the last to the first. A checkpoint
    is (words before it, states) for steps STEPS, 2 * STEPS ..."""
    steps = -(-len(ids) // LANES)
    state = np.full(LANES, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks = []
    for t in range(steps - 1, -1, -1):
        own = ids[t * LANES : (t + 1) * LANES]
        f, s = table.freq[own], table.start[own]
        x = state[: len(own)]
        full = x >= (f << np.uint64(63 - SCALE))
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[: len(own)] = (q << np.uint64(SCALE)) + (x - q * f) + s
        if t and t % STEPS == 0:
            marks.append((len(words), state.copy()))
    sizes = np.cumsum([0, *(len(w) for w in words)])
    total = int(sizes[-1])
    # the decoder reads the steps' words in its own order: the last written first
    return state, np.concatenate(words[::-1]) if words else np.zeros(0, "<u4"), [(total - int(sizes[k]), st) for k, st in reversed(marks)]


def decode_ids(n: int, first: int, last: int, state: np.ndarray, words: np.ndarray, at: int, table: Table) -> np.ndarray:
    """Ids of the steps first to last (exclusive) of a block of n ids, from the states before ``first``."""
    out = np.empty(min(n, last * LANES) - first * LANES, np.uint32)
    state = state.astype(np.uint64).copy()
    low = np.uint64((1 << SCALE) - 1)
    symbols = table.symbols
    for t in range(first, last):
        k = min(LANES, n - t * LANES)
        x = state[:k]
        slot = x & low
        own = symbols[slot.astype(np.int64)]
        out[(t - first) * LANES : (t - first) * LANES + k] = own
        x = table.freq[own] * (x >> np.uint64(SCALE)) + slot - table.start[own]
        need = np.flatnonzero(x < LOW)
        if len(need):
            x[need] = (x[need] << np.uint64(32)) | words[at : at + len(need)]
            at += len(need)
        state[:k] = x
    return out


def pack_block(ids: np.ndarray, docs: list[tuple[int | None, int]], table: Table) -> bytes:
    state, words, marks = encode_ids(ids, table)
    sums = [zlib.crc32(ids[k : k + STEPS * LANES].astype("<u4").tobytes()) for k in range(0, len(ids), STEPS * LANES)]
    body = b"".join([
        np.array([d is not None for d, _ in docs], np.uint8).tobytes(), np.array([d or 0 for d, _ in docs], "<i8").tobytes(), np.array([n for _, n in docs], "<i8").tobytes(),
        state.astype("<u8").tobytes(), *(struct.pack("<I", at) + st.astype("<u8").tobytes() for at, st in marks), np.array(sums, "<u4").tobytes(), words.tobytes(),
    ])
    return HEADER.pack(MAGIC, 1, LANES, STEPS, len(docs), len(ids), len(words), zlib.crc32(body)) + body


class Block:
    """A block's parts; ``piece(k)`` decodes from checkpoint k, ``ids()`` all pieces."""

    def __init__(self, raw: bytes, table: Table):
        magic, version, lanes, self.steps, n_docs, self.n, n_words, crc = HEADER.unpack_from(raw)
        if magic != MAGIC or version != 1 or lanes != LANES:
            raise ValueError("not a block of this format")
        if zlib.crc32(memoryview(raw)[HEADER.size :]) != crc:
            raise ValueError("a block's bytes don't match its checksum")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        known, ids, counts = take("u1", n_docs), take("<i8", n_docs), take("<i8", n_docs)
        self.docs = [(i if k else None, c) for k, i, c in zip(known.tolist(), ids.tolist(), counts.tolist(), strict=True)]
        self.table, self.marks = table, [(0, take("<u8", LANES))]
        pieces = -(-self.n // (self.steps * LANES))
        for _ in range(pieces - 1):
            self.marks.append((int(take("<u4", 1)[0]), take("<u8", LANES)))
        self.sums, self.words = take("<u4", pieces), take("<u4", n_words)

    def piece(self, k: int) -> np.ndarray:
        at, state = self.marks[k]
        out = decode_ids(self.n, k * self.steps, min((k + 1) * self.steps, -(-self.n // LANES)), state, self.words, at, self.table)
        if zlib.crc32(out.astype("<u4").tobytes()) != self.sums[k]:
            raise ValueError("decoded ids don't match their checksum")
        return out

    def ids(self) -> np.ndarray:
        pieces = [self.piece(k) for k in range(-(-self.n // (self.steps * LANES)))]
        return np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)


def pack_segment(held: list[tuple[int | None, np.ndarray]], block: int = BLOCK) -> bytes:
    every = np.concatenate([ids for _, ids in held])
    table = Table(scaled(np.bincount(every)))
    blocks, first, at, n = [], 0, 0, 0
    for k, (_, ids) in enumerate(held):
        n += len(ids)
        if n >= block or k == len(held) - 1:
            blocks.append(pack_block(every[at : at + n], [(d, len(i)) for d, i in held[first : k + 1]], table))
            first, at, n = k + 1, at + n, 0
    raw = table.to_bytes()
    return struct.pack(f"<{2 + len(blocks)}I", len(blocks), len(raw), *map(len, blocks)) + raw + b"".join(blocks)


def unpack_segment(raw: bytes) -> Iterator[Block]:
    n, at = struct.unpack_from("<II", raw)
    sizes = struct.unpack_from(f"<{n}I", raw, 8)
    begin = 8 + 4 * n
    table = Table.from_bytes(raw[begin : begin + at])
    begin += at
    for size in sizes:
        yield Block(raw[begin : begin + size], table)
        begin += size


def segments_of(docs: Iterator[tuple[int | None, np.ndarray]], segment: int = SEGMENT, block: int = BLOCK) -> Iterator[tuple[int, int, int, bytes]]:
    """(ids before it, n_docs, n_tokens, payload) of each segment of documents in order."""
    held: list[tuple[int | None, np.ndarray]] = []
    size = first = 0
    for doc in docs:
        held.append(doc)
        size += len(doc[1])
        if size >= segment:
            yield first, len(held), size, pack_segment(held, block)
            held, size, first = [], 0, first + size
    if held:
        yield first, len(held), size, pack_segment(held, block)


@lru_cache(maxsize=2)
def _encoder(path: str, end_id: int) -> Callable[[list[str]], Iterator[np.ndarray]]:
    def ids(texts: list[str]) -> Iterator[np.ndarray]:
        flat, counts = library_memo(path)(texts)
        end = np.array([end_id], np.uint32)
        at = 0
        for n in counts.tolist():
            yield np.concatenate([flat[at : at + n], end])
            at += n

    return ids


def write_tokens(docs: DataFrame, path: str, vocab: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the token ids of ``docs`` (library ids of a text, then end_id) to the folder ``path``."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col}: the file's directory holds integers of 64 bits")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(F.col(text_col)).alias("text"))
    # equal ids (nulls, say) are dealt out by their texts
    rows = rows.repartitionByRange(parts, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        of = _encoder(vocab, end_id)
        docs = (pair for b in batches for pair in zip(b.column(0).to_pylist(), of(b.column(1).to_pylist()), strict=True))
        for seq, (first, n_docs, n_tokens, payload) in enumerate(segments_of(docs)):
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "first": pa.array([first], pa.int64()), "n_docs": pa.array([n_docs], pa.int32()), "n_tokens": pa.array([n_tokens], pa.int64()), "payload": pa.array([payload], pa.binary())})

    rows.mapInArrow(encode, FILE).write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(FILE).parquet(path)


def read_tokens(spark: SparkSession, path: str, each: Callable[[np.ndarray], object], made: str) -> DataFrame:
    """(doc_id, start, n_tokens, made) of a file's documents; ``each`` makes the last, long or
    array<long>, from a document's ids (``lambda ids: ids`` with array<long> gives the ids)."""
    file = spark.read.schema(FILE).parquet(path)
    # one row for each part, and parts are as many as the writing tasks: a small window
    sizes = file.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, start, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                for block in unpack_segment(raw.as_py()):
                    ids = block.ids()
                    counts = np.array([n for _, n in block.docs], np.int64)
                    ends = np.cumsum(counts)
                    own = [each(ids[e - n : e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                    columns = [pa.array([part] * len(own), pa.int32()), pa.array([d for d, _ in block.docs], pa.int64()), pa.array(start + ends - counts, pa.int64()), pa.array(counts, pa.int64()), pa.array(own, kind)]
                    yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "at", "n_tokens", "made"])
                    start += len(ids)

    kind = pa.list_(pa.int64()) if made.startswith("array") else pa.int64()
    got = file.select("part", "first", "payload").mapInArrow(decode, f"part int, doc_id long, at long, n_tokens long, made {made}")
    return got.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "made")


def token_file(docs: DataFrame, vocab: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes a token file in the shared folder and gives its place."""
    path = f"{Shelf(docs.sparkSession, 'tokens').path}/ids"
    write_tokens(docs, path, vocab, end_id, id_col, text_col)
    return path


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
