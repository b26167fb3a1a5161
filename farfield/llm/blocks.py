"""Blocks of documents, and the exchange of what is counted over all of them.

A corpus is written once to the shared folder as rows that each hold a few MB of compressed texts. A pass over the
blocks works on arrays; what must be known of the whole corpus (in how many documents a string occurs, say) goes as
sorted arrays of keys, one for each block and range of keys, to the task of that range, and comes back to the block as
an array in the same order. So no row is made for each key, a key comes once from each block however often it occurs
there, and a range's task holds a bounded number of keys.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.llm.common import stored

#: Bytes of text in a block, about; a longer document is a block of its own.
BLOCK_BYTES = 4_000_000
#: Documents in a block, at most.
BLOCK_ROWS = 200_000
#: Keys in a range, about.
RANGE_KEYS = 1_500_000
#: Powers that a worker keeps for the next block.
KEPT = 2_200_000
#: Bytes of text that words are hashed in at a time.
HASHED = 500_000
BLOCK_SCHEMA = "block long, n_bytes long, data binary"
KEY_SCHEMA = "block long, range int, data binary"


def give_back() -> None:
    """Returns freed memory to the system: workers live on while stages run that need none of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class Block:
    """Documents: ids (0 where null), known (id isn't null), ends of their texts, and the texts' bytes in a row."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, ends: np.ndarray, text: bytes):
        self.ids, self.known, self.ends, self.text = ids, known, ends, text

    def encode(self) -> bytes:
        head = np.array([len(self.ids)], dtype=np.int64).tobytes()
        raw = b"".join([head, self.ids.astype(np.int64).tobytes(), self.ends.astype(np.int64).tobytes(), self.known.astype(np.uint8).tobytes(), self.text])
        return zstandard.ZstdCompressor(level=3).compress(raw)

    @classmethod
    def decode(cls, data: bytes) -> Block:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
        ids, ends = np.frombuffer(raw, dtype=np.int64, count=2 * n, offset=8).reshape(2, n)
        known = np.frombuffer(raw, dtype=np.uint8, count=n, offset=8 + 16 * n).astype(bool)
        return cls(ids, known, ends, raw[8 + 17 * n :])

    def texts(self) -> list[bytes]:
        ends = self.ends.tolist()
        return [self.text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def make_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """The documents as stored blocks: block (a number of no meaning), n_bytes, data. Null texts are empty."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 20
        ids, texts, held = [], [], 0

        def out() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64) if texts else np.empty(0, dtype=np.int64)
            block = Block(np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is not None for i in ids]), ends, b"".join(texts))
            return pa.RecordBatch.from_arrays([pa.array([made]), pa.array([held]), pa.array([block.encode()], type=pa.binary())], names=["block", "n_bytes", "data"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if texts and (held + len(t) > size or len(texts) >= BLOCK_ROWS):
                        yield out()
                        made, ids, texts, held = made + 1, [], [], 0
                    ids.append(i)
                    texts.append(t)
                    held += len(t)
        if texts:
            yield out()

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    return stored(own.mapInArrow(cut, BLOCK_SCHEMA), "blocks", "uncompressed")


def corpus_bytes(blocks: DataFrame) -> int:
    return blocks.agg(F.sum("n_bytes")).first()[0] or 0


def ranges(keys: int) -> int:
    """So many ranges for about so many keys in all blocks."""
    return max(1, -(-keys // RANGE_KEYS))


def range_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The range of 64-bit keys that are spread evenly, by their leading 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def cuts(keys: np.ndarray, n: int) -> np.ndarray:
    """Where the ranges begin and end in sorted keys."""
    return np.searchsorted(range_of(keys, n), np.arange(n + 1))


def key_batch(block: int, parts: dict[int, bytes]) -> pa.RecordBatch:
    parts = {k: v for k, v in parts.items() if v}
    return pa.RecordBatch.from_arrays([pa.array([block] * len(parts), type=pa.int64()), pa.array(list(parts), type=pa.int32()), pa.array(list(parts.values()), type=pa.binary())], names=["block", "range", "data"])


def over_blocks(blocks: DataFrame, f: Callable[[int, Block], Iterator[pa.RecordBatch]], schema: str = KEY_SCHEMA) -> DataFrame:
    """f of each block's number and documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
                yield from f(k, Block.decode(data.as_py()))
                give_back()

    return blocks.select("block", "data").mapInArrow(run, schema)


def answered(keys: DataFrame, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """answer gets what all blocks have of one range, and gives a reply to each."""

    def run(group: pa.Table) -> pa.Table:
        replies = answer([x.as_py() for x in group.column("data")])
        give_back()
        return pa.table({"block": group.column("block"), "range": group.column("range"), "data": pa.array(replies, type=pa.binary())})

    return keys.groupBy("range").applyInArrow(run, KEY_SCHEMA)


def with_answers(blocks: DataFrame, answers: DataFrame, f: Callable[[int, Block, dict[int, bytes]], pa.Table], schema: str) -> DataFrame:
    """f of each block's number and documents and the replies to it by range."""

    def run(own: pa.Table, replies: pa.Table) -> pa.Table:
        got = dict(zip(replies.column("range").to_pylist(), (x.as_py() for x in replies.column("data")), strict=True))
        out = f(own.column("block")[0].as_py(), Block.decode(own.column("data")[0].as_py()), got)
        del own, replies, got
        give_back()
        return out

    return blocks.select("block", "data").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them evenly (splitmix's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(*columns: np.ndarray) -> bytes:
    """Integer columns of one length, the first sorted: compressed differences and values, byte by byte."""
    first = columns[0].astype(np.uint64)
    sides = [np.diff(first, prepend=np.uint64(0)), *[c.astype(np.uint64) for c in columns[1:]]]
    raw = b"".join(s.view(np.uint8).reshape(-1, 8).T.tobytes() for s in sides)
    return zstandard.ZstdCompressor(level=1).compress(raw) if len(first) else b""


def unpacked(data: bytes, columns: int = 1) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data) if data else b"", dtype=np.uint8).reshape(columns, 8, -1)
    sides = [np.ascontiguousarray(r.T).view(np.uint64).reshape(-1) for r in raw] if raw.size else [np.empty(0, dtype=np.uint64)] * columns
    return [np.cumsum(sides[0], dtype=np.uint64), *sides[1:]]


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1024), np.uint64(base), dtype=np.uint64)
        out[0] = 1
        out = np.multiply.accumulate(out)
        if n > KEPT:
            return out[:n]
        _powers[base] = out
    return _powers[base][:n]


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of text[start:end], by differences of a running polynomial and by the first bytes. Words come in
    order; a stretch of HASHED bytes, or one longer word, is looked at at a time."""
    out, at = np.empty(len(starts), dtype=np.uint64), 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + HASHED, side="right")))
        lo, hi = int(starts[at]), int(ends[upto - 1])
        run = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((text[lo:hi].astype(np.uint64) + np.uint64(1)) * powers(hi - lo, _BASE), out=run[1:])
        s, e = starts[at:upto] - lo, ends[at:upto] - lo
        h = (run[e] - run[s]) * powers(hi - lo + 1, _INVERSE)[s]
        out[at:upto] = mixed(h + mixed((e - s).astype(np.uint64)))
        at = upto
    return out


def lookup(keys: np.ndarray, table: np.ndarray, step: int = 1 << 19) -> np.ndarray:
    """Index of each key in a sorted table that holds it: through a hash table, and a search for those that collide."""
    bits = max(8, int(2 * len(table)).bit_length())
    shift, factor = np.uint64(64 - bits), np.uint64(_BASE)
    slots = np.zeros(1 << bits, dtype=np.int32)
    slots[(table * factor) >> shift] = np.arange(len(table), dtype=np.int32)
    out = np.empty(len(keys), dtype=np.int32)
    for a in range(0, len(keys), step):
        some = keys[a : a + step]
        at = slots[(some * factor) >> shift]
        wrong = np.flatnonzero(table[at] != some)
        if len(wrong):
            at[wrong] = np.searchsorted(table, some[wrong])
        out[a : a + step] = at
    return out
