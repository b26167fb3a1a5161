"""Packing documents into sequences by minimum bin slack, on the histogram of lengths."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farfield.llm.common import stored
from farfield.llm.token_ids import word_ids

CAPACITY = 4096
END_ID = 1
#: Pieces in each independently numbered part of those of one length.
PART_ROWS = 50_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and then END_ID, cut into pieces: id, piece, start, length, ids_crc32."""
    path, end = path or tokenizer_path(), np.array([END_ID], dtype="<u4").tobytes()
    schema = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(path)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc, raw in zip(ids, ids_of(batch.column(1).to_pylist()), strict=True):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(schema)], schema=schema)

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return own.mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths, each at most as often as counted, that fills room best.

    Subset-sum dynamic programming: bit s of reach says that sum s can be made. Lengths come longest first, with their
    multiplicities in powers of two; the sums before each step are kept to trace the combination back.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left, power = min(counts[length], room // length), 1
        while left > 0:
            times = min(power, left)
            grown = (reach | reach << (times * length)) & mask
            if grown != reach:
                steps.append((length, times, reach))
                reach = grown
            left, power = left - times, 2 * power
        if reach >> room & 1:
            break
    at, found = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            found[length] = found.get(length, 0) + times
            at -= times * length
    return found


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Minimum bin slack: (bins, lengths in each of them with their numbers), until every counted length is used.

    Each bin holds the longest length left and what fills the rest of it best. The same combination is then taken for
    as many bins as the counts allow, so the work depends on the number of different lengths (at most capacity), not
    on the number of pieces.
    """
    counts, found = {k: n for k, n in counts.items() if n}, []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        bin_ = fullest({k: n for k, n in counts.items() if n and k <= capacity - longest}, capacity - longest)
        counts[longest] += 1
        bin_[longest] = bin_.get(longest, 0) + 1
        bins = min(counts[k] // n for k, n in bin_.items())
        for k, n in bin_.items():
            counts[k] -= bins * n
            if not counts[k]:
                del counts[k]
        found.append((bins, bin_))
    return found


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts are empty and still have their end id. Rows that share an id, or are equal, are packed each. An empty
    table gives an empty result; other columns are ignored. Only the histogram of lengths (at most capacity rows)
    comes to the driver; pieces are numbered within their length by hashed parts, so a length may hold any share of
    the rows, and each takes its place in the plan by its number.
    """
    found = stored(pieces(docs, id_col, text_col, path, capacity), "pieces")
    parts = max(1, -(-found.count() // PART_ROWS))
    found = found.withColumn("part", F.pmod(F.xxhash64("id", "piece"), F.lit(parts)))
    held = stored(found.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    taken, bins, rows = dict.fromkeys(counts, 0), 0, []
    for n, bin_ in plan(counts, capacity):
        at = 0
        for length, times in sorted(bin_.items(), reverse=True):
            rows.append((length, taken[length], times, bins, at))
            taken[length] += n * times
            at += length * times
        bins += n
    places = np.array(sorted(rows) or np.empty((0, 5)), dtype=np.int64).reshape(-1, 5)
    firsts = {int(k): (int(i), int(j)) for k, i, j in zip(*_runs(places[:, 0]), strict=True)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, nth = (batch.column(i).to_numpy() for i in (3, 5))
            at = np.empty(len(lengths), dtype=np.int64)
            for length in np.unique(lengths).tolist():
                i, j = firsts[length]
                own = lengths == length
                at[own] = i + np.searchsorted(places[i:j, 1], nth[own], side="right") - 1
            row = places[at]
            k = nth - row[:, 1]
            more = [pa.array(row[:, 3] + k // row[:, 2]), pa.array(row[:, 4] + k % row[:, 2] * lengths)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *more], names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    base = held.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).select("length", "part", "base")
    nth = F.row_number().over(Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32"))
    numbered = found.withColumn("nth", nth - 1).join(base, ["length", "part"])
    numbered = numbered.select("id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("nth"))
    out = numbered.mapInArrow(place, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, first = np.unique(keys, return_index=True)
    return values, first, np.append(first[1:], len(keys))[: len(first)]
