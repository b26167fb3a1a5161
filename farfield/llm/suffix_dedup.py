"""Repeated passages by a sorted suffix array: sampled splitters, range buckets, multikey quicksort within each.

All suffixes of a corpus can't be moved, so two things come before the sort, neither of which can lose a repeat. Of the
LEAD-byte strings in each window of SPAN bytes, the one with the least hash is its anchor; equal windows have equal
anchors at equal places. Anchors that only one document holds belong to no repeat, and drop out by an exchange of
their hashes. Adjacent windows with one anchor go as one string. So the suffixes that are sorted are those that begin
at the windows around shared anchors; a bucket is a range of what anchors begin with, and holds all equal windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.llm.blocks import KEY_SCHEMA, Block, answered, corpus_bytes, cuts, key_batch, make_blocks, mixed, over_blocks, packed, powers, ranges, unpacked, with_answers
from farfield.llm.common import stored

SPAN = 50
LEAD = 20
#: Anchor places in a window.
PLACES = SPAN - LEAD + 1
#: Splitters come from about so many sampled anchors.
SAMPLE = 50_000
#: Bytes of strings in a bucket, about.
BUCKET_BYTES = 6_000_000
#: Bytes of text in a block, about: some eight arrays of that many integers are held at once.
BLOCK = 2_000_000
OUT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_BASE = 0x9E3779B97F4A7C15
NONE = np.iinfo(np.int64).min


class Anchored:
    """A block's windows. text: its bytes; doc: of each document's row, its order (ids; null is least); starts, anchors:
    of each run of windows with one anchor, the first window and the anchor; counts: windows in it; keys: anchors' hashes;
    owner: the run's document."""

    def __init__(self, block: Block):
        self.text = np.frombuffer(block.text, dtype=np.uint8)
        self.order = np.where(block.known, block.ids, NONE)
        ends = block.ends
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        n = len(self.text)
        empty = np.empty(0, dtype=np.int64)
        self.starts = self.anchors = self.counts = self.owner = empty
        self.keys = empty.astype(np.uint64)
        if n < SPAN:
            return
        run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * powers(n, _BASE), out=run[1:])
        hashes = run[LEAD:] - run[:-LEAD]
        del run
        hashes = mixed(hashes * powers(n + 1, pow(_BASE, -1, 1 << 64))[: n - LEAD + 1])
        # the leftmost of the least: hash before place
        least = hashes >> np.uint64(24) << np.uint64(24) | np.arange(len(hashes), dtype=np.uint64)
        if n >= 1 << 24:
            # places take 24 bits: a longer document is looked at in turns that overlap
            return self._long(hashes, begins, ends)
        width = 1
        while 2 * width <= PLACES:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < PLACES:
            more = PLACES - width
            least = np.minimum(least[:-more], least[more:])
        self._runs((least & np.uint64((1 << 24) - 1)).astype(np.int64), hashes, begins, ends)

    def _long(self, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        parts, step = [], 1 << 23
        for at in range(0, len(hashes) - PLACES + 1, step):
            own = hashes[at : at + step + PLACES - 1]
            least, width = own >> np.uint64(24) << np.uint64(24) | np.arange(len(own), dtype=np.uint64), 1
            while 2 * width <= PLACES:
                least, width = np.minimum(least[:-width], least[width:]), 2 * width
            if width < PLACES:
                least = np.minimum(least[: width - PLACES], least[PLACES - width :])
            parts.append((least & np.uint64((1 << 24) - 1)).astype(np.int64) + at)
        self._runs(np.concatenate(parts), hashes, begins, ends)

    def _runs(self, anchor: np.ndarray, hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        inside = np.zeros(len(self.text) + 1, dtype=np.int8)
        long = ends - begins >= SPAN
        np.add.at(inside, begins[long], 1)
        np.add.at(inside, ends[long] - SPAN + 1, -1)
        windows = np.flatnonzero(np.cumsum(inside[: len(anchor)], dtype=np.int8))
        if not len(windows):
            return
        at = anchor[windows]
        first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)]))
        self.starts, self.anchors = windows[first], at[first]
        self.counts = np.diff(np.append(first, len(windows)))
        # anchors have the least hashes around: they are spread again, or all would fall into one range of keys
        self.keys = mixed(hashes[self.anchors])
        self.owner = np.searchsorted(ends, self.starts, side="right")

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchors' hashes, sorted, and 1 or 2: whether one document holds them or more."""
        order = np.lexsort((self.order[self.owner], self.keys)) if len(self.keys) else np.empty(0, dtype=np.int64)
        keys, docs = self.keys[order], self.order[self.owner][order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
        if not len(first):
            return keys, order
        return keys[first], 1 + (np.maximum.reduceat(docs, first) > np.minimum.reduceat(docs, first))


def _shared(pieces: list[bytes]) -> list[bytes]:
    """Of the blocks' anchors, which more than one document holds. (A document lies in one block.)"""
    sides = [unpacked(p, 2) for p in pieces]
    keys, n = np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides]).astype(np.int64)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    many = keys[first][np.add.reduceat(n, first) > 1]
    out = []
    for own, _ in sides:
        at = np.minimum(np.searchsorted(many, own), max(0, len(many) - 1))
        out.append(np.packbits(many[at] == own if len(many) else np.zeros(len(own), dtype=bool)).tobytes())
    return out


def words_at(text: np.ndarray) -> np.ndarray:
    """Of each place, its eight bytes as an integer whose order is that of the bytes; text ends with eight more."""
    n = len(text) - 8
    out = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | text[k : k + n]
    return out


def multikey_groups(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the SPAN-byte strings at starts: their order, and the number of each one's group of equals in that order.

    Multikey quicksort on eight bytes at a time: groups that agree so far are sorted by their next eight bytes where
    these differ; a group of one, or one whose members agree in them, isn't touched.
    """
    order = np.argsort(words[starts], kind="stable")
    key = words[starts[order]]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    for depth in [*range(8, SPAN - 8, 8), SPAN - 8]:
        key = words[starts[order] + depth]
        differs = np.concatenate([[False], (key[1:] != key[:-1]) & ~new[1:]])
        if not differs.any():
            continue
        group = np.cumsum(new) - 1
        mixed_ = np.zeros(group[-1] + 1, dtype=bool)
        mixed_[group[differs]] = True
        at = np.flatnonzero(mixed_[group])
        again = at[np.lexsort((key[at], group[at]))]
        order[at], key[at] = order[again], key[again]
        new |= np.concatenate([[True], key[1:] != key[:-1]])
    return order, np.cumsum(new) - 1


def _sort_bucket(pieces: list[bytes]) -> list[bytes]:
    """For the strings of each block: a mask of their windows that also start in a document with a smaller id."""
    index: dict[bytes, int] = {}
    blocks, least = [], []
    for piece in pieces:
        n = int(np.frombuffer(piece, dtype=np.int64, count=1)[0])
        docs = np.frombuffer(piece, dtype=np.int64, count=n, offset=8)
        counts = np.frombuffer(piece, dtype=np.uint8, count=n, offset=8 + 8 * n).astype(np.int64)
        text, at, own = piece[8 + 9 * n :], 0, np.empty(n, dtype=np.int64)
        for k, (count, doc) in enumerate(zip(counts.tolist(), docs.tolist(), strict=True)):
            string = text[at : at + count + SPAN - 1]
            at += count + SPAN - 1
            own[k] = i = index.setdefault(string, len(index))
            if i == len(least):
                least.append(doc)
            elif doc < least[i]:
                least[i] = doc
        blocks.append((docs, own))
    strings = list(index)
    counts = np.array([len(s) - SPAN + 1 for s in strings], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(counts + SPAN - 1)[:-1]])
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    starts = np.repeat(begins - first, counts) + np.arange(counts.sum())
    owner = np.repeat(np.arange(len(strings)), counts)
    order, group = multikey_groups(words_at(np.frombuffer(b"".join([*strings, bytes(8)]), dtype=np.uint8)), starts)
    docs = np.array(least, dtype=np.int64)[owner]
    low = np.minimum.reduceat(docs[order], np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])))
    lowest = np.empty(len(starts), dtype=np.int64)
    lowest[order] = low[group]
    out = []
    for docs, own in blocks:
        sizes = counts[own]
        at = np.repeat(first[own] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        out.append(np.packbits(lowest[at] < np.repeat(docs, sizes)).tobytes())
    return out


def _strings(a: Anchored, got: dict[int, bytes], n_ranges: int) -> tuple[np.ndarray, list[bytes]]:
    """The runs around shared anchors, and their strings."""
    keys, _ = a.distinct()
    at = cuts(keys, n_ranges)
    bits = [np.unpackbits(np.frombuffer(got[r], dtype=np.uint8), count=int(at[r + 1] - at[r])) for r in range(n_ranges) if at[r + 1] > at[r]]
    shared = np.concatenate(bits).astype(bool) if bits else np.empty(0, dtype=bool)
    runs = np.flatnonzero(shared[np.searchsorted(keys, a.keys)]) if len(keys) else np.empty(0, dtype=np.int64)
    text = a.text.tobytes()
    ends = a.starts[runs] + a.counts[runs] + SPAN - 1
    return runs, [text[s:e] for s, e in zip(a.starts[runs].tolist(), ends.tolist(), strict=True)]


def _folded(a: Anchored, runs: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs, those that stand for all equal ones in the block; for each run, its stand-in; the least document of each."""
    index: dict[bytes, int] = {}
    own = np.fromiter((index.setdefault(s, len(index)) for s in strings), dtype=np.int64, count=len(strings))
    docs = a.order[a.owner[runs]]
    order = np.lexsort((docs, own))
    first = order[np.searchsorted(own[order], np.arange(len(index)))] if len(order) else order
    return first, own, docs[first]


def _bucket_of(a: Anchored, runs: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    lead = np.zeros(len(runs), dtype=np.uint64)
    for k in range(8):
        lead = lead << np.uint64(8) | a.text[a.anchors[runs] + k]
    return np.searchsorted(splitters, lead, side="right")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256.

    Each byte goes that is covered by a string of SPAN bytes which also starts in a document with a smaller id; all is
    judged on the input. Null texts are empty; a null id is smaller than any other; rows that share an id don't remove
    each other's bytes. An empty table gives an empty result; other columns are ignored. Texts of any length are
    treated as a whole.
    """
    blocks = make_blocks(docs, id_col, text_col, BLOCK)
    size = corpus_bytes(blocks)
    n_ranges = ranges(size // 16)
    sampled = max(1, size // 16 // SAMPLE)

    def anchors(k: int, block: Block) -> Iterator[pa.RecordBatch]:
        a = Anchored(block)
        keys, n = a.distinct()
        at = cuts(keys, n_ranges)
        parts = {r: packed(keys[at[r] : at[r + 1]], n[at[r] : at[r + 1]]) for r in range(n_ranges)}
        yield key_batch(k, parts)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                a = Anchored(Block.decode(data.as_py()))
                some = np.flatnonzero(mixed(a.keys) % np.uint64(sampled) == 0)
                lead = np.zeros(len(some), dtype=np.uint64)
                for k in range(8):
                    lead = lead << np.uint64(8) | a.text[a.anchors[some] + k]
                yield pa.RecordBatch.from_arrays([pa.array((lead >> np.uint64(1)).astype(np.int64))], names=["lead"])

    shared = stored(answered(over_blocks(blocks, anchors), _shared), "shared")
    n_buckets = max(1, size // BUCKET_BYTES)
    splitters = np.empty(0, dtype=np.uint64)
    if n_buckets > 1:
        # splitters from a sixteenth of the blocks, about; buckets only need to be of roughly equal size
        some = blocks.where(F.pmod(F.xxhash64("block"), F.lit(16)) == 0)
        found = some.select("data").mapInArrow(sample, "lead long").agg(F.percentile_approx("lead", [k / n_buckets for k in range(1, n_buckets)], 20 * n_buckets).alias("at")).first()["at"]
        splitters = np.array(sorted(set(found or [])), dtype=np.uint64) << np.uint64(1)

    def strings(k: int, block: Block, got: dict[int, bytes]) -> pa.Table:
        a = Anchored(block)
        runs, texts = _strings(a, got, n_ranges)
        first, _, docs_ = _folded(a, runs, texts)
        bucket, counts = _bucket_of(a, runs[first], splitters), a.counts[runs[first]]
        parts = {}
        for b in np.unique(bucket).tolist():
            own = np.flatnonzero(bucket == b)
            parts[b] = b"".join([np.array([len(own)], dtype=np.int64).tobytes(), docs_[own].tobytes(), counts[own].astype(np.uint8).tobytes(), *[texts[i] for i in first[own].tolist()]])
        return pa.Table.from_batches([key_batch(k, parts)])

    sent = with_answers(blocks, shared, strings, KEY_SCHEMA)
    masks = answered(sent, _sort_bucket).select("block", (-1 - F.col("range")).alias("range"), "data")

    def remove(k: int, block: Block, got: dict[int, bytes]) -> pa.Table:
        a = Anchored(block)
        runs, texts = _strings(a, got, n_ranges)
        first, own, docs_ = _folded(a, runs, texts)
        n, ends = len(a.text), block.ends
        covered = np.zeros(n + 1, dtype=np.int32)
        if len(runs):
            bucket, sizes = _bucket_of(a, runs[first], splitters), a.counts[runs[first]]
            at = np.concatenate([[0], np.cumsum(sizes)])
            flags = np.zeros(at[-1], dtype=bool)
            for b in np.unique(bucket).tolist():
                mine = np.flatnonzero(bucket == b)
                places = np.repeat(at[mine] - np.concatenate([[0], np.cumsum(sizes[mine])[:-1]]), sizes[mine]) + np.arange(sizes[mine].sum())
                flags[places] = np.unpackbits(np.frombuffer(got[-1 - b], dtype=np.uint8), count=len(places))
            counts = a.counts[runs]
            step = np.arange(counts.sum()) - np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
            # a run that also stands in a smaller document of the block goes as a whole
            gone = flags[np.repeat(at[own], counts) + step] | np.repeat(a.order[a.owner[runs]] > docs_[own], counts)
            hit = np.repeat(a.starts[runs], counts)[gone] + step[gone]
            covered += np.bincount(hit, minlength=n + 1).astype(np.int32)
            covered -= np.bincount(hit + SPAN, minlength=n + 1)[: n + 1].astype(np.int32)
        removed = np.cumsum(covered[:-1]) > 0
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        edge = removed.copy()
        edge[1:] &= ~removed[:-1]
        inner = begins[begins < n]
        edge[inner] = removed[inner]
        sums, spans = np.concatenate([[0], np.cumsum(removed)]), np.concatenate([[0], np.cumsum(edge)])
        keep, hashes = ~removed, []
        for s, e in zip(begins.tolist(), ends.tolist(), strict=True):
            hashes.append(hashlib.sha256(a.text[s:e][keep[s:e]].tobytes()).hexdigest())
        return pa.table({"id": pa.array(block.ids, mask=~block.known), "n_bytes": ends - begins, "n_removed": sums[ends] - sums[begins], "n_spans": spans[ends] - spans[begins], "kept_sha256": hashes})

    return with_answers(blocks, shared.unionByName(masks), remove, OUT).withColumnRenamed("id", id_col)

