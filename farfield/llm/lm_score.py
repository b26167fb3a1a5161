"""Language-model scores by prediction by partial matching over bytes, beside a unigram base."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.llm.blocks import KEY_SCHEMA, Block, corpus_bytes, cuts, give_back, key_batch, lookup, make_blocks, mixed, over_blocks, packed, range_of, ranges, unpacked, with_answers, word_hashes
from farfield.llm.common import stored

#: Bytes of context at most.
ORDER = 5
PAD = bytes(ORDER)
ALPHA = 0.1
#: Grams that a task merges before it hands them on.
MERGED = 2_000_000
#: Grams of the model that one task holds, about.
MODEL_ROWS = 500_000
#: Positions that codes are made of at a time.
SLICE = 1 << 19
#: Grams with one pair of last context bytes from which on the third tells their part, too.
HOT = 1_000_000
CODE = np.uint64
OUT = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(block: Block) -> np.ndarray:
    return np.array([crc32(str(i).encode() if k else b"") % 10 == 0 for i, k in zip(block.ids.tolist(), block.known.tolist(), strict=True)], dtype=bool)


class Stream:
    """A block's documents as the model sees them: lower-cased words joined by single spaces, then an end byte (0), then
    more that only serve as context. starts: of the documents; coded: the positions that count."""

    def __init__(self, block: Block):
        texts = [b" ".join(t.lower().split()) for t in block.texts()]
        self.bytes = np.frombuffer(b"".join([PAD, *[x for t in texts for x in (t, PAD)]]), dtype=np.uint8)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = ORDER + np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]]).astype(np.int64)
        self.ends = self.starts + sizes  # of the end bytes
        coded = np.zeros(len(self.bytes) + 1, dtype=np.int8)
        np.add.at(coded, self.starts, 1)
        np.add.at(coded, self.ends + 1, -1)
        self.coded = np.flatnonzero(np.cumsum(coded[:-1], dtype=np.int8)).astype(np.int32 if len(coded) < 1 << 31 else np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)  # in coded, of the documents
        self.sizes = sizes + 1

    def codes(self) -> np.ndarray:
        """Of each coded position: ORDER bytes of context and the byte, as one integer."""
        out = np.empty(len(self.coded), dtype=CODE)
        for a in range(0, len(out), SLICE):
            at = self.coded[a : a + SLICE]
            own = self.bytes[at - ORDER].astype(CODE)
            for k in range(ORDER - 1, -1, -1):
                own <<= CODE(8)
                own |= self.bytes[at - k]
            out[a : a + SLICE] = own
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words, and the document of each."""
        breaks = (self.bytes == 32) | (self.bytes == 0)
        breaks[self.coded[self.bytes[self.coded] == 0]] = False  # a 0 within a text is part of a word
        breaks[self.ends] = True
        inside = ~breaks
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        return word_hashes(self.bytes, starts, ends), np.searchsorted(self.starts, starts, side="right") - 1


def distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys, sorted."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def folded(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below 2**63 with the number of those whose count (0 or 1) is 1."""
    both, n = np.unique(keys << CODE(1) | counts.astype(CODE), return_counts=True)
    return folded(both >> CODE(1), n * (both & CODE(1)).astype(np.int64))


def gram_counts(blocks: DataFrame, n_ranges: int) -> DataFrame:
    """code, n: every gram of the corpus and how often training documents hold it (0 for those of others only)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return folded(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))

        def out(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            at = range_of(mixed(keys), n_ranges)
            order = np.argsort(at, kind="stable")
            keys, n, ends = keys[order], n[order], np.searchsorted(at[order], np.arange(n_ranges + 1))
            return key_batch(0, {r: packed(keys[ends[r] : ends[r + 1]], n[ends[r] : ends[r + 1]]) for r in range(n_ranges)})

        for batch in batches:
            for data in batch.column("data"):
                block = Block.decode(data.as_py())
                stream = Stream(block)
                held.append(counted(stream.codes(), np.repeat(~held_out(block), stream.sizes)))
                if len(held) > 1:
                    held = [merged()]
                    if len(held[0][0]) > MERGED:
                        yield out(*held.pop())
                give_back()
        if held:
            yield out(*merged())

    def merge(group: pa.Table) -> pa.Table:
        sides = [unpacked(x.as_py(), 2) for x in group.column("data")]
        keys, n = folded(np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides]).astype(np.int64))
        return pa.table({"code": keys.astype(np.int64), "n": n})

    return stored(blocks.select("data").mapInArrow(count, KEY_SCHEMA).groupBy("range").applyInArrow(merge, "code long, n long"), "grams")


class Suffixes:
    """The trie's levels up to one byte of context, which every part of the model needs: 256 x 256 counts."""

    def __init__(self, pairs: np.ndarray):
        self.pairs = pairs  # [context byte, byte]
        self.bytes = pairs.sum(0)
        self.n1, self.q1 = pairs.sum(1), (pairs > 0).sum(1)
        self.n0, self.q0 = int(self.bytes.sum()), int((self.bytes > 0).sum())
        self.e1 = ((pairs > 0) * self.bytes).sum(1)  # counts that the byte's followers have without context


def log_probabilities(codes: np.ndarray, counts: np.ndarray, low: Suffixes, middle: np.ndarray | None = None) -> np.ndarray:
    """log10 of each code's last byte after its context, from the counts of all codes that share their last two
    context bytes; codes sorted. With middle, codes hold all that share their last three context bytes, of which the
    last two are one pair: middle has the counts of all bytes after that pair.

    Escape by method C: at each order, the symbols not yet excluded have their counts, and the escape as many as they
    are. Symbols seen at a longer context are excluded at shorter ones. A context never seen is passed over at no cost.
    """
    out, open_ = np.zeros(len(codes)), np.ones(len(codes), dtype=bool)
    symbols = (codes & CODE(255)).astype(np.int64)

    def step(c: np.ndarray, n: np.ndarray, q: np.ndarray) -> None:
        """c: of the symbol; n, q: counts and number of the symbols that aren't excluded, of each open code's context."""
        nonlocal out, open_
        total = n + q
        with np.errstate(divide="ignore", invalid="ignore"):
            here, escape = np.log10(c / total), np.log10(q / total)
        out += np.where(open_ & (c > 0), here, np.where(open_ & (total > 0), escape, 0.0))
        open_ &= c == 0

    above_q, above_e = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes), dtype=np.int64)
    for order in range(ORDER, 1, -1):
        if order == 2 and middle is not None:
            pair = low.pairs[int(codes[0] >> CODE(8) & CODE(255))] if len(codes) else middle
            step(middle[symbols], middle.sum() - above_e, (middle > 0).sum() - above_q)
            above_q, above_e = np.full(len(codes), (middle > 0).sum()), np.full(len(codes), pair[middle > 0].sum())
            break
        own = codes & CODE((1 << 8 * (order + 1)) - 1)
        grams, c = folded(own, counts)
        seen = (c > 0).astype(np.int64)
        contexts, first, at = np.unique(grams >> CODE(8), return_index=True, return_inverse=True)
        n, q = np.add.reduceat(c, first), np.add.reduceat(seen, first)
        if order == 3 and middle is not None:
            below = middle[(grams & CODE(255)).astype(np.int64)]
        elif order > 2:
            shorter, c_short = folded(grams & CODE((1 << 8 * order) - 1), c)
            below = c_short[np.searchsorted(shorter, grams & CODE((1 << 8 * order) - 1))]
        else:
            below = low.pairs[(grams >> CODE(8) & CODE(255)).astype(np.int64), (grams & CODE(255)).astype(np.int64)]
        e = np.add.reduceat(seen * below, first)
        i = np.searchsorted(grams, own)
        j = at[i]
        step(c[i], n[j] - above_e, q[j] - above_q)
        above_q, above_e = q[j], e[j]
    last = (codes >> CODE(8) & CODE(255)).astype(np.int64)
    step(low.pairs[last, symbols], low.n1[last] - above_e, low.q1[last] - above_q)
    step(low.bytes[symbols], low.n0 - low.e1[last], low.q0 - low.q1[last])
    out[open_] -= np.log10(max(1, 256 - low.q0))
    return out


def model(grams: DataFrame, hot: int = HOT, rows: int = MODEL_ROWS) -> DataFrame:
    """code, logp of every gram of the corpus. A task has all grams of some pairs of last context bytes, or of one
    triple where a pair has more than `hot` grams: 256 counts of such a pair go to all tasks, which is 2 KB for each
    `hot` grams of the corpus, and 128 MB at the very most."""
    pair, third = F.shiftright("code", 8).bitwiseAND(65535), F.shiftright("code", 24).bitwiseAND(255)
    pairs = np.zeros((256, 256), dtype=np.int64)
    for r in grams.groupBy((F.col("code").bitwiseAND(65535)).alias("pair")).agg(F.sum("n").alias("n")).collect():
        pairs[r["pair"] >> 8, r["pair"] & 255] = r["n"]
    low = Suffixes(pairs)
    sizes = [(r["pair"], r["grams"]) for r in grams.groupBy(pair.alias("pair")).agg(F.count("*").alias("grams")).collect()]
    crowded = [p for p, n in sizes if n > hot]
    middles = {p: np.zeros(256, dtype=np.int64) for p in crowded}
    if crowded:
        for r in grams.where(pair.isin(crowded)).groupBy(pair.alias("pair"), F.col("code").bitwiseAND(255).alias("byte")).agg(F.sum("n").alias("n")).collect():
            middles[r["pair"]][r["byte"]] = r["n"]
    parts = min(65536, max(8, -(-sum(n for _, n in sizes) // rows)))

    def score(group: pa.Table) -> pa.Table:
        codes, n = group.column("code").to_numpy().astype(CODE), group.column("n").to_numpy()
        order = np.argsort(codes)
        codes, n = codes[order], n[order]
        middle = middles.get(int(codes[0] >> CODE(8) & CODE(65535))) if group.column("part")[0].as_py() < 0 else None
        out = pa.table({"code": codes.astype(np.int64), "logp": log_probabilities(codes, n, low, middle)})
        give_back()
        return out

    part = F.pmod(F.xxhash64(pair), F.lit(parts))
    if crowded:
        part = F.when(pair.isin(crowded), -1 - (pair * 256 + third)).otherwise(part)
    return stored(grams.withColumn("part", part).groupBy("part").applyInArrow(score, "code long, logp double"), "model")


def splitters(grams: DataFrame, n: int) -> np.ndarray:
    """Codes that cut all grams into n ranges of about equal size."""
    if n < 2:
        return np.empty(0, dtype=CODE)
    found = grams.agg(F.percentile_approx("code", [k / n for k in range(1, n)], 20 * n).alias("at")).first()["at"]
    return np.array(sorted(set(found or [])), dtype=CODE)


def _word_task(group: pa.Table) -> pa.Table:
    """From the blocks' sorted hashes and training counts: each block's hashes' counts in all blocks, and the number
    of types in training documents, with the first."""
    sides = [unpacked(x.as_py(), 2) for x in group.column("data")]
    keys, n = folded(np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides]).astype(np.int64))
    replies = [packed(np.zeros(len(s[0])), n[np.searchsorted(keys, s[0])]) for s in sides]
    types = [int((n > 0).sum())] + [0] * (len(sides) - 1)
    return pa.table({"block": group.column("block"), "range": group.column("range"), "data": pa.array(replies, type=pa.binary()), "types": pa.array(types, type=pa.int64())})


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents whose crc32 of the id as text isn't divisible by 10 (that of an empty text for null ids).
    Null texts are empty and have their end token. score is that of the lower-cased words joined by single spaces,
    and the end, under a static byte model of order 5 trained on the whole training part; base_score is the smoothed
    unigram's. Words are told apart by 64-bit hashes. Rows that share an id are scored each, an empty table gives an
    empty result, other columns are ignored.
    """
    blocks = make_blocks(docs, id_col, text_col)
    size = corpus_bytes(blocks)
    n_words = ranges(size // 40)
    grams = model(gram_counts(blocks, n_words))
    at_codes = splitters(grams, ranges(size // 15))

    def keys(k: int, block: Block) -> Iterator[pa.RecordBatch]:
        stream, train = Stream(block), ~held_out(block)
        codes = distinct(stream.codes())
        parts = dict(enumerate(map(packed, np.split(codes, np.searchsorted(codes, at_codes)))))
        hashes, owner = stream.words()
        words, n = counted(hashes >> CODE(1), train[owner])
        at = cuts(words << CODE(1), n_words)
        parts |= {-2 - r: packed(words[at[r] : at[r + 1]], n[at[r] : at[r + 1]]) for r in range(n_words)}
        parts[-1] = np.array([train.sum(), train[owner].sum()], dtype=np.int64).tobytes()
        yield key_batch(k, parts)

    sent = stored(over_blocks(blocks, keys), "keys")
    totals = sent.where("range = -1").select("data").mapInArrow(_sizes, "docs long, tokens long").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).first()
    ends = totals["docs"] or 0
    word_replies = stored(sent.where("range < -1").groupBy("range").applyInArrow(_word_task, KEY_SCHEMA + ", types long"), "counts")
    types = (word_replies.agg(F.sum("types")).first()[0] or 0) + (ends > 0)
    n_train = (totals["tokens"] or 0) + ends
    floor = np.log10(ALPHA / (n_train + ALPHA * (types + 1)))

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code").to_numpy().astype(CODE)
            at = np.searchsorted(at_codes, codes, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("code"), batch.column("logp")], names=["range", "code", "logp"])

    def gram_task(asked: pa.Table, known: pa.Table) -> pa.Table:
        codes, logp = known.column("code").to_numpy().astype(CODE), known.column("logp").to_numpy()
        order = np.argsort(codes)
        codes, logp = codes[order], logp[order]
        replies = []
        for x in asked.column("data"):
            own = logp[np.searchsorted(codes, unpacked(x.as_py())[0])]
            replies.append(zstandard.ZstdCompressor(level=1).compress(own.view(np.uint8).reshape(-1, 8).T.tobytes()))
        give_back()
        return pa.table({"block": asked.column("block"), "range": asked.column("range"), "data": pa.array(replies, type=pa.binary())})

    by_range = grams.mapInArrow(ranged, "range int, code long, logp double")
    gram_replies = sent.where("range >= 0").groupBy("range").cogroup(by_range.groupBy("range")).applyInArrow(gram_task, KEY_SCHEMA)

    def score(k: int, block: Block, got: dict[int, bytes]) -> pa.Table:
        stream = Stream(block)
        codes = stream.codes()
        logp = np.concatenate([_doubles(got.pop(r)) for r in sorted(r for r in got if r >= 0)])
        at = lookup(codes, distinct(codes))
        del codes
        scores = np.add.reduceat(logp[at], stream.first)
        del at, logp
        hashes, owner = stream.words()
        words = np.unique(hashes >> CODE(1))
        replies = [got[r] for r in sorted((r for r in got if r < -1), reverse=True)]
        counts = np.concatenate([unpacked(x, 2)[1] for x in replies]).astype(np.float64) if replies else np.empty(0)
        c = counts[lookup(hashes >> CODE(1), words)] if len(hashes) else counts
        docs_ = len(block.ids)
        tail = floor + np.log10((ends + ALPHA) / ALPHA)
        base = np.bincount(owner, weights=floor + np.log10((c + ALPHA) / ALPHA), minlength=docs_) + tail
        tokens = np.bincount(owner, minlength=docs_) + 1
        known = np.bincount(owner, weights=c > 0, minlength=docs_).astype(np.int64) + (ends > 0)
        return pa.table({
            "id": pa.array(block.ids, mask=~block.known), "held_out": held_out(block), "n_tokens": tokens, "n_known": known,
            "train_tokens": np.full(docs_, n_train), "base_score": base, "score": scores,
        })

    replies = word_replies.select("block", "range", "data").unionByName(gram_replies)
    return with_answers(blocks, replies, score, OUT).withColumnRenamed("id", id_col)


def _doubles(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1).T).view(np.float64).reshape(-1)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.frombuffer(x.as_py(), dtype=np.int64) for x in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([int(r[i]) for r in rows], type=pa.int64()) for i in (0, 1)], names=["docs", "tokens"])

