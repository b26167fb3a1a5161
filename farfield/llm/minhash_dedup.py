"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF word shingles, banded, verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.llm.blocks import KEY_SCHEMA, Block, answered, corpus_bytes, cuts, key_batch, make_blocks, mixed, over_blocks, packed, ranges, unpacked, with_answers, word_hashes
from farfield.llm.common import stored
from farfield.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Samples in a band, and bands: at the similarity of 0.8, 1 pair in 1,500 shares no band; at 0.9, none in 10**7.
BAND_ROWS, BANDS = 4, 14
#: Candidate pairs up to which their ids are broadcast to the vectors (24 bytes each); more are joined by a shuffle.
BROADCAST_PAIRS = 500_000
#: Pairs of one leader that one task compares.
LEADER_PAIRS = 200
#: Documents, and their words, in a part of a family that one task compares with another part, about.
PART_ROWS, PART_WORDS = 400, 200_000
#: How much a shingle of one document can weigh more than one of all documents.
IDF_SHARE = 0.25
_U = np.uint64
_TABLE = np.random.default_rng(11).gamma(2.0, 1.0, (2, 1 << 16))
#: Parameters of the sampling by 16 bits of a hash: r, and the logarithm of c, both from Gamma(2, 1).
R, LN_C = _TABLE[0], np.log(_TABLE[1])
_K = np.arange(1, BAND_ROWS * BANDS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)


def shingles(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's shingles (lower-cased words, SHINGLE_WORDS in a row; all of them if there are fewer),
    and the documents' bounds in them."""
    texts = [b" ".join(t.lower().split()) for t in block.texts()]
    text = np.frombuffer(b"".join([b" ", *[x for t in texts for x in (t, b" ")]]), dtype=np.uint8)
    blank = text == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    words = word_hashes(text, starts, ends)
    begins = 1 + np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    at = np.searchsorted(starts, begins)
    counts = np.diff(at)
    n = np.where(counts >= SHINGLE_WORDS, counts - SHINGLE_WORDS + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(n)])
    first = np.repeat(at[:-1] - bounds[:-1], n) + np.arange(bounds[-1])
    last = np.repeat(at[1:], n)
    out = np.zeros(len(first), dtype=np.uint64)
    for k in range(SHINGLE_WORDS):
        there = first + k < last
        out = mixed(out + np.where(there, words[np.minimum(first + k, max(0, len(words) - 1))], _U(0)) if len(words) else out)
    return out, bounds


def key_bits(n_keys: int) -> int:
    """Bits of a hash that tell n_keys shingles apart but for one in a million."""
    return min(64, 20 + max(1, n_keys).bit_length())


class Shingled:
    """A block's distinct shingles by document: hashes (sorted within a document), counts, bounds."""

    def __init__(self, block: Block, bits: int):
        raw, bounds = shingles(block)
        raw = raw >> _U(64 - bits) << _U(64 - bits)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = np.lexsort((raw, owner))
        raw, owner = raw[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (raw[1:] != raw[:-1]) | (owner[1:] != owner[:-1])])) if len(raw) else np.empty(0, dtype=np.int64)
        self.hashes, self.owner = raw[first], owner[first]
        self.counts = np.diff(np.append(first, len(raw)))
        self.bounds = np.searchsorted(self.owner, np.arange(len(bounds)))
        self.keys, self.docs = np.unique(self.hashes, return_counts=True)


def _sums(pieces: list[bytes]) -> list[bytes]:
    """From each block's keys and counts: its keys' counts in all blocks."""
    sides = [unpacked(p, 2) for p in pieces]
    keys, n = np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides])
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, n = keys[first], np.add.reduceat(n, first)
    return [packed(np.zeros(len(s[0])), n[np.searchsorted(keys, s[0])]) for s in sides]


def bands(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Band keys by improved consistent weighted sampling: BAND_ROWS samples make a band's key.

    Each sample is the shingle, with its quantised weight, of the least ln a = ln c - r (t - beta + 1), where
    t = floor(ln w / r + beta), and r, c and beta are drawn by the shingle and the number of the sample.
    """
    ln_w = np.log(weights)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(BAND_ROWS):
        for at in range(BANDS):
            h = mixed(hashes + _K[at * BAND_ROWS + row])
            r, beta = R[h & _U(65535)], (h >> _U(32)).astype(np.float64) / 2.0**32
            t = np.floor(ln_w / r + beta)
            k = int(np.argmin(LN_C[h >> _U(16) & _U(65535)] - r * (t - beta + 1)))
            drawn = mixed(t[k : k + 1].astype(np.int64).astype(np.uint64) * _K[0])
            out[at : at + 1] = mixed(out[at : at + 1] + hashes[k : k + 1] + drawn)
    return out


def text_hash(text: bytes) -> int:
    """What F.xxhash64 gives for the text."""
    h = xxhash.xxh64_intdigest(text, 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def vector_bytes(hashes: np.ndarray, idf: np.ndarray, counts: np.ndarray) -> bytes:
    return packed(hashes >> _U(16), idf.astype(np.float32).view(np.uint32), counts)


def vector(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, weights of one occurrence, counts."""
    hashes, idf, counts = unpacked(data, 3)
    return hashes, idf.astype(np.uint32).view(np.float32).astype(np.float64), counts.astype(np.int64)


def similarity(x: tuple[np.ndarray, np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: the sum of the smaller weights over that of the larger."""
    if not len(x[0]) or not len(y[0]):
        return 0.0
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    low = float((x[1] * np.minimum(x[2], y[2][at]))[y[0][at] == x[0]].sum())
    return low / (float((x[1] * x[2]).sum()) + float((y[1] * y[2]).sum()) - low)


def occurrences(vectors: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, weight and owner of every occurrence: the k-th of a shingle is a feature of its own, so that the smaller of
    two counts is the number of features in common, and features weigh the same wherever they are."""
    empty = np.empty(0)
    keys, weights, owners = [empty.astype(np.uint64)], [empty], [empty.astype(np.int64)]
    for i, (h, w, n) in enumerate(vectors):
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        keys.append(mixed(np.repeat(h, n) + nth.astype(np.uint64) * _K[1]))
        weights.append(np.repeat(w, n))
        owners.append(np.full(len(nth), i))
    return np.concatenate(keys), np.concatenate(weights), np.concatenate(owners)


def block_links(left: list[tuple], right: list[tuple], similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of left and right at or above `similar`, by postings of the features on the right."""
    keys, weights, owners = occurrences(right)
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    totals = np.bincount(owners, weights=weights[order], minlength=len(right))
    one, two = [], []
    for i, v in enumerate(left):
        k, w, _ = occurrences([v])
        lo, hi = np.searchsorted(keys, k, side="left"), np.searchsorted(keys, k, side="right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        low = np.bincount(owners[at], weights=np.repeat(w, n), minlength=len(right))
        j = np.flatnonzero(low >= similar * (totals + w.sum() - low) - 1e-12) if len(k) else np.empty(0, dtype=np.int64)
        j = j[low[j] > 0]
        one.append(np.full(len(j), i))
        two.append(j)
    empty = [np.empty(0, dtype=np.int64)]
    return np.concatenate(one + empty), np.concatenate(two + empty)


VECTORS = "uid long, id long, text_hash long, same long, same2 long, bands array<long>, total double, vector binary"


def weighted(blocks: DataFrame, similar: float) -> DataFrame:
    """One stored row per document. Documents that can have a near copy come with their weighted shingles.

    Weights are counts times 1 + IDF_SHARE * ln((1 + N) / (1 + df)) / ln(2 + N), with document frequencies over the
    whole corpus: shingles that many documents share count less, yet a large group of copies doesn't fall below the
    threshold through its own size. A document of which shingles with a df of 1 make up more than 1 - similar of
    the weight can't be that similar to a different one; its vector isn't needed.
    """
    size = corpus_bytes(blocks)
    bits, n_ranges = key_bits(size // 6), ranges(size // 6)
    n_docs = blocks.mapInArrow(_block_rows, "n long").agg(F.sum("n")).first()[0] or 0

    def keys(k: int, block: Block) -> Iterator[pa.RecordBatch]:
        s = Shingled(block, bits)
        at = cuts(s.keys, n_ranges)
        yield key_batch(k, {r: packed(s.keys[at[r] : at[r + 1]], s.docs[at[r] : at[r + 1]]) for r in range(n_ranges)})

    def weigh(k: int, block: Block, got: dict[int, bytes]) -> pa.Table:
        s = Shingled(block, bits)
        df = np.concatenate([unpacked(got[r], 2)[1] for r in sorted(got)]).astype(np.float64) if got else np.empty(0)
        df = df[np.searchsorted(s.keys, s.hashes)] if len(df) else df
        idf = 1 + IDF_SHARE * np.log((1 + n_docs) / (1 + df)) / np.log(2 + n_docs)
        weights = s.counts * idf
        rows, texts = [], block.texts()
        for i, (a, b) in enumerate(zip(s.bounds.tolist(), s.bounds[1:].tolist(), strict=False)):
            w, h = weights[a:b], s.hashes[a:b]
            total = float(w.sum())
            row = [k << 18 | i, int(block.ids[i]) if block.known[i] else None, text_hash(texts[i]), None, None, None, total, None]
            if b > a and float(w[df[a:b] > 1].sum()) >= similar * total - 1e-6:
                c = s.counts[a:b].astype(np.uint64)
                same = [int(mixed(h * _K[j] + c).sum().view(np.int64)) for j in (0, 1)]
                row[3:6] = *same, bands(h, w).view(np.int64).tolist()
                row[7] = vector_bytes(h, idf[a:b], c)
            rows.append(row)
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.float64(), pa.binary()]
        return pa.table([pa.array([r[j] for r in rows], type=t) for j, t in enumerate(kinds)], names=["uid", "id", "text_hash", "same", "same2", "bands", "total", "vector"])

    counts = answered(over_blocks(blocks, keys), _sums)
    return stored(with_answers(blocks, counts, weigh, VECTORS), "vectors", "uncompressed")


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([len(Block.decode(x.as_py()).ids) for x in batch.column("data")], type=pa.int64())], names=["n"])


def _compared(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """uid, leader, similarity of stored pairs (uid, leader)."""
    n = pairs.count()
    near = F.broadcast if n <= BROADCAST_PAIRS else (lambda df: df)
    own = vectors.select("uid", "vector")
    # a leader with many pairs is dealt to several tasks, with its vector in each
    per = pairs.groupBy("leader").agg(F.ceil(F.count("*") / LEADER_PAIRS).alias("parts"))
    sides = own.join(near(pairs.join(per, "leader")), "uid").select("leader", F.pmod(F.xxhash64("uid"), F.col("parts")).alias("part"), "uid", "vector")
    heads = own.select(F.col("uid").alias("leader"), F.col("vector").alias("head")).join(near(per), "leader").select("leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("nth"), "head")

    def compare(members: pa.Table, head: pa.Table) -> pa.Table:
        leader = vector(head.column("head")[0].as_py()) if head.num_rows else (np.empty(0),) * 3
        found = [similarity(vector(v.as_py()), leader) for v in members.column("vector")]
        return pa.table({"uid": members.column("uid"), "leader": members.column("leader"), "similarity": pa.array(found, type=pa.float64())})

    return sides.groupBy("leader", "part").cogroup(heads.groupBy("leader", "nth")).applyInArrow(compare, "uid long, leader long, similarity double")


def near_links(vectors: DataFrame, similar: float = SIMILARITY) -> DataFrame:
    """a, b: links whose classes are those of all candidate pairs (documents that share a band) at or above `similar`.

    Equal vectors are hung onto the least of them first; only these go on. In a bucket (a band's key), all members are
    compared with the least one. That joins most of a group of near copies, of any size, by one comparison each. What
    shares buckets, directly or through others, is a family; members that the star didn't join to the largest class of
    their family are compared with all of it, part by part. Pairs within that class need no comparison, and no bucket's
    pairs are formed as rows: a task gives at most a row per document.
    """
    whole = vectors.where("vector is not null")
    least = whole.groupBy("same", "same2").agg(F.min("uid").alias("rep"))
    links = stored(whole.select("uid", "same", "same2").join(least, ["same", "same2"]).where("uid <> rep").select(F.col("uid").alias("a"), F.col("rep").alias("b")), "equal")
    reps = stored(whole.join(least.select(F.col("rep").alias("uid")), "uid", "left_semi"), "reps", "uncompressed")
    members = reps.select("uid", F.explode("bands").alias("bucket"))
    leaders = members.groupBy("bucket").agg(F.min("uid").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = stored(members.join(leaders, "bucket").where("uid <> leader").select("uid", "leader").distinct(), "pairs")
    star = stored(_compared(pairs, reps).where(F.col("similarity") >= similar).select(F.col("uid").alias("a"), F.col("leader").alias("b")), "star")
    families = components(pairs.select(F.col("uid").alias("a"), F.col("leader").alias("b"))).select(F.col("id").alias("uid"), F.col("component").alias("family"))
    classes = components(star).select(F.col("id").alias("uid"), F.col("component").alias("class"))
    rows = families.join(classes, "uid", "left").withColumn("class", F.coalesce("class", "uid"))
    rows = stored(rows.join(reps.select("uid", "total"), "uid"), "families")
    sizes = rows.groupBy("family", "class").agg(F.count("*").alias("n"), F.sum("total").alias("words"))
    main = sizes.groupBy("family").agg(F.max(F.struct("n", "class")).alias("m"), F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("words").alias("words")).where("k > 1")
    parts = lambda n, words: F.greatest(F.lit(1), F.ceil(n / PART_ROWS), F.ceil(words / PART_WORDS)).cast("long")
    # rest: members outside the largest class; each of their parts meets each part of the family
    rest = sizes.join(main.select("family", F.col("m.class").alias("class")), ["family", "class"], "left_anti").groupBy("family").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    cut = main.select("family", F.col("m.class").alias("main"), parts(F.col("n"), F.col("words")).alias("right")).join(rest.select("family", parts(F.col("n"), F.col("words")).alias("left")), "family")
    dealt = stored(rows.select("uid", "family", "class").join(cut, "family"), "dealt")
    many = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("uid"), F.col(n))
    left = dealt.where("class <> main").select("family", part("left").alias("i"), many("right").alias("j"), F.lit(0).alias("side"), "uid")
    right = dealt.select("family", part("right").alias("j"), many("left").alias("i"), F.lit(1).alias("side"), "uid").select("family", "i", "j", "side", "uid")
    tasks = left.unionByName(right).join(reps.select("uid", "vector"), "uid")

    def compare(group: pa.Table) -> pa.Table:
        side, uid = group.column("side").to_numpy(), group.column("uid").to_numpy()
        blobs = group.column("vector").to_pylist()
        sides = [np.flatnonzero(side == s) for s in (0, 1)]
        i, j = block_links(*[[vector(blobs[k]) for k in s.tolist()] for s in sides], similar)
        a, b = uid[sides[0][i]], uid[sides[1][j]]
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = top(x), top(y)
            root[max(x, y)] = min(x, y)
        held = [(x, top(x)) for x in root if top(x) != x]
        return pa.table({"a": pa.array([x for x, _ in held], type=pa.int64()), "b": pa.array([y for _, y in held], type=pa.int64())})

    return links.unionByName(star).unionByName(stored(tasks.groupBy("family", "i", "j").applyInArrow(compare, "a long, b long"), "rest"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILARITY) -> DataFrame:
    """One row per document: id, class_id (least id of its class), kept (it is the one that stays), class_size, text_hash
    (xxhash64, so that a row can be found again where ids are repeated or null).

    A class holds what links of a weighted Jaccard similarity of `similar` or more connect. Documents without words,
    null texts among them, are alone; shorter ones than SHINGLE_WORDS have one shingle. A null id counts as greater
    than others in choosing who stays; of rows that share an id one stays. An empty table gives an empty result; other
    columns are ignored.
    """
    vectors = weighted(make_blocks(docs, id_col, text_col), similar)
    roots = components(near_links(vectors, similar)).select(F.col("id").alias("uid"), "component")
    rows = vectors.select("uid", "id", "text_hash").join(roots, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    rows = stored(rows, "classes")
    one = rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("first"), F.count("*").alias("class_size"))
    return rows.join(one, "component").select(F.col("id").alias(id_col), F.col("first.id").alias("class_id"), (F.col("uid") == F.col("first.uid")).alias("kept"), "class_size", "text_hash")

