"""Mixing sources to target weights: fixed-length blocks, drawn without replacement; DataFrame operations only."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farfield.llm.common import n_words, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 256
SHARD_BLOCKS = 4096
SEED = 17
#: Documents in each independently ordered part of a source's stream.
PART_ROWS = 50_000
KEY = ["s_null", "s"]


def grid(n: Column) -> tuple[Column, Column]:
    """Sides of the a x b grid that just holds 0..n-1."""
    a = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")))).cast("long")
    return a, F.greatest(F.lit(1), F.ceil(n / a)).cast("long")


def permuted(x: Column, n: Column, a: Column, b: Column, *seed: Column) -> Column:
    """A pseudorandom bijection of 0..n-1: eight Feistel half-rounds over its grid(), walked until inside.

    Under a cells lie outside, so a walk of 32 steps is certain to end for a <= 32 and practically so beyond; if it
    doesn't end, the query fails rather than repeat an index. Each half-round is a step of aggregate(), so that its
    state is computed once.
    """

    def half(s: Column, i: Column) -> Column:
        side = F.when(i % 2 == 0, a).otherwise(b)
        return F.struct(s["y"].alias("x"), F.pmod(s["x"] + F.pmod(F.xxhash64(s["y"], i, *seed), side), side).alias("y"))

    def step(v: Column) -> Column:
        start = F.struct((v % a).cast("long").alias("x"), ((v - v % a) / a).cast("long").alias("y"))
        return F.aggregate(F.array(*[F.lit(i) for i in range(8)]), start, half, lambda s: s["y"] * a + s["x"])

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(32)), step(x), lambda v, _: F.when(v < n, v).otherwise(step(v)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("walk did not end")).cast("long"))


def targets(sized: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """One row per source: s_null, s, source_size, target. sized: s_null, s, size.

    The level that solves sum(min(most * size, level * weight)) = share * total is found by sorting the sources by
    the level at which each is full; resharing the excess until none is above ends at the same values. The windows
    without partitions hold one row per source.
    """
    one = Window.orderBy(*KEY)
    by_fill = Window.orderBy("fill", *KEY)
    before, everything = by_fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    found = sized.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
    found = found.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(one) - 1) % len(weights) + 1))
    found = found.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("weight"))
    zero = F.lit(0.0)
    found = found.withColumn("nth", F.row_number().over(by_fill)).withColumn(
        "level", (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), zero)) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero))
    )
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("nth", "level"))).over(everything)["level"]
    return found.withColumn("at", level).select(*KEY, "source_size", F.coalesce(F.least("cap", F.col("at") * F.col("weight")), F.col("cap")).alias("target"))


def sized_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).isNull().alias("s_null"), F.coalesce(source_col, F.lit("")).alias("s"), n_words(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("th"))


class Mix:
    """A mix of docs by their sources.

    Each source's documents form a stream of words, cut into blocks of block_words; a part of a stream, chosen by a
    hash of the id, is ordered by id, so that no source needs to be sorted in one task. A source whose target is k
    times its size and a rest gives all its blocks k times and the first blocks of one more permutation, the last
    cut short. All these slots are dealt to output shards by one permutation over the whole mix: a shard's source
    counts are a multinomial draw under the condition that totals are met. Independent draws would miss the targets
    by the square root of the counts, and could take a document more often than allowed.
    """

    def __init__(self, docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", block_words=BLOCK_WORDS, shard_blocks=SHARD_BLOCKS, seed=SEED, share=SHARE, most=MOST, weights=WEIGHTS):
        self.block, self.shard, self.seed = block_words, shard_blocks, seed
        self.sized = stored(sized_sources(docs, id_col, text_col, source_col), "sized")
        size, block = F.col("source_size"), F.lit(block_words)
        want = F.floor(F.col("target") + 0.5)
        found = targets(self.sized, share, most, weights)
        found = found.withColumn("blocks", F.ceil(size / block)).withColumn("rounds", F.when(size > 0, F.floor(want / size)).otherwise(0).cast("long"))
        found = found.withColumn("rest", want - F.col("rounds") * size).withColumn("slots", F.col("rounds") * F.col("blocks") + F.ceil(F.col("rest") / block))
        # the last block may be short: permutations are over the full ones, and it comes after them, so that a part of a
        # round has as many words as its slots
        found = found.withColumn("full", F.greatest(F.lit(1), F.floor(size / block)))
        found = found.withColumn("a", grid(F.col("full"))[0]).withColumn("b", grid(F.col("full"))[1])
        found = found.withColumn("first", F.coalesce(F.sum("slots").over(Window.orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        self.sources = stored(found, "sources")
        self.total = self.sources.agg(F.sum("slots")).first()[0] or 0
        self.rows = self.sized.count()

    def manifest(self) -> DataFrame:
        """One row per slot: shard, slot, s_null, s, block, words (of the block's beginning that it takes)."""
        spark, n = self.sized.sparkSession, F.lit(self.total).cast("long")
        grain = max(1, self.total // 1024)
        a = max(1, isqrt(max(0, self.total - 1)) + 1)
        part = F.explode(F.sequence(F.floor(F.col("first") / grain), F.floor((F.col("first") + F.col("slots") - 1) / grain))).alias("grain")
        held = self.sources.where("slots > 0").select("*", part)
        drawn = spark.range(max(0, self.total)).withColumnRenamed("id", "slot").withColumn("at", permuted(F.col("slot"), n, F.lit(a), F.lit(-(-self.total // a) or 1), F.lit(self.seed))).withColumn("grain", F.floor(F.col("at") / grain))
        drawn = drawn.join(held, "grain").where("at >= first and at < first + slots").withColumn("k", F.col("at") - F.col("first"))
        nth = F.col("k") % F.col("blocks")
        index = permuted(F.least(nth, F.col("full") - 1), F.col("full"), F.col("a"), F.col("b"), F.lit(self.seed + 1), F.floor(F.col("k") / F.col("blocks")), F.col("s_null"), F.col("s"))
        drawn = drawn.withColumn("block", F.when(nth < F.col("full"), index).otherwise(nth)).withColumn("length", F.least(F.lit(self.block), F.col("source_size") - F.col("block") * self.block))
        last = (F.col("k") == F.col("slots") - 1) & (F.col("rest") > 0)
        cut = F.col("rest") - (F.col("slots") - 1 - F.col("rounds") * F.col("blocks")) * self.block
        return drawn.select(F.floor(F.col("slot") / self.shard).alias("shard"), "slot", *KEY, "block", F.when(last, F.least("length", cut)).otherwise(F.col("length")).alias("words"), (F.col("k") >= F.col("rounds") * F.col("blocks")).alias("partial"))

    def placed(self) -> DataFrame:
        """The sized documents with the place of their first word in their source's stream, and the source's figures."""
        parts = max(1, -(-self.rows // PART_ROWS))
        rows = self.sized.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
        inner = Window.partitionBy(*KEY, "part").orderBy("id", "size", "th")
        rows = rows.withColumn("start", F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        sums = self.sized.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).groupBy(*KEY, "part").agg(F.sum("size").alias("held"))
        sums = sums.withColumn("base", F.sum("held").over(Window.partitionBy(*KEY).orderBy("part")) - F.col("held")).drop("held")
        rows = rows.join(sums, [*KEY, "part"]).withColumn("start", F.col("start") + F.col("base")).drop("part", "base")
        return rows.join(self.sources.select(*KEY, "source_size", "target", "rounds"), KEY)

    def pieces(self, placed: DataFrame) -> DataFrame:
        """Documents with words, by the blocks that they reach into: the words of each that the mix takes, by block.

        Columns of placed, lo and hi (words within the document), times (whole draws of them), some (words from lo
        that the permutation beyond the whole rounds takes).
        """
        drawn = self.manifest().groupBy(*KEY, "block").agg(F.count(F.when(~F.col("partial"), 1)).alias("times"), F.coalesce(F.max(F.when(F.col("partial"), F.col("words"))), F.lit(0)).alias("words"))
        end = F.col("start") + F.col("size")
        rows = placed.where("size > 0").select("*", F.explode(F.sequence(F.floor(F.col("start") / self.block), F.floor((end - 1) / self.block))).alias("block"))
        rows = rows.join(drawn, [*KEY, "block"], "left").fillna(0, ["times", "words"])
        at = F.col("block") * self.block
        lo, hi = F.greatest("start", at), F.least(end, at + self.block)
        return rows.withColumn("lo", lo - F.col("start")).withColumn("hi", hi - F.col("start")).withColumn("some", F.greatest(F.lit(0), F.least(hi, at + F.col("words")) - lo))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """One row per document: id, size, source_size, target, taken.

    Null texts have size 0; null is a source of its own, the last; documents without words are taken 0 times. Rows
    that share an id each get their own words. An empty table gives an empty result. Other columns are ignored.
    """
    mix = Mix(docs, id_col, text_col, source_col, **options)
    placed = mix.placed()
    keys = ["id", "size", "source_size", "target"]
    taken = mix.pieces(placed).groupBy(*KEY, "start", *keys).agg(F.sum((F.col("hi") - F.col("lo")) * F.col("times") + F.col("some")).cast("long").alias("taken"))
    none = placed.where("size = 0").select(*keys, F.lit(0).cast("long").alias("taken"))
    return taken.select(*keys, "taken").unionByName(none).withColumnRenamed("id", id_col)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself, with the columns of docs: a document as often as its source's whole rounds, and its words that
    the last, partial round takes as one more row. Documents of which nothing is taken go; n_chars follows the text."""
    mix = Mix(docs, id_col, text_col, source_col, **options)
    placed = mix.placed()
    some = F.when(F.col("some") > 0, F.struct("lo", (F.col("lo") + F.col("some")).alias("hi")))
    found = mix.pieces(placed).groupBy(*KEY, "start", "id", "th", "rounds").agg(F.array_sort(F.collect_list(some)).alias("runs")).where("rounds > 0 or size(runs) > 0")
    # rows that agree in id, source and text take one entry each, in the order of their places
    found = found.groupBy(F.struct("id", *KEY, "th").alias("_key")).agg(F.array_sort(F.collect_list(F.struct("start", "rounds", "runs"))).alias("_each"))
    own = docs.withColumn("_key", F.struct(F.col(id_col).alias("id"), F.col(source_col).isNull().alias("s_null"), F.coalesce(source_col, F.lit("")).alias("s"), F.xxhash64(text_col).alias("th")))
    own = own.where(F.col(text_col).isNotNull()).withColumn("_nth", F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(*docs.columns))))
    rows = own.join(found, "_key").withColumn("_one", F.get("_each", F.col("_nth") - 1)).where("_one IS NOT NULL")
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    # bound to a variable, so that a text is taken apart once, not once for each of its runs
    parted = F.transform(F.array(F.struct(words.alias("w"), F.col("_one.runs").alias("r"))), lambda x: F.array_join(F.flatten(F.transform(x["r"], lambda r: F.slice(x["w"], r["lo"].cast("int") + 1, (r["hi"] - r["lo"]).cast("int")))), ""))
    cut = F.when(F.size("_one.runs") > 0, parted).otherwise(F.array().cast("array<string>"))
    texts = F.concat(F.array_repeat(F.col(text_col), F.col("_one.rounds").cast("int")), cut)
    rows = rows.withColumn("_text", F.explode(texts)).withColumn(text_col, F.col("_text"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length(text_col).cast("long"))
    return rows.select(docs.columns)
