"""Exact dedup over an extendible-hash index kept in shared files; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farfield.llm.common import stored

#: Entries (distinct texts) that a bucket may hold before it is split.
BUCKET_ROWS = 50_000
#: Further doublings than evenly spread entries need: the directory has some 2**SPARE slots for each bucket.
SPARE = 3
#: Up to so many rows (16 bytes each) of the directory, and hashes of repeated texts, are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Parts that the copies of a text are folded in before they go to its bucket's owner.
FOLDS = 8


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _slot(depth: int) -> Column:
    """Leading bits of the hash."""
    return F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")


def doublings(entries: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """How often the directory doubles at most for so many entries."""
    return SPARE + max(0, -(-entries // bucket_rows) - 1).bit_length()


def directory(entries: DataFrame, bucket_rows: int = BUCKET_ROWS, max_depth: int | None = None) -> DataFrame:
    """One row per used slot: slot, depth (of its bucket), bucket (its first slot).

    Starting from one bucket, a bucket with more than bucket_rows entries is split on the next bit, doubling the
    directory where needed. As every depth is a prefix of the next, all doublings come from one histogram of the
    slots: the bucket of a slot ends at the first depth where its prefix isn't overfull. At max_depth it stays.
    """
    max_depth = doublings(entries.count(), bucket_rows) if max_depth is None else max_depth
    slots = entries.groupBy(_slot(max_depth).alias("slot")).agg(F.count("*").alias("n"))
    depths = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"))
    prefix = F.expr(f"shiftright(slot, {max_depth} - depth)")
    full = depths.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n").alias("held"))
    fits = (F.col("held") <= bucket_rows) | (F.col("depth") == max_depth)
    found = depths.select("slot", "depth", prefix.alias("prefix")).join(full, ["depth", "prefix"]).where(fits)
    return found.groupBy("slot").agg(F.min("depth").alias("depth")).select("slot", "depth", F.expr(f"shiftleft(shiftright(slot, {max_depth} - depth), {max_depth} - depth)").alias("bucket"))


class Index:
    """The index of a table's texts, in shared files.

    rows: id, h (64-bit hash), n_bytes, sha of every row. slots: the directory. buckets: bucket, depth, h, n_bytes, sha
    and n (rows) of each distinct text; a bucket is a range of hashes.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS):
        text = F.coalesce(F.col(text_col), F.lit(""))
        self.texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("t"))
        self.rows = stored(self.texts.select("id", "h", F.octet_length("t").alias("n_bytes"), F.sha2("t", 256).alias("sha")), "rows")
        entries = stored(self.rows.groupBy("h", "n_bytes", "sha").agg(F.count("*").alias("n")), "entries")
        self.depth = doublings(entries.count(), bucket_rows)
        self.slots = stored(directory(entries, bucket_rows, self.depth), "slots")
        self.buckets = stored(self.placed(entries), "buckets")

    def placed(self, hashed: DataFrame) -> DataFrame:
        """Rows with a hash h, and the bucket that the directory has for it."""
        return hashed.withColumn("slot", _slot(self.depth)).join(_small(self.slots), "slot").drop("slot")

    def chains(self) -> DataFrame:
        """bucket, h, n_bytes, sha, keep, group_size of each text that may be repeated.

        The rows of hashes that come more than once go to the task that owns their bucket, copies folded on the way; there
        the texts of a hash, a chain, are compared by their bytes.
        """
        repeated = stored(self.buckets.groupBy("bucket", "h").agg(F.sum("n").alias("n")).where("n > 1").select("bucket", "h"), "repeated")
        found = self.texts.join(_small(repeated), "h")
        folded = found.groupBy("bucket", "h", "t", F.pmod(F.spark_partition_id(), F.lit(FOLDS)).alias("fold")).agg(F.max("id").alias("keep"), F.count("*").alias("n"))
        owned = folded.repartition("bucket").groupBy("bucket", "h", "t").agg(F.max("keep").alias("keep"), F.sum("n").alias("group_size"))
        return owned.select("bucket", "h", F.octet_length("t").alias("n_bytes"), F.sha2("t", 256).alias("sha"), "keep", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty. The row with the largest id of equal texts stays; a null id counts as the smallest,
    and of rows that also share their id exactly one stays. An empty table gives an empty result; other columns of
    the input, whatever their names, are ignored. Each row is looked up in the index by the bucket of its hash: copies
    are folded before they meet there, so a group may hold any share of the rows.
    """
    index = Index(docs, id_col, text_col, bucket_rows)
    # rows that agree in id and text become one with a count, so that one of them can stay
    same = index.placed(index.rows.groupBy("id", "h", "n_bytes", "sha").agg(F.count("*").cast("int").alias("m"))).drop("depth")
    found = same.join(index.chains(), ["bucket", "h", "n_bytes", "sha"], "left").withColumn("keep", F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep")))
    found = found.select("*", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("nth"))
    return found.select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep")) & (F.col("nth") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that exact_dedup() doesn't keep; all columns stay. Of rows that agree in id and text, that
    whose columns are least as JSON stays."""
    found = stored(exact_dedup(docs, id_col, text_col), "exact")
    key = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    keys = F.struct(F.col(id_col).alias("i"), key.alias("s"))
    gone = found.where(~F.col("kept")).select(F.struct(F.col(id_col).alias("i"), F.col("text_sha256").alias("s")).alias("_key"), F.col(id_col).eqNullSafe(F.col("keep_id")).alias("_twin"))
    marked = docs.withColumn("_key", keys)
    rest = marked.join(gone.select("_key").distinct(), "_key", "left_anti")
    twins = marked.join(gone.where("_twin").select("_key").distinct(), "_key", "left_semi")
    row = F.struct(*docs.columns)
    twins = twins.groupBy("_key").agg(F.min_by(row, F.to_json(row)).alias("_row")).select("_row.*")
    return rest.drop("_key").unionByName(twins)
