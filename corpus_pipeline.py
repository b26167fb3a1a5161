"""From documents to packed training sequences: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farfield.llm.common import stored, table
from farfield.llm.exact_dedup import drop_copies
from farfield.llm.minhash_dedup import near_classes
from farfield.llm.mixing import mixed_documents
from farfield.llm.packing import pack
from farfield.llm.quality import without_rejected


def _without(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """docs without the rows that `judged` doesn't keep, told by their id and text (which no two rows share by then)."""
    key = F.struct(F.col("doc_id").alias("i"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    gone = stored(judged.where(~F.col("kept")).select(F.struct(F.col("doc_id").alias("i"), F.col("text_hash").alias("h")).alias("_key")), "gone")
    return docs.withColumn("_key", key).join(gone, "_key", "left_anti").drop("_key")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return without_rejected(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document stays."""
    return _without(docs, near_classes(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or their words that are drawn, as often as the mix takes them."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of the documents in sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", packed)]

#: The near copies, the classifier and the tokenizer are beyond SQL. Tests hold the rows of the exact stage against brute
#: force; of the others only columns and that filters add no rows, and run() only on an empty table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
