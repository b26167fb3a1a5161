"""Sinks: stage results by unit, lists as nested JSON, tile archives, merged documents, upload plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.functions.text import content_type


def write_results(df: DataFrame, path: str, keys: list[str]) -> None:
    """Results by key; a rerun replaces only the keys it has. Spark's committer publishes whole partitions."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def nested_lists(points: DataFrame, keys: list[str]) -> DataFrame:
    """One row per list, its points in rank order: what is written as a JSON document."""
    names = [c for c in points.columns if c not in (*keys, "rank")]
    return points.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", *names))).alias("points"))


def write_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def upload_plan(local: DataFrame, remote: DataFrame, forced: list[str] = ()) -> DataFrame:
    """key, size, content_type of what must go up: keys that the other side lacks or has in another size, and forced ones."""
    same = remote.select("key", "size")
    again = local.where(F.col("key").isin(*forced)) if forced else local.limit(0)
    rest = local.join(same, ["key", "size"], "left_anti")
    return rest.unionByName(again).distinct().withColumn("content_type", content_type(F.col("key")))


def orphans(listed: DataFrame, referenced: DataFrame) -> DataFrame:
    """Keys of detail files (three parts) whose stem nothing refers to any more."""
    parts = F.split("key", "/")
    return listed.where(F.size(parts) == 4).withColumn("stem", F.regexp_replace("key", r"\.[^./]+$", "")).join(referenced.select("stem").distinct(), "stem", "left_anti").select("key")
