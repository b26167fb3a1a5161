"""Published points: what is shown, ranks within and across units, exclusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["scenario", "unit_id"]


def ranked(points: DataFrame, keys: list[str] = KEYS, dist: str = "dist_cm", tie: str = "event_id") -> DataFrame:
    """rank 1..n within each list, farthest first."""
    return points.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(dist).desc(), tie)))


def without(points: DataFrame, excluded: DataFrame, keys: list[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """points without those whose (keys, rank) are excluded, ranks renumbered from 1 and the old ones in old_rank; and
    the exclusions that match no point, which callers treat as an error."""
    on = [*keys, "rank"]
    kept = points.join(excluded.select(*on).distinct(), on, "left_anti").withColumnRenamed("rank", "old_rank")
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("old_rank")))
    return kept, excluded.select(*on).distinct().join(points.select(*on), on, "left_anti")


def withheld(points: DataFrame, kept: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """How many points of each list were excluded."""
    n = points.groupBy(*keys).agg(F.count("*").alias("n"))
    return n.join(kept.groupBy(*keys).agg(F.count("*").alias("k")), keys, "left").select(*keys, (F.col("n") - F.coalesce("k", F.lit(0))).alias("withheld"))


def visible(points: DataFrame, islands: bool, top: int, keys: list[str] = KEYS) -> DataFrame:
    """The first `top` points of each list, islands left out if asked, numbered as shown."""
    rows = points if islands else points.where(F.col("island").isNull())
    return rows.withColumn("display", F.row_number().over(Window.partitionBy(*keys).orderBy("rank"))).where(F.col("display") <= top)


def best(points: DataFrame, mainland_only: bool = False, keys: list[str] = KEYS) -> DataFrame:
    """keys and `top`, the leading point: the first, or the first that isn't on an island."""
    rows = points.where(F.col("island").isNull()) if mainland_only else points
    names = [c for c in points.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*names), "rank").alias("top"))


def regional_ranks(points: DataFrame, mainland_only: bool = False) -> DataFrame:
    """scenario, unit_id, dist_cm, regional_rank: dense ranks of the units' leading points; equal distances share one.
    A unit without such a point isn't ranked. The window holds one row per unit."""
    rows = best(points, mainland_only).select(*KEYS, F.col("top.dist_cm").alias("dist_cm"))
    return rows.withColumn("regional_rank", F.dense_rank().over(Window.partitionBy("scenario").orderBy(F.col("dist_cm").desc())))


def unit_order(ranks: DataFrame, other: DataFrame, units: DataFrame) -> DataFrame:
    """units with their place in the list: by rank, then by the other scenario's, then by code; without a rank last."""
    rows = units.join(ranks.select("unit_id", F.col("regional_rank").alias("own")), "unit_id", "left").join(other.select("unit_id", F.col("regional_rank").alias("other")), "unit_id", "left")
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.col("own").asc_nulls_last(), F.col("other").asc_nulls_last(), "code")))


def winner(rank: Column, code: Column) -> Column:
    """Aggregate: the code with the lowest rank, else the first code."""
    return F.coalesce(F.min_by(code, F.when(rank.isNotNull(), F.struct(rank, code))), F.min(code))


def merged_documents(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new replace those of old with the same key; the rest of old stays."""
    values = [c for c in old.columns if c != key]
    o, n = old.select(key, F.struct(*values).alias("_o")), new.select(key, F.struct(*values).alias("_n"))
    return o.join(n, key, "full_outer").select(key, F.coalesce("_n", "_o").alias("_v")).select(key, *[F.col(f"_v.{c}").alias(c) for c in values])
