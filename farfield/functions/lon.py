"""Longitudes around the antimeridian."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lon_delta(a: Column, b: Column, turn=360.0) -> Column:
    """a minus b the short way round, in (-turn/2, turn/2]."""
    half = turn // 2 if isinstance(turn, int) else turn / 2
    return -(F.pmod(b - a + half, F.lit(turn)) - half)


def split_bbox(west: Column, south: Column, east: Column, north: Column, turn=360.0) -> Column:
    """An array of one or two boxes inside one turn, for a box that may run past the line. East must not be west of west."""
    half = turn // 2 if isinstance(turn, int) else turn / 2
    w = F.pmod(west + half, F.lit(turn)) - half
    e = w + (east - west)
    box = lambda x, y: F.struct(x.alias("west"), south.alias("south"), y.alias("east"), north.alias("north"))
    lo, hi = F.lit(-half), F.lit(half)
    bad = F.raise_error(F.lit("a box is never inverted")).cast("array<struct<west:double,south:double,east:double,north:double>>")
    found = F.when(east - west >= turn, F.array(box(lo, hi))).when(e <= half, F.array(box(w, e))).otherwise(F.array(box(w, hi), box(lo, e - turn)))
    return found if isinstance(turn, int) else F.when((east < west) | (north < south), bad).otherwise(found)


def merged_spans(spans: DataFrame, keys: list[str], west: str = "west", east: str = "east") -> DataFrame:
    """Overlapping or touching spans of each key as one (gaps and islands)."""
    order = Window.partitionBy(*keys).orderBy(west, east)
    reach = F.max(east).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.when(reach.isNull() | (F.col(west) > reach), 1).otherwise(0))
    marked = marked.withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_group").agg(F.min(west).alias(west), F.max(east).alias(east)).drop("_group")


def wrapped_spans(merged: DataFrame, keys: list[str], west: str = "west", east: str = "east", turn=360.0, tolerance=1e-6) -> DataFrame:
    """west, east of each key's merged spans the short way round: cut at the widest gap (the last of equals) where they
    reach both edges of the turn and that makes them shorter."""
    half = turn // 2 if isinstance(turn, int) else turn / 2
    gap = F.lead(west).over(Window.partitionBy(*keys).orderBy(west)) - F.col(east)
    rows = merged.withColumn("_gap", gap).withColumn("_next", F.lead(west).over(Window.partitionBy(*keys).orderBy(west)))
    cut = F.max(F.when(F.col("_gap").isNotNull(), F.struct("_gap", F.col(west).alias("_at"), F.col("_next").alias("w"), F.col(east).alias("e"))))
    found = rows.groupBy(*keys).agg(F.min(west).alias("_w"), F.max(east).alias("_e"), cut.alias("_cut"))
    spans = found.withColumn("_cw", F.col("_cut.w")).withColumn("_ce", F.col("_cut.e") + turn)
    wraps = F.col("_cut").isNotNull() & (F.abs(F.col("_w") + half) <= tolerance) & (F.abs(F.col("_e") - half) <= tolerance) & (F.col("_ce") - F.col("_cw") < F.col("_e") - F.col("_w"))
    return spans.select(*keys, F.when(wraps, F.col("_cw")).otherwise(F.col("_w")).alias(west), F.when(wraps, F.col("_ce")).otherwise(F.col("_e")).alias(east))


def unwrapped_rings(points: DataFrame, keys: list[str], seq: str, lon: str, turn=360.0) -> DataFrame:
    """points with lon made continuous along each ring: after a step of more than half a turn all is shifted by a turn;
    rings that ran below the lower edge come up by one."""
    half = turn // 2 if isinstance(turn, int) else turn / 2
    order = Window.partitionBy(*keys).orderBy(seq)
    step = F.col(lon) - F.lag(lon).over(order)
    jump = F.when(step > half, -turn).when(step < -half, turn).otherwise(turn - turn)
    out = points.withColumn("_jump", jump).withColumn(lon, F.col(lon) + F.sum("_jump").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    low = F.min(lon).over(Window.partitionBy(*keys))
    return out.withColumn("_low", low).withColumn(lon, F.when(F.col("_low") < -half, F.col(lon) + turn).otherwise(F.col(lon))).drop("_jump", "_low")


def view_bounds(west: Column, south: Column, east: Column, north: Column, turn=360.0) -> Column:
    """[[south, west], [north, east]], shifted by a turn where the box's centre lies past the line."""
    shift = F.when((west + east) / 2 > turn / 2, F.lit(-turn)).otherwise(F.lit(turn - turn))
    return F.array(F.array(south, west + shift), F.array(north, east + shift))


def lon_inside(cached_west: Column, cached_east: Column, west: Column, east: Column, turn=360.0) -> Column:
    """Whether a span lies in a cached one, whichever turn either is written on."""
    start = cached_west + F.pmod(west - cached_west, F.lit(turn))
    return (cached_east - cached_west >= turn) | (start + (east - west) <= cached_east)
