"""Lines as segments: cells they touch, tiles, densifying, and the nearest one to a point by bucketed equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _steps(lo: Column, hi: Column, size: int) -> Column:
    return F.sequence(F.floor(lo / size), F.floor(hi / size))


def touches_box(x0: Column, y0: Column, size: int) -> Column:
    """Whether the segment x1, y1, x2, y2 touches the square at x0, y0: their extents meet, and its line doesn't leave
    all corners on one side. Whole metres throughout, so the test is exact."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    side = lambda x, y: (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    corners = [side(x0 + a, y0 + b) for a in (0, size) for b in (0, size)]
    meet = (F.least(x1, x2) < x0 + size) & (F.greatest(x1, x2) >= x0) & (F.least(y1, y2) < y0 + size) & (F.greatest(y1, y2) >= y0)
    return meet & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def supercover(segments: DataFrame, size: int, row: str = "row", col: str = "col") -> DataFrame:
    """Each segment with every cell it touches (row and column count from the origin)."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    cells = segments.withColumn(col, F.explode(_steps(F.least(x1, x2), F.greatest(x1, x2), size)))
    cells = cells.withColumn(row, F.explode(_steps(F.least(y1, y2), F.greatest(y1, y2), size)))
    return cells.where(touches_box(F.col(col) * size, F.col(row) * size, size))


def densified(segments: DataFrame, step: float) -> DataFrame:
    """Points k = 0..n along each segment, with gaps of at most step."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    n = F.greatest(F.lit(1), F.ceil(F.sqrt((dx * dx + dy * dy).cast("double")) / step))
    points = segments.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))))
    return points.withColumn("px", F.col("x1") + dx * F.col("k") / F.col("n")).withColumn("py", F.col("y1") + dy * F.col("k") / F.col("n"))


def closest_share(px: Column, py: Column) -> Column:
    """Where on the segment (0 to 1) the point nearest to px, py lies; a segment of no length is its first end."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length2 = (dx * dx + dy * dy).cast("double")
    return F.when(length2 == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - F.col("x1")) * dx + (py - F.col("y1")) * dy) / length2)))


def segment_distance(px: Column, py: Column) -> Column:
    t = closest_share(px, py)
    ex = px - (F.col("x1") + t * (F.col("x2") - F.col("x1")))
    ey = py - (F.col("y1") + t * (F.col("y2") - F.col("y1")))
    return F.sqrt(ex * ex + ey * ey)


def within_bound(points: DataFrame, segments: DataFrame, bucket: int, keys: list[str], bound: str = "bound") -> DataFrame:
    """keys and the segments' columns: pairs that share a bucket which the point's bound reaches, each once.

    Segments are dealt to the buckets that they touch, points to those within their bound, so that the join is on
    equal buckets and no distance far beyond the bound is computed.
    """
    dealt = supercover(segments, bucket, "_row", "_col")
    reach = lambda v: F.sequence(F.floor((F.col(v) - F.col(bound)) / bucket), F.floor((F.col(v) + F.col(bound)) / bucket))
    asked = points.withColumn("_col", F.explode(reach("px"))).withColumn("_row", F.explode(reach("py")))
    return asked.join(dealt, ["_row", "_col"]).select(*keys, *segments.columns).distinct()


def nearest_segment(points: DataFrame, segments: DataFrame, bucket: int, keys: list[str], bound: str = "bound", way: str = "way_id") -> DataFrame:
    """keys, way, dist of each point's nearest segment; of equals the least way.

    points have px, py and `bound`, a proven upper bound of the distance. Segments are dealt to the buckets that they
    touch, points to those within their bound, so that the join is on equal buckets and no distance beyond the bound
    is computed.
    """
    dealt = supercover(segments, bucket, "_row", "_col")
    reach = lambda v: F.sequence(F.floor((F.col(v) - F.col(bound)) / bucket), F.floor((F.col(v) + F.col(bound)) / bucket))
    asked = points.withColumn("_col", F.explode(reach("px"))).withColumn("_row", F.explode(reach("py")))
    found = asked.join(dealt, ["_row", "_col"]).withColumn("dist", segment_distance(F.col("px"), F.col("py")))
    best = found.groupBy(*keys).agg(F.min(F.struct("dist", way)).alias("_best"))
    return best.select(*keys, F.col(f"_best.{way}").alias(way), F.col("_best.dist").alias("dist"))


def first_by(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")
