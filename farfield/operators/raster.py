"""Rasters as (row, col) tables: the exact distance transform, windows of units, rings around a cell."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FAR = 1 << 30


def frame(spark: SparkSession, height: int, width: int) -> DataFrame:
    """All cells of a frame."""
    return spark.range(height * width).select(F.floor(F.col("id") / width).alias("row"), (F.col("id") % width).alias("col"))


def envelope(g2: np.ndarray) -> np.ndarray:
    """min over c' of (c - c')**2 + g2[c'] for each c, by the lower envelope of parabolas; FAR where nothing is near."""
    known = np.flatnonzero(g2 < FAR)
    if not len(known):
        return np.full(len(g2), FAR, dtype=np.int64)
    hull, starts = [int(known[0])], [-np.inf]
    for q in known[1:].tolist():
        while True:
            p = hull[-1]
            s = (g2[q] + q * q - g2[p] - p * p) / (2 * (q - p))
            if s > starts[-1]:
                break
            hull.pop()
            starts.pop()
        hull.append(q)
        starts.append(s)
    at = np.arange(len(g2))
    own = np.array(hull)[np.searchsorted(np.array(starts), at, side="left").clip(1) - 1]
    return ((at - own) ** 2 + g2[own]).astype(np.int64)


def distance_transform(sources: DataFrame, height: int, width: int) -> DataFrame:
    """row, col, d2: the exact squared distance in cells to the nearest source cell, for every cell of the frame; null
    if there is none.

    Separable: along columns, the nearest source above and below by running windows; along rows, the lower envelope of
    the columns' parabolas. A task holds one row at a time.
    """
    marked = frame(sources.sparkSession, height, width).join(sources.select("row", "col").distinct().withColumn("_on", F.col("row")), ["row", "col"], "left")
    down = Window.partitionBy("col").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("col").orderBy("row").rowsBetween(0, Window.unboundedFollowing)
    above, below = F.last("_on", ignorenulls=True).over(down), F.first("_on", ignorenulls=True).over(up)
    gap = F.least(F.col("row") - above, below - F.col("row"))
    columns = marked.select("row", "col", F.coalesce(gap * gap, F.lit(FAR)).alias("g2"))

    def along(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("col")
        d2 = envelope(pdf.g2.to_numpy())
        return pd.DataFrame({"row": pdf.row, "col": pdf.col, "d2": pd.array(np.where(d2 >= FAR, -1, d2), dtype="int64")})

    return columns.groupBy("row").applyInPandas(along, "row long, col long, d2 long").withColumn("d2", F.when(F.col("d2") >= 0, F.col("d2")))


def capped(d2, res: float, most: float):
    """Metres of a squared distance in cells, at most `most`."""
    metres = F.sqrt(d2.cast("double")) * res
    return F.when(metres < most, metres).otherwise(float(most))


def windows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The tight window of each key's cells."""
    return cells.groupBy(*keys).agg(F.min("row").alias("row_off"), F.min("col").alias("col_off"), (F.max("row") - F.min("row") + 1).alias("height"), (F.max("col") - F.min("col") + 1).alias("width"), F.count("*").alias("cells"))


def ring_offsets(spark: SparkSession, r_in: float, r_out: float) -> DataFrame:
    """dr, dc of the cells farther than r_in and not farther than r_out."""
    r = int(np.ceil(r_out))
    side = spark.range(-r, r + 1)
    d2 = F.col("dr") * F.col("dr") + F.col("dc") * F.col("dc")
    return side.select(F.col("id").alias("dr")).join(side.select(F.col("id").alias("dc"))).where((d2 > r_in * r_in) & (d2 <= r_out * r_out))


def ring_density(centres: DataFrame, marked: DataFrame, keys: list[str], r_in: float, r_out: float, height: int, width: int) -> DataFrame:
    """Marked cells further than r_in (below 0: the centre counts, too) and up to r_out from each centre (row, col),
    clipped to the frame: keys, n, hits. A ring is a chord or two in each row, and a chord's count the difference of two
    running sums along the row."""
    on = marked.select("row", "col").distinct().withColumn("_on", F.lit(1))
    along = Window.partitionBy("row").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    sums = frame(centres.sparkSession, height, width).join(on, ["row", "col"], "left").select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.sum(F.coalesce("_on", F.lit(0))).over(along).alias("_sum"))
    reach = int(np.floor(r_out))
    half = lambda r: F.floor(F.sqrt(F.lit(float(r * r)) - F.col("_a") * F.col("_a")))
    rows = centres.withColumn("_a", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn("_r", F.col("row") + F.col("_a")).where((F.col("_r") >= 0) & (F.col("_r") < height))
    chord = lambda w, sign: F.struct(F.greatest(F.lit(0), F.col("col") - w).alias("lo"), F.least(F.lit(width - 1), F.col("col") + w).alias("hi"), F.lit(sign).alias("sign"))
    hole = F.when(F.abs(F.col("_a")) <= r_in, chord(half(r_in), -1)) if r_in >= 0 else F.lit(None)
    chords = F.array_compact(F.array(chord(half(r_out), 1), hole)) if r_in >= 0 else F.array(chord(half(r_out), 1))
    ends = rows.withColumn("_k", F.explode(chords)).where("_k.lo <= _k.hi")
    ends = ends.withColumn("_e", F.explode(F.array(F.struct(F.col("_k.hi").alias("at"), F.col("_k.sign").alias("sign"), (F.col("_k.sign") * (F.col("_k.hi") - F.col("_k.lo") + 1)).alias("n")), F.struct((F.col("_k.lo") - 1).alias("at"), (-F.col("_k.sign")).alias("sign"), F.lit(0).alias("n")))))
    ends = ends.select(*keys, "_r", F.col("_e.at").alias("_c"), F.col("_e.sign").alias("_s"), F.col("_e.n").alias("_n"))
    found = ends.join(sums, ["_r", "_c"], "left").groupBy(*keys)
    return found.agg(F.sum("_n").alias("n"), F.sum(F.col("_s") * F.coalesce("_sum", F.lit(0))).alias("hits"))


def by_block(cells: DataFrame, size: int, f: Callable, schema: str) -> DataFrame:
    """f of each block's cells."""
    return cells.withColumn("_br", F.floor(F.col("row") / size)).withColumn("_bc", F.floor(F.col("col") / size)).groupBy("_br", "_bc").applyInPandas(f, schema)
