"""Class pyramids: each level takes the mode of 2 x 2 pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.functions.classes import NODATA


def halved(pixels: DataFrame, x: str = "x", y: str = "y", cls: str = "cls") -> DataFrame:
    """The next level of a sparse raster; absent pixels are nodata.

    The most frequent class wins, of equal ones the least; nodata only wins against fewer votes than its own. Every
    pixel carries its vote through one partial aggregation.
    """
    votes = pixels.where(F.col(cls) != NODATA).groupBy(F.floor(F.col(x) / 2).alias(x), F.floor(F.col(y) / 2).alias(y), cls).agg(F.count("*").alias("n"))
    best = votes.groupBy(x, y).agg(F.max(F.struct("n", (-F.col(cls)).alias("c"))).alias("b"), F.sum("n").alias("data"))
    return best.where(F.col("b.n") >= 4 - F.col("data")).select(x, y, (-F.col("b.c")).alias(cls))


def pyramid(pixels: DataFrame, zoom: int, least: int) -> DataFrame:
    """z, x, y, cls of all levels from zoom down to least."""
    level, out = pixels.select("x", "y", "cls"), pixels.select(F.lit(zoom).alias("z"), "x", "y", "cls")
    for z in range(zoom - 1, least - 1, -1):
        level = halved(level)
        out = out.unionByName(level.select(F.lit(z).alias("z"), "x", "y", "cls"))
    return out


def tiles(pixels: DataFrame, size: int = 256) -> DataFrame:
    """z, tx, ty (tile, rows counted from below), blob: size x size bytes per tile, absent pixels nodata."""
    row = F.floor(F.col("y") / size)
    dealt = pixels.select("z", F.floor(F.col("x") / size).alias("tx"), row.alias("ty"), ((F.col("y") % size) * size + F.col("x") % size).cast("int").alias("at"), "cls")

    def pack(pdf):
        import numpy as np
        import pandas as pd

        raw = np.full(size * size, NODATA, dtype=np.uint8)
        raw[pdf["at"].to_numpy()] = pdf["cls"].to_numpy()
        return pd.DataFrame({"z": [pdf.z.iloc[0]], "tx": [pdf.tx.iloc[0]], "ty": [(1 << int(pdf.z.iloc[0])) - 1 - pdf.ty.iloc[0]], "blob": [raw.tobytes()]})

    return dealt.groupBy("z", "tx", "ty").applyInPandas(pack, "z int, tx long, ty long, blob binary")
