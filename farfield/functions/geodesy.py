"""Distances on the WGS84 ellipsoid."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from farfield.functions.crs import FLATTENING, A

B = A * (1 - FLATTENING)
STEPS = 100


def geodesic(lon1, lat1, lon2, lat2) -> np.ndarray:
    """Lengths of geodesics by Vincenty's inverse formula, iterated until all have settled: exact to a millimetre for
    the distances met here (under 500 km); not meant for points near each other's antipodes."""
    u1, u2 = np.arctan((1 - FLATTENING) * np.tan(np.radians(lat1))), np.arctan((1 - FLATTENING) * np.tan(np.radians(lat2)))
    span = np.radians((np.asarray(lon2) - lon1 + 540.0) % 360.0 - 180.0)
    s1, c1, s2, c2, lam = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2), span
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(STEPS):
            sin_s = np.hypot(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam))
            cos_s = s1 * s2 + c1 * c2 * np.cos(lam)
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s == 0, 0.0, c1 * c2 * np.sin(lam) / sin_s)
            cos2_a = 1 - sin_a**2
            cos_2m = np.where(cos2_a == 0, 0.0, cos_s - 2 * s1 * s2 / cos2_a)
            c = FLATTENING / 16 * cos2_a * (4 + FLATTENING * (4 - 3 * cos2_a))
            before, lam = lam, span + (1 - c) * FLATTENING * sin_a * (sigma + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1)))
            if np.all(np.abs(lam - before) < 1e-13):
                break
    u = cos2_a * (A * A - B * B) / (B * B)
    big_a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    big_b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    delta = big_b * sin_s * (cos_2m + big_b / 4 * (cos_s * (2 * cos_2m**2 - 1) - big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)))
    return B * big_a * (sigma - delta)


@F.pandas_udf(DoubleType())
def geodesic_m(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """geodesic() of columns, by batches: the iteration has no closed form to write as an expression."""
    return pd.Series(geodesic(lon1.to_numpy(), lat1.to_numpy(), lon2.to_numpy(), lat2.to_numpy()))


def planar_degrees2(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Squared planar distance in degrees with the cosine of the first latitude: only orders a shortlist."""
    d = -(F.pmod(lon2 - lon1 + 180.0, F.lit(360.0)) - 180.0) * F.cos(F.radians(lat1))
    return d * d + (lat2 - lat1) * (lat2 - lat1)
