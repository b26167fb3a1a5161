"""Projections as column expressions: UTM, Lambert azimuthal equal-area, Web Mercator, and grid arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84, and UTM's scale and false origin.
A, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)
UTM_SCALE, UTM_EAST, UTM_NORTH = 0.9996, 500000.0, 10000000.0
M_PER_DEG = 111320.0
PAD_SAFETY = 0.002
MERCATOR_LAT = 85.0511


def utm_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone, without exceptions; zones are held in 1..60."""
    zone = F.least(F.lit(60), F.greatest(F.lit(1), F.floor((lon + 180.0) / 6.0) + 1))
    return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("int")


def utm(lon: Column, lat: Column, epsg: Column) -> tuple[Column, Column]:
    """Easting and northing in the zone of epsg, by Krueger's series to the fourth order in n."""
    n = FLATTENING / (2 - FLATTENING)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    central = F.radians((epsg % 100 - 1) * 6 - 180 + 3)
    phi, lam = F.radians(lat), F.radians(lon) - central
    s = F.sin(phi)
    atanh = lambda x: F.log((1 + x) / (1 - x)) / 2
    t = F.sinh(atanh(s) - E * atanh(E * s))
    xi, eta = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for j, a in enumerate(alpha, 1):
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    base = F.when(epsg >= 32700, UTM_NORTH).otherwise(0.0)
    return UTM_EAST + UTM_SCALE * radius * east, base + UTM_SCALE * radius * north


def _authalic(sin_phi):
    """q of the authalic latitude."""
    return (1 - E2) * (sin_phi / (1 - E2 * sin_phi * sin_phi) - F.log((1 - E * sin_phi) / (1 + E * sin_phi)) / (2 * E))


def laea(lon: Column, lat: Column, lon0: float, lat0: float, x0: float = 0.0, y0: float = 0.0) -> tuple[Column, Column]:
    """Lambert azimuthal equal-area on the ellipsoid."""
    q = lambda s: (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E * s) / (1 + E * s)) / (2 * E))
    qp, s0 = q(1 - 1e-16), math.sin(math.radians(lat0))
    beta0 = math.asin(q(s0) / qp)
    rq = A * math.sqrt(qp / 2)
    d = A * math.cos(math.radians(lat0)) / math.sqrt(1 - E2 * s0 * s0) / (rq * math.cos(beta0))
    beta, lam = F.asin(_authalic(F.sin(F.radians(lat))) / qp), F.radians(lon - lon0)
    b = rq * F.sqrt(2 / (1 + math.sin(beta0) * F.sin(beta) + math.cos(beta0) * F.cos(beta) * F.cos(lam)))
    x = b * d * F.cos(beta) * F.sin(lam)
    y = b / d * (math.cos(beta0) * F.sin(beta) - math.sin(beta0) * F.cos(beta) * F.cos(lam))
    return x + x0, y + y0


def laea_pad(lon: Column, lat: Column, lon0: float, lat0: float, safety: float = PAD_SAFETY) -> Column:
    """Relative length distortion at a point, plus a margin: an equal-area map stretches one way what it shrinks the
    other, by 1 / cos(c / 2) at the angular distance c from its centre (sphere of the same area)."""
    phi, phi0, lam = F.radians(lat), math.radians(lat0), F.radians(lon - lon0)
    cos_c = math.sin(phi0) * F.sin(phi) + math.cos(phi0) * F.cos(phi) * F.cos(lam)
    return F.sqrt(2 / (1 + cos_c)) - 1 + safety


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    held = F.greatest(F.lit(-MERCATOR_LAT), F.least(F.lit(MERCATOR_LAT), lat))
    return A * F.radians(lon), A * F.log(F.tan(math.pi / 4 + F.radians(held) / 2))


def tile_xy(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Slippy tile coordinates."""
    n = float(2**zoom)
    phi = F.radians(lat)
    return F.floor((lon + 180.0) / 360.0 * n), F.floor((1.0 - F.log(F.tan(phi) + 1.0 / F.cos(phi)) / math.pi) / 2.0 * n)


def half_diagonal(res: float) -> float:
    return res * math.sqrt(2) / 2


def upper_bound(coarse: Column, res: float, pad: Column) -> Column:
    """The farthest any point of a cell can be from a road, from its coarse distance."""
    return (coarse + 2 * half_diagonal(res)) * (1 + pad)


def cell_of(x: Column, y: Column, x0, y1, res) -> tuple[Column, Column]:
    """Row (downwards from y1) and column."""
    return F.floor((y1 - y) / res), F.floor((x - x0) / res)


def search_box(lat: Column, lon: Column, radius_m: Column) -> Column:
    """west, south, east, north around a point; the cosine of the latitude is held at 0.05 or more."""
    dlat = radius_m / M_PER_DEG
    dlon = dlat / F.greatest(F.cos(F.radians(lat)), F.lit(0.05))
    return F.struct((lon - dlon).alias("west"), (lat - dlat).alias("south"), (lon + dlon).alias("east"), (lat + dlat).alias("north"))


def georef(lat: Column, lon: Column, res_m: float, window_m: float) -> Column:
    """Placement of a detail raster: its north-west corner, pixel sizes in degrees, and pixel counts."""
    n = round(window_m / res_m)
    dlat = F.lit(res_m / M_PER_DEG)
    dlon = dlat / F.cos(F.radians(lat))
    return F.struct((lon - dlon * n / 2).alias("west"), (lat + dlat * n / 2).alias("north"), dlon.alias("dlon"), dlat.alias("dlat"), F.lit(n).alias("width"), F.lit(n).alias("height"))


def bearing8(dx: Column, dy: Column) -> Column:
    """Compass wind of a direction, of eight."""
    k = F.floor(F.pmod(F.degrees(F.atan2(dx, dy)) + 22.5, F.lit(360.0)) / 45).cast("int")
    return F.element_at(F.array(*[F.lit(w) for w in ("N", "NE", "E", "SE", "S", "SW", "W", "NW")]), k + 1)
