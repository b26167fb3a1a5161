"""Rings as arrays of points (x, y; the last joins the first): half-plane and box clips, areas, and the cut at 180 degrees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of the value, which is computed once however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _edges(ring: Column) -> Column:
    """p and q of each edge. ring is a column or a bound value."""
    return F.transform(ring, lambda p, i: F.struct(p.alias("p"), F.get(ring, (i + 1) % F.size(ring)).alias("q")))


def clipped(ring: Column, beyond: Callable[[Column], Column]) -> Column:
    """The part of the ring where beyond(point), a linear function, isn't above 0. Of each edge its first point stays, if
    it is inside, and where it crosses the line the point of crossing."""

    def kept(edge: Column) -> Column:
        p, q = edge["p"], edge["q"]
        s, t = beyond(p), beyond(q)
        share = s / (s - t)
        cross = F.struct((p["x"] + share * (q["x"] - p["x"])).alias("x"), (p["y"] + share * (q["y"] - p["y"])).alias("y"))
        return F.array_compact(F.array(F.when(s <= 0, p), F.when((s <= 0) != (t <= 0), cross)))

    return _bound(ring, lambda r: F.flatten(F.transform(_edges(r), kept)))


def in_box(ring: Column, west, south, east, north) -> Column:
    """The part of the ring within a box."""
    ring = clipped(ring, lambda p: F.lit(west) - p["x"])
    ring = clipped(ring, lambda p: p["x"] - F.lit(east))
    ring = clipped(ring, lambda p: F.lit(south) - p["y"])
    return clipped(ring, lambda p: p["y"] - F.lit(north))


def area(ring: Column) -> Column:
    """The ring's area, whichever way it runs."""
    cross = lambda e: e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]
    return _bound(ring, lambda r: F.abs(F.aggregate(F.transform(_edges(r), cross), F.lit(0.0), lambda s, v: s + v)) / 2)


def split_at_turn(ring: Column, half=180.0) -> Column:
    """The parts of a ring with running longitudes (they may go beyond 180): an array of rings, each within -180..180."""
    moved = lambda r, by: F.transform(r, lambda p: F.struct((p["x"] + by).alias("x"), p["y"].alias("y")))
    own = clipped(clipped(ring, lambda p: p["x"] - half), lambda p: -half - p["x"])
    east = moved(clipped(ring, lambda p: half - p["x"]), -2 * half)
    west = moved(clipped(ring, lambda p: p["x"] + half), 2 * half)
    return F.filter(F.array(own, east, west), lambda r: (F.size(r) >= 3) & (area(r) > 0))
