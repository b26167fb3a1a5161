"""Distance classes, the ladder of thresholds, and what a class byte says."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved class bytes, sentinels of the ladder, palette stops, and the class edges as (from, to, step).
EDGE, NODATA = 254, 255
NO_LEVEL, BELOW_LADDER = 65535, 65534
STOPS_M = (1000, 2500, 5000, 10000, 20000, 50000)
BANDS = ((0, 2500, 50), (2500, 10000, 100), (10000, 30000, 250), (30000, 60000, 1000), (60000, 240000, 10000), (240000, 240001, 1))
STEP = 0.01


def default_edges() -> list[int]:
    return [e for band in BANDS for e in range(*band)]


def checked_edges(edges: list[int]) -> list[int]:
    """The edges, if they could stand for BANDS: as many steps, each a positive number of whole metres, from 0 on."""
    steps = [b - a for a, b in zip(edges, edges[1:], strict=False)]
    if list(edges[:1]) != [BANDS[0][0]] or len(steps) != len(default_edges()) - 1 or not all(s > 0 and s % 1 == 0 for s in steps):
        raise ValueError(f"not {EDGE} rising whole metres from {BANDS[0][0]} on")
    return [int(e) for e in edges]


def edges_column(edges: list[int] | None = None) -> Column:
    return F.array(*[F.lit(e) for e in checked_edges(edges or default_edges())])


def to_class(dist: Column, edges: list[int] | None = None) -> Column:
    """Class of a distance: the last edge not above it. Negative and non-finite distances are errors.

    Default edges have equal steps within each band, so their class is arithmetic; others are counted.
    """
    if edges is None:
        first, found = 0, None
        for lo, hi, step in BANDS:
            value = first + F.floor((dist - lo) / step)
            found = F.when(dist < hi, value) if found is None else found.when(dist < hi, value)
            first += len(range(lo, hi, step))
        cls = found.otherwise(EDGE - 1)
    else:
        cls = F.size(F.filter(edges_column(edges), lambda e: e <= dist)) - 1
    fine = (dist >= 0) & (dist < float("inf"))
    return F.when(dist.isNull(), None).when(fine, cls).otherwise(F.raise_error(F.lit("distances must be finite and not negative"))).cast("int")


def class_lower(cls: Column) -> Column:
    return F.element_at(edges_column(), cls + 1)


def class_upper(cls: Column) -> Column:
    """The next class's edge; null for the last, which is open."""
    return F.when(cls < EDGE - 1, F.element_at(edges_column(), F.least(cls + 2, F.lit(EDGE))))


def class_mid(cls: Column) -> Column:
    return F.coalesce((class_lower(cls) + class_upper(cls)) / 2, class_lower(cls).cast("double"))


def kind(cls: Column) -> Column:
    """What a class byte is: nodata (also null), edge or class."""
    return F.when(cls.isNull() | (cls == NODATA), "nodata").when(cls == EDGE, "edge").otherwise("class")


def precedence(off: Column, band: Column, cls: Column) -> Column:
    """The byte of a pixel: nodata before edge before its class."""
    return F.when(off, NODATA).when(band, EDGE).otherwise(cls)


def palette_band(cls: Column) -> Column:
    """Number of the palette's band, from the class's lower edge; null below the first stop."""
    lower, found = class_lower(cls), F.lit(None).cast("int")
    for i, stop in enumerate(STOPS_M):
        found = F.when(lower >= stop, i).otherwise(found)
    return found


def ladder_index(dist: Column, anchor, step: float = STEP) -> Column:
    """The first rung at or below a distance; NO_LEVEL for none."""
    rung = F.ceil(F.log(dist / anchor) / math.log(1 - step))
    return F.when(dist > 0, F.greatest(F.lit(0), F.least(F.lit(BELOW_LADDER), rung))).otherwise(NO_LEVEL).cast("int")


def ladder_value(rung: Column, anchor, step: float = STEP) -> Column:
    return anchor * F.pow(F.lit(1 - step), rung)


def level(dist: Column, land: Column, anchor, step: float = STEP) -> Column:
    """A cell's rung; land below every rung has its own value, what isn't land none."""
    rung = ladder_index(dist, anchor, step)
    return F.when(~land, NO_LEVEL).when(rung == NO_LEVEL, BELOW_LADDER).otherwise(rung)


def col_threshold(a: Column, b: Column, fraction: float) -> Column:
    """The height of the pass that two points must stay above to count as one place."""
    return fraction * F.least(a, b)
