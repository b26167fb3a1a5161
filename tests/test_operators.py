"""Operators against brute force on small random inputs."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from farfield.operators import checks, components, polygons, pyramid, raster, search, segments


@pytest.mark.parametrize("seed", range(6))
def test_envelope(seed):
    rng = np.random.default_rng(seed)
    g2 = rng.integers(0, 60, 40) ** 2
    g2[rng.random(40) < 0.3] = raster.FAR
    at = np.arange(40)
    want = ((at[:, None] - at[None, :]) ** 2 + g2[None, :]).min(1)
    assert np.array_equal(raster.envelope(g2), np.minimum(want, want))


def test_distance_transform(spark):
    rng = random.Random(3)
    on = {(rng.randrange(30), rng.randrange(20)) for _ in range(9)}
    rows = raster.distance_transform(spark.createDataFrame(sorted(on), "row long, col long"), 30, 20).collect()
    assert len(rows) == 600
    assert all(r["d2"] == min((r["row"] - a) ** 2 + (r["col"] - b) ** 2 for a, b in on) for r in rows)


def test_distance_transform_without_sources(spark):
    rows = raster.distance_transform(spark.createDataFrame([], "row long, col long"), 3, 4).collect()
    assert len(rows) == 12 and all(r["d2"] is None for r in rows)


def test_components_over_block_borders(spark):
    rng = random.Random(5)
    cells = {(rng.randrange(24), rng.randrange(24)) for _ in range(220)}
    got = {(r["row"], r["col"]): r["label"] for r in components.label_components(spark.createDataFrame(sorted(cells), "row long, col long"), block=5, width=100).collect()}
    want = {}
    for start in sorted(cells):
        if start not in want:
            stack = [start]
            want[start] = start[0] * 100 + start[1]
            while stack:
                r, c = stack.pop()
                for near in ((r + a, c + b) for a in (-1, 0, 1) for b in (-1, 0, 1)):
                    if near in cells and near not in want:
                        want[near] = want[start]
                        stack.append(near)
    assert got == want


def test_water_gap_keeps_components_apart(spark):
    cells = spark.createDataFrame([(0, c) for c in (0, 1, 4, 5)], "row long, col long")
    assert components.label_components(cells).select("label").distinct().count() == 2


def test_dead_interior(spark):
    cells = spark.createDataFrame([(r, c) for r in range(5) for c in range(5)], "row long, col long")
    assert sorted(map(tuple, components.dead_cells(cells, [], wide=False).collect())) == [(r, c) for r in (1, 2, 3) for c in (1, 2, 3)]


@pytest.mark.parametrize("seed", range(4))
def test_supercover(spark, seed):
    rng = random.Random(seed)
    rows = [(i, *(rng.randrange(100) for _ in range(4))) for i in range(12)]
    got = {(r["id"], r["row"], r["col"]) for r in segments.supercover(spark.createDataFrame(rows, "id long, x1 long, y1 long, x2 long, y2 long"), 10).collect()}
    for i, x1, y1, x2, y2 in rows:
        for k in range(1001):
            x, y = x1 + (x2 - x1) * k / 1000, y1 + (y2 - y1) * k / 1000
            assert (i, math.floor(y / 10), math.floor(x / 10)) in got


@pytest.mark.parametrize("seed", range(4))
def test_nearest_segment(spark, seed):
    rng = random.Random(seed)
    ways = [(i, *(rng.randrange(1000) for _ in range(4))) for i in range(25)] + [(99, 5, 5, 5, 5)]
    points = [(i, rng.randrange(1000), rng.randrange(1000), 1500) for i in range(20)]
    got = {r["id"]: (r["way_id"], r["dist"]) for r in segments.nearest_segment(spark.createDataFrame(points, "id long, px long, py long, bound long"), spark.createDataFrame(ways, "way_id long, x1 long, y1 long, x2 long, y2 long"), 200, ["id"]).collect()}
    for i, px, py, _ in points:
        def far(w):
            _, x1, y1, x2, y2 = w
            n = (x2 - x1) ** 2 + (y2 - y1) ** 2
            t = 0 if not n else max(0, min(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / n))
            return math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1))
        best = min((far(w), w[0]) for w in ways)
        assert abs(got[i][1] - best[0]) < 1e-9 and got[i][0] == best[1]


def test_ring_with_a_hole(spark):
    ring = lambda part, pts: [(1, part, i, x, y) for i, (x, y) in enumerate(pts)]
    corners = spark.createDataFrame(ring(0, [(0, 0), (4, 0), (4, 4), (0, 4)]) + ring(1, [(1, 1), (1, 2), (2, 2), (2, 1)]), "id long, part long, seq long, x long, y long")
    edges = polygons.ring_edges(corners, ["id", "part"])
    assert polygons.polygon_areas(edges, ["id"]).first()["area2"] == 30
    points = spark.createDataFrame([(1, 1.5, 1.5), (2, 3.0, 3.0), (3, 5.0, 1.0)], "p long, px double, py double")
    inside = polygons.points_in_polygons(points, edges.drop("part"), ["p"], ["id"], 10).collect()
    assert [r["p"] for r in inside] == [2]


def test_pyramid_mode(spark):
    level = lambda *px: {(r["x"], r["y"]): r["cls"] for r in pyramid.halved(spark.createDataFrame([(i % 2, i // 2, c) for i, c in enumerate(px) if c is not None], "x long, y long, cls long")).collect()}
    assert level(5, 5, 5, 7) == {(0, 0): 5}
    assert level(9, 7, None, None) == {}
    assert level(7, 7, None, None) == {(0, 0): 7}
    assert level(9, 7, 7, 9) == {(0, 0): 7}
    assert level(254, None, None, None) == {}


def _model(dist, xs, ys, n, apart):
    taken = []
    for i in np.argsort(-dist, kind="stable"):
        if all(math.hypot(xs[i] - xs[j], ys[i] - ys[j]) >= apart for j in taken):
            taken.append(int(i))
            if len(taken) == n:
                break
    return taken


def _model_with_islands(order, xs, ys, island, n, cap, apart):
    taken, main = [], 0
    for i in order:
        if all(math.hypot(xs[i] - xs[j], ys[i] - ys[j]) >= apart for j in taken) and not (island[i] and sum(island[j] for j in taken) >= cap):
            taken.append(int(i))
            main += not island[i]
            if main == n:
                break
    return taken


@pytest.mark.parametrize("seed", range(40))
def test_spread_out(seed):
    rng = np.random.default_rng(seed)
    xs, ys, island = rng.integers(0, 30, 200), rng.integers(0, 30, 200), rng.random(200) < 0.5
    assert search.spread_out(xs, ys, island, 9.0, 6, None) == _model(-np.arange(200.0), xs, ys, 6, 9.0)
    assert search.spread_out(xs, ys, island, 6.0, 5, 2) == _model_with_islands(range(200), xs, ys, island, 5, 2, 6.0)


@pytest.mark.parametrize("cap", [None, 2])
def test_search_finds_what_refining_all_would(spark, cap):
    rng = np.random.default_rng(3)
    rows, refined = [], []
    for unit in range(5):
        n = 300 if unit else 4
        dist = rng.uniform(0, 1000, n).round(1)
        rows += [(unit, k, float(dist[k] + rng.uniform(0, 80)), bool(rng.random() < 0.4), float(rng.uniform(0, 100)), float(rng.uniform(0, 100)), float(dist[k])) for k in range(n)]
    frame = spark.createDataFrame(rows, "unit long, cell long, upper double, island boolean, x double, y double, dist double")

    def refine(cells):
        refined.append(cells.count())
        return cells.select("unit", "cell").join(frame.select("unit", "cell", "x", "y", "dist"), ["unit", "cell"])

    got = search.search_units(frame.select("unit", "cell", "upper", "island"), refine, ["unit"], 4, 12.0, cap).collect()
    for unit in range(5):
        own = sorted((r for r in rows if r[0] == unit), key=lambda r: (-r[6], r[1]))
        xs, ys = [r[4] for r in own], [r[5] for r in own]
        island = [r[3] and cap is not None for r in own]
        want = _model_with_islands(range(len(own)), xs, ys, island, 4, 2, 12.0)
        assert [r["cell"] for r in sorted((r for r in got if r["unit"] == unit), key=lambda r: r["rank"])] == [own[k][1] for k in want]
    assert sum(refined) < len(rows)


def test_search_takes_what_lies_below_the_last_band(spark):
    # no cell is left after the first band (0.6 of 100), and two points are below its end
    rows = [(1, k, 100.0 - k, False, 20.0 * k, 0.0, dist) for k, dist in enumerate((70.0, 30.0, 1.0))]
    frame = spark.createDataFrame(rows, "unit long, cell long, upper double, island boolean, x double, y double, dist double")
    refine = lambda cells: cells.select("unit", "cell").join(frame.select("unit", "cell", "x", "y", "dist"), ["unit", "cell"])
    got = search.search_units(frame.select("unit", "cell", "upper", "island"), refine, ["unit"], 3, 12.0).collect()
    assert sorted((r["rank"], r["cell"]) for r in got) == [(1, 0), (2, 1), (3, 2)]


def test_short_claims_are_checked_exactly(spark):
    # a metre from a way, between two of its whole metres: a step of a metre would measure 1.118 m
    rows = [(1, 1000, 5.5, 1.0, 0, 0, 9, 0), (2, 1010, 5.5, 1.0, 0, 0, 9, 0), (3, 0, 5.0, 0.0, 0, 0, 9, 0)]
    met = spark.createDataFrame(rows, "id long, claim long, px double, py double, x1 long, y1 long, x2 long, y2 long")
    assert {r["id"]: r["passed"] for r in checks.rechecked(met, ["id"]).collect()} == {1: True, 2: False, 3: True}


def test_labels_of_blocks():
    from farfield.operators.components import _label

    rng = np.random.default_rng(1)
    cells = [(g, int(r), int(k)) for g in "ab" for r in range(40) for k in range(40) if rng.random() < 0.4]
    got = _label(pd.DataFrame(cells, columns=["g", "row", "col"]))
    root = {}
    for start in sorted(cells):
        todo = [start] if start not in root else []
        while todo:
            g, r, k = cell = todo.pop()
            if cell in set(cells) and cell not in root:
                root[cell] = start
                todo += [(g, r + a, k + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    assert {(r.g, r.row, r.col): (r.g, r.lr, r.lc) for r in got.itertuples()} == root


def test_grid_shift_rules(spark):
    rows = spark.createDataFrame([(1000, 1005, 10), (1000, 1200, 10), (1000, 1005, 900), (1000, None, 0)], "o long, s long, m long")
    passed, blocking = checks.grid_shift(F.col("o"), F.col("s"), F.col("m"))
    assert [tuple(r) for r in rows.select(passed, blocking).collect()] == [(True, True), (False, True), (False, False), (False, True)]


def test_tiles_hold_the_pixels(spark):
    rng = np.random.default_rng(2)
    cells = {(int(x), int(y)): int(v) for x, y, v in zip(rng.integers(0, 40, 300), rng.integers(0, 40, 300), rng.integers(0, 254, 300), strict=True)}
    frame = spark.createDataFrame([(6, x, y, v) for (x, y), v in cells.items()], "z int, x long, y long, cls long")
    got = pyramid.tiles(frame, 16).collect()
    seen = {}
    for r in got:
        raw = np.frombuffer(bytes(r["blob"]), dtype=np.uint8).reshape(16, 16)
        for y, x in zip(*np.nonzero(raw != 255), strict=True):
            seen[r["tx"] * 16 + int(x), (63 - r["ty"]) * 16 + int(y)] = int(raw[y, x])
    assert seen == cells and len(got) == len({(x // 16, y // 16) for x, y in cells})


def test_sample_is_the_least_of_the_hashes(spark):
    from farfield.plans.spatial import _sampled

    cells = raster.frame(spark, 30, 30).withColumn("unit_id", F.col("row") % 3)
    keys = [(r["unit_id"], r["h"], r["row"], r["col"]) for r in cells.select("*", F.xxhash64("row", "col", F.lit(7)).alias("h")).collect()]
    want = {k for u in range(3) for k in sorted(k for k in keys if k[0] == u)[:5]}
    assert {(r["unit_id"], r["row"], r["col"]) for r in _sampled(cells, 5).collect()} == {(u, r, c) for u, _, r, c in want}


def test_rings_by_sums(spark):
    rng = np.random.default_rng(5)
    on = {(int(r), int(k)) for r, k in zip(rng.integers(0, 25, 150), rng.integers(0, 30, 150), strict=True)}
    marked = spark.createDataFrame(sorted(on), "row long, col long")
    centres = [(i, int(r), int(k)) for i, (r, k) in enumerate(zip(rng.integers(0, 25, 20), rng.integers(0, 30, 20), strict=True))]
    for r_in, r_out in ((-1, 4), (0, 3), (3, 8), (2.5, 6.2)):
        got = {r["id"]: (r["n"], r["hits"]) for r in raster.ring_density(spark.createDataFrame(centres, "id long, row long, col long"), marked, ["id"], r_in, r_out, 25, 30).collect()}
        for i, r, k in centres:
            ring = [(a, b) for a in range(25) for b in range(30) if (r_in < 0 or (a - r) ** 2 + (b - k) ** 2 > r_in**2) and (a - r) ** 2 + (b - k) ** 2 <= r_out**2]
            assert got[i] == (len(ring), sum(x in on for x in ring))


def test_fragments_follow_their_bodies(spark):
    from farfield.operators.merging import merged_fragments

    pieces = [(1, 50, 0, 0), (2, 5, 50, 0), (3, 3, 55, 2), (4, 3, 200, 200), (5, 3, 203, 203), (6, 40, 300, 0)]
    got = merged_fragments(spark.createDataFrame(pieces, "id long, side long, x long, y long"), 10, 20).collect()
    assert {r["id"]: r["body"] for r in got} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}


def test_list_structure(spark):
    good = [(1, k, 100 - k, 0, 0, None) for k in range(1, 6)]
    bad = {2: [(2, 1, 9, 0, 0, None), (2, 3, 8, 0, 0, None)], 3: [(3, 1, -1, 0, 0, None)] * 1, 4: [(4, 1, 9, 1800001, 0, None)], 5: [(5, 1, 9, 0, 0, 7), (5, 2, 9, 0, 0, 7)], 6: [(6, 1, 9, 0, 0, None)]}
    rows = spark.createDataFrame(good + [r for v in bad.values() for r in v], "unit_id long, rank long, dist_cm long, lon_e4 long, lat_e4 long, island long")
    got = {r["unit_id"]: r["passed"] for r in checks.list_structure(rows, ["unit_id"], 1, 1, -900000, 900000).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}
