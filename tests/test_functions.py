"""Scalar functions on cases with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from farfield.functions import classes, crs, lon, tags, text
from farfield.functions.geodesy import geodesic


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("tag, a, b", [("motorway", True, True), ("track", True, False), ("busway", True, True), ("path", False, False), ("steps", False, False), (None, False, False), ("Primary", False, False)])
def test_classify(spark, tag, a, b):
    row = spark.createDataFrame([(tag,)], "highway string").select(*tags.classify(F.col("highway"))).first()
    assert (row["in_a"], row["in_b"]) == (a, b)


def test_scenario_text_has_the_sets():
    assert set(tags.ROADS_A) - set(tags.ROADS_B) == {"track"}


@pytest.mark.parametrize(
    "dist, cls", [(0, 0), (49, 0), (50, 1), (2499, 49), (2500, 50), (9999, 124), (10000, 125), (29999, 204), (30000, 205), (59999, 234), (60000, 235), (239999, 252), (240000, 253), (250000, 253)]
)
def test_class_of_distance(spark, dist, cls):
    assert one(spark, classes.to_class(F.lit(float(dist)))) == cls
    assert one(spark, classes.to_class(F.lit(float(dist)), classes.default_edges())) == cls


def test_class_errors(spark):
    for bad in (-1.0, math.inf, math.nan):
        with pytest.raises(Exception):
            one(spark, classes.to_class(F.lit(bad)))
    with pytest.raises(ValueError):
        classes.checked_edges(list(range(10)))


def test_class_bounds(spark):
    assert one(spark, classes.class_upper(F.lit(253))) is None
    assert one(spark, classes.class_mid(F.lit(0))) == 25.0
    assert one(spark, classes.class_lower(F.lit(252))) == 230000


def test_ladder(spark):
    rung = lambda d: one(spark, classes.ladder_index(F.lit(float(d)), 1000.0))
    assert rung(1000) == 0 and rung(2000) == 0 and rung(0) == classes.NO_LEVEL
    for d in (999.0, 500.0, 12.5):
        k = rung(d)
        assert one(spark, classes.ladder_value(F.lit(k), 1000.0)) <= d * (1 + 1e-12) < one(spark, classes.ladder_value(F.lit(k - 1), 1000.0)) * (1 + 1e-9)


@pytest.mark.parametrize("a, b, fraction, want", [(100, 60, 0.5, 30), (80, 80, 0.25, 20)])
def test_col_threshold(spark, a, b, fraction, want):
    assert one(spark, classes.col_threshold(F.lit(a), F.lit(b), fraction)) == want


@pytest.mark.parametrize("x, y, epsg", [(23.5, 54.4, 32634), (25.3, 54.7, 32635), (-3, 40, 32630), (5, 60, 32631), (151.2, -33.9, 32756), (-180, 10, 32601), (180, 10, 32660)])
def test_utm_zone(spark, x, y, epsg):
    assert one(spark, crs.utm_epsg(F.lit(float(x)), F.lit(float(y)))) == epsg


def test_half_diagonal():
    assert abs(crs.half_diagonal(250) - 176.7767) < 1e-3


def test_utm_distances_agree_with_geodesics(spark):
    """Nearby points: the projected distance over the scale factor is the geodesic's, to a few parts in 10,000."""
    epsg = F.lit(32634)
    (x1, y1), (x2, y2) = (crs.utm(F.lit(a), F.lit(b), epsg) for a, b in ((21.0, 54.4), (21.01, 54.41)))
    row = spark.range(1).select(x1.alias("a"), y1.alias("b"), x2.alias("c"), y2.alias("d")).first()
    planar = math.hypot(row["a"] - row["c"], row["b"] - row["d"])
    assert abs(planar / 0.9996 / float(geodesic(21.0, 54.4, 21.01, 54.41)) - 1) < 2e-4
    assert abs(row["a"] - 500000) < 1e-3


def test_geodesic_known_lengths():
    # a degree of the equator, and a quarter of a meridian
    assert abs(float(geodesic(0.0, 0.0, 1.0, 0.0)) - 111319.491) < 0.01
    assert abs(float(geodesic(0.0, 0.0, 0.0, 90.0)) - 10001965.729) < 0.01
    assert float(geodesic(5.0, 5.0, 5.0, 5.0)) == 0
    assert abs(float(geodesic(179.9, 10.0, -179.9, 10.0)) - float(geodesic(0.0, 10.0, 0.2, 10.0))) < 1e-6


@pytest.mark.parametrize("a, b, want", [(0.0, 180.0, 180.0), (-179.9, 179.9, 0.2), (179.9, -179.9, -0.2), (10.0, 20.0, -10.0)])
def test_lon_delta(spark, a, b, want):
    assert abs(one(spark, lon.lon_delta(F.lit(a), F.lit(b))) - want) < 1e-9


def test_split_bbox(spark):
    boxes = lambda *v: [tuple(b) for b in one(spark, lon.split_bbox(*map(F.lit, v)))]
    assert boxes(172.0, 1.0, 230.0, 2.0) == [(172.0, 1.0, 180.0, 2.0), (-180.0, 1.0, -130.0, 2.0)]
    assert boxes(-10.0, 1.0, 20.0, 2.0) == [(-10.0, 1.0, 20.0, 2.0)]
    assert boxes(-200.0, 1.0, 200.0, 2.0) == [(-180.0, 1.0, 180.0, 2.0)]
    with pytest.raises(Exception):
        boxes(10.0, 1.0, 5.0, 2.0)


def test_cached_window_modulo_a_turn(spark):
    inside = lambda *v: one(spark, lon.lon_inside(*[F.lit(float(x)) for x in v]))
    assert inside(170, 190, -179, -175) and not inside(170, 190, -179, -165) and inside(0, 360, 5, 400)


@pytest.mark.parametrize("m, said", [(4, "0 m"), (994, "990 m"), (996, "1.0 km"), (9949, "9.9 km"), (9950, "10 km"), (123456, "123 km")])
def test_distances_as_text(spark, m, said):
    assert one(spark, text.fmt_dist(F.lit(float(m)))) == said


def test_opl_fields(spark):
    assert one(spark, text.parse_tags(F.lit("a=1,b=,a=2,c"))) == {"a": "2", "b": "", "c": ""}
    assert [tuple(m) for m in one(spark, text.parse_members(F.lit("n5@label,w12@out%20%er")))] == [("n", 5, "label"), ("w", 12, "out er")]


def test_escape_round_trip(spark):
    assert one(spark, text.decode_escapes(F.lit("%4e2d%%6587% x%1f1f1%"))) == "中文 x🇱"
    assert one(spark, text.html_escape(F.lit("<a href='x'>&</a>"))) == "&lt;a href=&#39;x&#39;&gt;&amp;&lt;/a&gt;"


def test_laea_and_mercator_by_known_points(spark):
    """The published example of the European grid, and a point of the Mercator tiles' eastern edge."""
    x, y = (one(spark, v) for v in crs.laea(F.lit(5.0), F.lit(50.0), 10.0, 52.0, 4321000.0, 3210000.0))
    assert abs(x - 3962799.45) < 0.02 and abs(y - 2999718.85) < 0.02
    x, y = (one(spark, v) for v in crs.mercator(F.lit(180.0), F.lit(60.0)))
    assert abs(x - 20037508.3428) < 0.01 and abs(y - 8399737.8898) < 0.01


@pytest.mark.parametrize(("lon", "lat"), [(10.0, 52.0), (30.0, 60.0), (-9.0, 38.0), (45.0, 35.0)])
def test_pad_covers_the_distortion(spark, lon, lat):
    """The pad is the largest relative error of a short map distance in any direction, and its safety."""
    from farfield.functions.geodesy import geodesic_m

    at = [one(spark, v) for v in crs.laea(F.lit(lon), F.lit(lat), 10.0, 52.0)]
    worst = 0.0
    for k in range(12):
        lon2, lat2 = lon + 0.01 * math.sin(k * math.pi / 6), lat + 0.01 * math.cos(k * math.pi / 6)
        to = [one(spark, v) for v in crs.laea(F.lit(lon2), F.lit(lat2), 10.0, 52.0)]
        ground = one(spark, geodesic_m(F.lit(lon), F.lit(lat), F.lit(lon2), F.lit(lat2)))
        scale = math.dist(at, to) / ground
        worst = max(worst, scale - 1, 1 / scale - 1)
    pad = one(spark, crs.laea_pad(F.lit(lon), F.lit(lat), 10.0, 52.0))
    assert worst <= pad <= 1.15 * worst + 0.002 + 0.0005  # twelve directions may miss the worst by a seventh


def test_clips_lose_no_area(spark):
    """Star-shaped rings, cut at 180 degrees: the parts lie within the turn and have the ring's area together."""
    import random

    from farfield.functions import clipping

    rng, rows = random.Random(3), []
    for k in range(60):
        at, n = rng.choice([0.0, 170.0, 180.0, -175.0, 200.0]), rng.randint(3, 12)
        radii = [rng.uniform(1, 40) for _ in range(n)]
        rows.append((k, [(at + r * math.cos(2 * math.pi * i / n), r * math.sin(2 * math.pi * i / n)) for i, r in enumerate(radii)]))
    frame = spark.createDataFrame(rows, "id long, ring array<struct<x:double,y:double>>")
    got = frame.select("id", clipping.area(F.col("ring")).alias("whole"), clipping.split_at_turn(F.col("ring")).alias("parts"))
    got = got.select("*", F.transform("parts", clipping.area).alias("areas")).collect()
    for r, (_, ring) in zip(sorted(got, key=lambda r: r["id"]), rows, strict=True):
        shoelace = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2
        assert r["whole"] == pytest.approx(shoelace) and sum(r["areas"]) == pytest.approx(shoelace)
        assert all(-180 - 1e-9 <= p["x"] <= 180 + 1e-9 for part in r["parts"] for p in part)
    triangle = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (4.0, 0.0), (0.0, 4.0))])
    assert one(spark, clipping.area(clipping.in_box(triangle, 0.0, 0.0, 2.0, 2.0))) == pytest.approx(4.0)
    assert one(spark, F.size(clipping.in_box(triangle, 5.0, 5.0, 6.0, 6.0))) == 0


@pytest.mark.parametrize(
    ("value", "want"),
    [
        (lambda: text.decode_escapes(F.lit("%1f600%!")), "😀!"), (lambda: text.decode_escapes(F.lit("caf%e9%")), "café"), (lambda: text.decode_escapes(F.lit("100%")), "100%"),
        (lambda: text.flag(F.lit("lt")), "🇱🇹"), (lambda: text.flag(F.lit("us-ak")), ""), (lambda: text.total_size(F.lit("bytes 0-99/*")), None), (lambda: text.total_size(F.lit("x")), None),
        (lambda: text.hex_rgb(F.lit("#fff")), [255, 255, 255]), (lambda: text.checksum(F.lit("nothing")), ""), (lambda: text.fmt_km_exact(F.lit(1234567.0)), "1,234.57 km"), (lambda: text.fmt_km2(F.lit(9.96)), "10 km²"),
        (lambda: text.visitor_code(F.lit("us"), F.lit("ak")), "US-AK"), (lambda: text.content_type(F.lit("none")), "application/octet-stream"),
    ],
)
def test_texts(spark, value, want):
    assert one(spark, value()) == want
