"""Registered queries over smaller rules: lattices, windows, bodies, texts, fallbacks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from farfield.functions import classes, crs, lon, text
from farfield.operators import components, polygons, raster
from farfield.plans import fixtures as fx
from farfield.plans.fixtures import CELLS, with_views

c = F.col
CASES: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        CASES[name] = (f, sql)
        return f

    return add


@query("p09_inside_fraction", with_views("units", "SELECT code, CAST(greatest(0, least(x0 + 40000, 130000) - greatest(x0, 30000)) AS BIGINT) * greatest(0, least(y0 + 40000, 150000) - greatest(y0, 10000)) * 2 >= 1600000000 AS inside FROM units"))
def p09(spark, d):
    """Whether half of a unit's area lies in the primary region."""
    from farfield.functions.clipping import area, in_box

    corner = lambda x, y: F.struct((c("x0") + x).cast("double").alias("x"), (c("y0") + y).cast("double").alias("y"))
    ring = F.array(corner(0, 0), corner(40000, 0), corner(40000, 40000), corner(0, 40000))
    share = area(in_box(ring, 30000.0, 10000.0, 130000.0, 150000.0)) / area(ring)
    return fx.units(spark, d).select("code", (share >= 0.5).alias("inside"))


@query("p16_summary_key", with_views("points", "SELECT event_id, CASE WHEN island IS NULL THEN scenario || '_mainland' ELSE scenario END AS key FROM points"))
def p16(spark, d):
    return fx.points(spark, d).select("event_id", F.when(c("island").isNotNull(), c("scenario")).otherwise(F.concat("scenario", F.lit("_mainland"))).alias("key"))


@query("p20_url_state", r"SELECT page_id, regexp_extract(url, '^https?://([^/:?#]+)', 1) AS host, regexp_extract(url, '^https?://[^/]+/([^/?#]*)', 1) AS region, coalesce(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), ''), '1') AS page FROM pages")
def p20(spark, d):
    """Host, first path segment and a parameter with its default, out of page addresses."""
    url = c("url")
    rows = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url")
    first = F.coalesce(F.regexp_extract(F.parse_url(url, F.lit("PATH")), "^/([^/]*)", 1), F.lit(""))
    return rows.select("page_id", F.parse_url(url, F.lit("HOST")).alias("host"), first.alias("region"), F.coalesce(F.parse_url(url, F.lit("QUERY"), F.lit("page")), F.lit("1")).alias("page"))


@query("g12_window_of_bbox", with_views("points", "SELECT event_id, greatest(0, y // 1000 - 3) AS row_off, greatest(0, x // 1000 - 3) AS col_off, least(199, y // 1000 + 3) - greatest(0, y // 1000 - 3) + 1 AS height, least(199, x // 1000 + 3) - greatest(0, x // 1000 - 3) + 1 AS width FROM points"))
def g12(spark, d):
    lo = lambda v: F.greatest(F.lit(0), F.floor(c(v) / 1000) - 3)
    hi = lambda v: F.least(F.lit(CELLS - 1), F.floor(c(v) / 1000) + 3)
    return fx.points(spark, d).select("event_id", lo("y").alias("row_off"), lo("x").alias("col_off"), (hi("y") - lo("y") + 1).alias("height"), (hi("x") - lo("x") + 1).alias("width"))


@query("g13_lattice", with_views("points", "SELECT event_id, x + 5 * i AS px, y + 5 * j AS py FROM (SELECT * FROM points), (SELECT unnest(generate_series(-5, 5)) AS i), (SELECT unnest(generate_series(-5, 5)) AS j)"))
def g13(spark, d):
    return _lattice(fx.points(spark, d))


def _lattice(points):
    """Lattice of 5 m around each point, reaching at most 27 m."""
    n = int(27 / 5 + 1e-9)
    steps = F.explode(F.sequence(F.lit(-n), F.lit(n)))
    rows = points.withColumn("i", steps).withColumn("j", steps)
    return rows.select("event_id", (c("x") + 5 * c("i")).alias("px"), (c("y") + 5 * c("j")).alias("py"))


@query("g19_cached_window", with_views("points", "SELECT event_id, lon_e4 + ((-lon_e4 % 3600000) + 3600000) % 3600000 + 50000 <= lon_e4 + 900000 AS inside FROM points"))
def g19(spark, d):
    return fx.points(spark, d).select("event_id", lon.lon_inside(c("lon_e4"), c("lon_e4") + 900000, F.lit(0), F.lit(50000), 3600000).alias("inside"))


@query("g25_bearing", with_views("points", "SELECT event_id, ['N','NE','E','SE','S','SW','W','NW'][1 + CAST(floor((((degrees(atan2(lon_e4, lat_e4 + 7)) + 22.5) % 360.0) + 360.0) % 360.0 / 45) AS INTEGER)] AS wind FROM points"))
def g25(spark, d):
    return fx.points(spark, d).select("event_id", crs.bearing8(c("lon_e4"), c("lat_e4") + 7).alias("wind"))


@query("g27_frame_shift", with_views("points", "SELECT event_id, CAST(floor((200500 - y) / 1000.0) AS BIGINT) AS row, CAST(floor((x - 500) / 1000.0) AS BIGINT) AS col FROM points"))
def g27(spark, d):
    row, col = crs.cell_of(c("x"), c("y"), 0 + 500, 200000 + 500, 1000)
    return fx.points(spark, d).select("event_id", row.alias("row"), col.alias("col"))


@query("g24_cell_at", with_views("points", "SELECT event_id, CASE WHEN x >= 50000 AND x < 150000 AND y >= 50000 AND y < 150000 THEN (149999 - y) // 2500 * 40 + (x - 50000) // 2500 END AS pixel FROM points"))
def g24(spark, d):
    """The pixel of a half-open raster that a point hits; null outside."""
    inside = c("x").between(50000, 149999) & c("y").between(50000, 149999)
    return fx.points(spark, d).select("event_id", F.when(inside, F.floor((149999 - c("y")) / 2500) * 40 + F.floor((c("x") - 50000) / 2500)).alias("pixel"))


@query("f06_ladder_value", "SELECT k, CAST(floor(60000.0 * pow(0.99, k) * 1000) AS BIGINT) AS mm FROM (SELECT unnest(generate_series(0, 400)) AS k)")
def f06(spark, d):
    return spark.range(401).select(c("id").alias("k"), F.floor(classes.ladder_value(c("id"), F.lit(60000.0)) * 1000).alias("mm"))


@query("f08_level_field", with_views("points", "SELECT event_id, CASE WHEN island IS NOT NULL THEN 65535 WHEN dist_cm <= 0 THEN 65534 ELSE CAST(greatest(0, least(65534, ceil(ln(dist_cm / 60000.0) / ln(0.99)))) AS INTEGER) END AS level FROM points"))
def f08(spark, d):
    return fx.points(spark, d).select("event_id", classes.level(c("dist_cm"), c("island").isNull(), 60000.0).alias("level"))


@query("f11_name_fallback", with_views("places", "SELECT place_id, coalesce(CASE WHEN place_id % 2 = 0 THEN name || ' (en)' END, CASE WHEN place_id % 3 = 0 THEN name END, 'p' || place_id) AS name FROM places"))
def f11(spark, d):
    english = F.when(c("place_id") % 2 == 0, F.concat("name", F.lit(" (en)")))
    return fx.places(spark, d).select("place_id", text.fallback_name(english, F.when(c("place_id") % 3 == 0, c("name")), F.concat(F.lit("p"), c("place_id").cast("string"))).alias("name"))


@query("f18_content_type", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'application/json' WHEN 1 THEN 'image/png' ELSE 'application/octet-stream' END AS kind FROM part")
def f18(spark, d):
    suffix = F.element_at(F.array(*map(F.lit, (".json", ".png", ".pmtiles", ""))), (c("p_partkey") % 4 + 1).cast("int"))
    path = F.concat(F.lit("r/"), F.replace("p_name", F.lit(" "), F.lit(".")), F.lit("x"), suffix)
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", text.content_type(path).alias("kind"))


@query("f20_document_errors", with_views("points", "SELECT event_id, CASE WHEN dist_cm < 0 THEN 'dist' WHEN lat_e4 NOT BETWEEN -750000 AND 750000 THEN 'lat' WHEN lon_e4 NOT BETWEEN -1700000 AND 1700000 THEN 'lon' END AS first_error FROM points"))
def f20(spark, d):
    """The first rule that a record breaks, in the order of the document."""
    rules = (("dist", c("dist_cm") >= 0), ("lat", c("lat_e4").between(-750000, 750000)), ("lon", c("lon_e4").between(-1700000, 1700000)))
    found = F.coalesce(*[F.when(~ok, name) for name, ok in rules])
    return fx.points(spark, d).select("event_id", found.alias("first_error"))


_LABELLED = """, reach(row, col, label) AS (SELECT row, col, row * 1048576 + col FROM water_cells UNION SELECT w.row, w.col, r.label FROM reach r JOIN water_cells w ON abs(w.row - r.row) <= 1 AND abs(w.col - r.col) <= 1),
 labelled AS (SELECT row, col, min(label) AS label FROM reach GROUP BY row, col), sized AS (SELECT *, count(*) OVER (PARTITION BY label) AS cells FROM labelled)"""


def _bodies(sql_views: str, body: str) -> str:
    return with_views(sql_views, _LABELLED + "\n " + body, recursive=True).replace("\n, reach", ",\n reach")


@query("j03_point_in_body", _bodies("water_cells points", "SELECT event_id, label FROM points p JOIN sized s ON s.row = p.y // 1000 AND s.col = p.x // 1000 WHERE cells >= 60"))
def j03(spark, d):
    """Points on bodies that are large enough, with the body's label."""
    labelled = components.label_components(fx.water_cells(spark, d))
    large = labelled.groupBy("label").agg(F.count("*").alias("cells")).where("cells >= 60").select("label")
    at = fx.points(spark, d).select("event_id", F.floor(c("y") / 1000).alias("row"), F.floor(c("x") / 1000).alias("col"))
    return at.join(labelled.join(large, "label"), ["row", "col"]).select("event_id", "label")


@query("v07b_distinct_areas", _bodies("water_cells ranked", """SELECT a.scenario, a.unit_id, a.rank AS rank_i, b.rank AS rank_j FROM kept a JOIN kept b USING (scenario, unit_id) JOIN labelled p ON p.row = a.y // 1000 AND p.col = a.x // 1000 JOIN labelled q ON q.row = b.y // 1000 AND q.col = b.x // 1000
 WHERE a.rank < b.rank AND b.rank <= 20 AND p.label = q.label"""))
def v07b(spark, d):
    """Pairs of a list's points that one component holds: they would not be distinct places."""
    from farfield.plans.published import _kept

    labelled = components.label_components(fx.water_cells(spark, d))
    rows = _kept(spark, d).where("rank <= 20").select("scenario", "unit_id", c("rank").cast("long").alias("rank"), F.floor(c("y") / 1000).alias("row"), F.floor(c("x") / 1000).alias("col")).join(labelled, ["row", "col"])
    i = rows.select("scenario", "unit_id", "label", c("rank").alias("rank_i"))
    j = rows.select("scenario", "unit_id", "label", c("rank").alias("rank_j"))
    return i.join(j, ["scenario", "unit_id", "label"]).where("rank_i < rank_j").select("scenario", "unit_id", "rank_i", "rank_j")


@query("j05_area_country", with_views("units", "SELECT code, country_id, CAST((x0 + 20000) // 100000 * 2 + (y0 + 20000) // 100000 AS BIGINT) AS block FROM units"))
def j05(spark, d):
    """The block that holds a unit's representative point."""
    return fx.units(spark, d).select("code", "country_id", (F.floor((c("x0") + 20000) / 100000) * 2 + F.floor((c("y0") + 20000) / 100000)).alias("block"))


@query("j12_hole_in_shell", with_views("points", "SELECT event_id, EXISTS (SELECT 1 FROM (VALUES (-3600000), (0), (3600000)) t(s) WHERE lon_e4 + s BETWEEN 1700000 AND 1999999) AS inside FROM points"))
def j12(spark, d):
    """Whether a shell that runs past the line holds a point, on any turn."""
    turns = [(c("lon_e4") + s).between(1700000, 1999999) for s in (-3600000, 0, 3600000)]
    return fx.points(spark, d).select("event_id", (turns[0] | turns[1] | turns[2]).alias("inside"))


@query("j22_smallest_enclosing", with_views("places water", "SELECT place_id, list(water_id ORDER BY side, water_id)[1:2] AS areas FROM places p JOIN water w ON p.x >= w.x AND p.x < w.x + w.side AND p.y >= w.y AND p.y < w.y + w.side GROUP BY place_id"))
def j22(spark, d):
    """The two smallest areas around each place."""
    edges = polygons.ring_edges(fx.water_corners(spark, d), ["water_id"])
    places = fx.places(spark, d).select("place_id", c("x").alias("px"), c("y").alias("py"))
    hits = polygons.points_in_polygons(places, edges, ["place_id"], ["water_id"], 10000).join(fx.water(spark, d).select("water_id", "side"), "water_id")
    held = hits.groupBy("place_id").agg(F.array_sort(F.collect_list(F.struct("side", "water_id"))).alias("l"))
    return held.select("place_id", F.transform(F.slice("l", 1, 2), lambda s: s["water_id"]).alias("areas"))


@query("j23_border_strip", with_views("roads", "SELECT highway, count(*) AS ways FROM roads WHERE x1 % 40000 <= 1200 OR x1 % 40000 >= 38800 GROUP BY highway"))
def j23(spark, d):
    return fx.roads(spark, d).where("x1 % 40000 <= 1200 OR x1 % 40000 >= 38800").groupBy("highway").agg(F.count("*").alias("ways"))


@query("w10_widest_gap", with_views("points", "SELECT unit_id, max(gap) AS gap FROM (SELECT unit_id, lead(lon_e4) OVER (PARTITION BY unit_id ORDER BY lon_e4) - lon_e4 AS gap FROM points) GROUP BY unit_id"))
def w10(spark, d):
    gap = F.lead("lon_e4").over(Window.partitionBy("unit_id").orderBy("lon_e4")) - c("lon_e4")
    return fx.points(spark, d).withColumn("gap", gap).groupBy("unit_id").agg(F.max("gap").alias("gap"))


@query("x21_unit_extremes", with_views("touched", "SELECT row, col, max(way_id) AS high, min(way_id) AS low FROM touched GROUP BY ALL"))
def x21(spark, d):
    """The highest and lowest index that touch a cell."""
    from farfield.operators.segments import supercover

    return supercover(fx.roads(spark, d), fx.RES).groupBy("row", "col").agg(F.max("way_id").alias("high"), F.min("way_id").alias("low"))


@query("c09_readout", with_views("points", "SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN event_id % 200 END, event_id % 256) AS cls FROM points"))
def c09(spark, d):
    """The detail raster's class where there is one, else the explore layer's."""
    detail = F.when(c("event_id") % 3 == 0, c("event_id") % 200)
    return fx.points(spark, d).select("event_id", F.coalesce(detail, c("event_id") % 256).alias("cls"))


@query("c10_quantum", with_views("points", "SELECT event_id, least(254, CAST(floor(dist_cm / 50.0 + 0.5) AS BIGINT)) AS q FROM points"))
def c10(spark, d):
    return fx.points(spark, d).select("event_id", F.least(F.lit(254).cast("long"), F.floor(c("dist_cm") / 50 + 0.5)).alias("q"))


@query("c11_place_dedup", with_views("places", "SELECT kind, x // 20000 AS gx, y // 20000 AS gy, min(place_id) AS place_id FROM places GROUP BY ALL"))
def c11(spark, d):
    """One place of each name and rounded position: the first."""
    from farfield.operators.segments import first_by

    rows = fx.places(spark, d).withColumn("gx", F.floor(c("x") / 20000)).withColumn("gy", F.floor(c("y") / 20000))
    return first_by(rows, ["kind", "gx", "gy"], ["place_id"]).select("kind", "gx", "gy", "place_id")


@query("x09_pixel_lookup", with_views("points", "SELECT event_id, CASE WHEN lon_e4 >= -900000 AND lon_e4 < 900000 AND lat_e4 > -400000 AND lat_e4 <= 400000 THEN (400000 - lat_e4) // 1000 * 1800 + (lon_e4 + 900000) // 1000 ELSE -1 END AS pixel FROM points"))
def x09(spark, d):
    inside = (c("lon_e4") >= -900000) & (c("lon_e4") < 900000) & (c("lat_e4") > -400000) & (c("lat_e4") <= 400000)
    at = F.floor((400000 - c("lat_e4")) / 1000) * 1800 + F.floor((c("lon_e4") + 900000) / 1000)
    return fx.points(spark, d).select("event_id", F.when(inside, at).otherwise(-1).alias("pixel"))


@query("x32_share_text", with_views("points", "SELECT unit_id, printf('%d/%d (%.1f%%)', count(*) FILTER (WHERE excluded), count(*), floor(1000.0 * count(*) FILTER (WHERE excluded) / count(*) + 0.5) / 10) AS share FROM points GROUP BY unit_id"))
def x32(spark, d):
    n, k = F.count("*"), F.count_if(c("excluded"))
    return fx.points(spark, d).groupBy("unit_id").agg(F.format_string("%d/%d (%.1f%%)", k, n, F.floor(k * 1000.0 / n + 0.5) / 10).alias("share"))


@query("x37_escape", "SELECT conv_id, turn, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS text FROM conversations")
def x37(spark, d):
    return spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", text.html_escape(c("text")).alias("text"))


@query("x38_sample_text", with_views("points", "SELECT event_id, CASE event_id % 256 WHEN 254 THEN 'edge' WHEN 255 THEN '' ELSE 'class' END AS said FROM points"))
def x38(spark, d):
    kind = classes.kind(c("event_id") % 256)
    return fx.points(spark, d).select("event_id", F.when(kind == "nodata", "").otherwise(kind).alias("said"))


@query("s25_block_read", with_views("touched", "SELECT row // 64 AS br, col // 64 AS bc, count(*) AS cells FROM (SELECT DISTINCT row, col FROM touched) WHERE row // 64 = 1 GROUP BY ALL"))
def s25(spark, d):
    from farfield.operators.segments import supercover

    cells = supercover(fx.roads(spark, d), fx.RES).select("row", "col").distinct()
    return cells.select(F.floor(c("row") / 64).alias("br"), F.floor(c("col") / 64).alias("bc")).where("br = 1").groupBy("br", "bc").agg(F.count("*").alias("cells"))


@query("p13_interior_water", with_views("water_cells", "SELECT w.row, w.col FROM water_cells w JOIN water_cells v ON abs(w.row - v.row) <= 1 AND abs(w.col - v.col) <= 1 GROUP BY w.row, w.col HAVING count(*) = 9"))
def p13(spark, d):
    """Water cells that no shore touches: all their neighbours are water."""
    return components.dead_cells(fx.water_cells(spark, d), [], wide=False)


@query("t09_largest_first", with_views("cells water_cells", "SELECT (row // 40) * 5 + col // 40 AS unit_id, count(*) AS cells FROM cells ANTI JOIN water_cells USING (row, col) GROUP BY 1 ORDER BY cells DESC, unit_id"))
def t09(spark, d):
    rows = raster.frame(spark, CELLS, CELLS).join(fx.water_cells(spark, d), ["row", "col"], "left_anti")
    return rows.groupBy((F.floor(c("row") / 40) * 5 + F.floor(c("col") / 40)).alias("unit_id")).agg(F.count("*").alias("cells")).orderBy(c("cells").desc(), "unit_id")
