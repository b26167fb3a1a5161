"""Registered queries over layers, files' contents, published records and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farfield.functions.tags import ROADS_A, ROADS_B, in_scenario
from farfield.functions.text import clean, content_type
from farfield.operators import checks, merging, polygons, ranking, raster, segments
from farfield.plans import fixtures as fx
from farfield.plans import spatial
from farfield.plans.fixtures import CELLS, RES, TAGS_A, TAGS_B, with_views
from farfield.plans.published import _kept
from farfield.sources import files, opl, outline

c = F.col
CASES: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        CASES[name] = (f, sql)
        return f

    return add


def _read(spark, d, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Layers and their sources


def _objects(spark, d) -> DataFrame:
    """Relations with tags, one for each customer: kind, id, tags."""
    k = c("c_custkey")
    kind = F.when(k % 4 == 0, "boundary").when(k % 4 == 1, "multipolygon").when(k % 4 == 2, "route")
    tags = F.map_from_arrays(F.array(*map(F.lit, ("type", "admin_level", "boundary", "ISO3166-1"))), F.array(kind, (k % 6 + 2).cast("string"), F.when(k % 3 == 0, "administrative").otherwise("maritime"), F.concat(F.substring("c_mktsegment", 1, 1), F.chr(65 + c("c_nationkey") % 26))))
    return _read(spark, d, "customer").select(F.lit("r").alias("kind"), k.alias("id"), tags.alias("tags"))


_OBJECTS = """objects AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'boundary' WHEN 1 THEN 'multipolygon' WHEN 2 THEN 'route' END AS type, c_custkey % 6 + 2 AS level,
 CASE WHEN c_custkey % 3 = 0 THEN 'administrative' ELSE 'maritime' END AS boundary, substr(c_mktsegment, 1, 1) || chr(CAST(65 + c_nationkey % 26 AS INTEGER)) AS iso FROM customer)"""


@query("p04_boundaries", f"WITH {_OBJECTS} SELECT id, level FROM objects WHERE boundary = 'administrative' AND level IN (2, 4)")
def p04(spark, d):
    level = c("tags")["admin_level"].cast("long")
    return _objects(spark, d).where((c("tags")["boundary"] == "administrative") & level.isin(2, 4)).select("id", level.alias("level"))


@query("p05_relations", f"WITH {_OBJECTS} SELECT id FROM objects WHERE type IN ('boundary', 'multipolygon') AND level IN (2, 6)")
def p05(spark, d):
    return opl.relations(_objects(spark, d), ["2", "6"]).select("id")


@query("p06_country_codes", f"WITH {_OBJECTS} SELECT iso, row_number() OVER (ORDER BY iso) AS nth FROM (SELECT DISTINCT iso FROM objects WHERE boundary = 'administrative' AND level = 2)")
def p06(spark, d):
    """Codes of the level 2 boundaries, each once, in order (one row per country)."""
    own = _objects(spark, d).where((c("tags")["boundary"] == "administrative") & (c("tags")["admin_level"] == "2"))
    codes = own.select(c("tags")["ISO3166-1"].alias("iso")).distinct()
    return codes.withColumn("nth", F.row_number().over(Window.orderBy("iso")).cast("long"))


@query("u05_levels", f"WITH {_OBJECTS} SELECT boundary, list(level ORDER BY level) AS levels FROM (SELECT DISTINCT boundary, level FROM objects) GROUP BY 1")
def u05(spark, d):
    """The levels that each kind of boundary asks for, each once, in order."""
    level = c("tags")["admin_level"].cast("long")
    return _objects(spark, d).groupBy(c("tags")["boundary"].alias("boundary")).agg(F.array_sort(F.collect_set(level)).alias("levels"))


def _opl_lines(spark, d) -> DataFrame:
    """A line of text for each customer (a relation with an escaped name and two members)."""
    name = F.concat(F.lit("Unit%20%"), c("c_mktsegment"), F.lit("%2c%"), c("c_nationkey").cast("string"))
    line = F.concat(F.lit("r"), c("c_custkey"), F.lit(" v1 dV Ttype=boundary,admin_level="), c("c_nationkey") % 5, F.lit(",name="), name, F.lit(" Mw"), c("c_custkey") * 3, F.lit("@outer,n"), c("c_nationkey"), F.lit("@label"))
    return _read(spark, d, "customer").select(line.alias("value"))


@query("s12_opl_relations", "SELECT c_custkey AS id, 'Unit ' || c_mktsegment || ',' || c_nationkey AS name, c_custkey * 3 AS outer_way, CAST(c_nationkey AS BIGINT) AS label FROM customer WHERE c_nationkey % 5 IN (2, 4)")
def s12(spark, d):
    """Relations of two levels out of OPL text, with their names and members."""
    rows = opl.relations(opl.parse_opl(_opl_lines(spark, d)), ["2", "4"])
    ref = lambda role: F.filter("members", lambda m: m["role"] == role)[0]["ref"]
    return rows.select("id", c("tags")["name"].alias("name"), ref("outer").alias("outer_way"), ref("label").alias("label"))


@query("x25_members_by_role", "SELECT c_custkey AS id, CAST(c_custkey * 3 AS BIGINT) AS ref, 'w' AS kind FROM customer")
def x25(spark, d):
    """The member ways that make up a relation's outer rings."""
    rows = opl.parse_opl(_opl_lines(spark, d)).select("id", F.explode("members").alias("m"))
    return rows.where("m.role = 'outer' AND m.kind = 'w'").select("id", "m.ref", "m.kind")


@query("s13_way_geometries", with_views("roads", "SELECT way_id, x1, y1, x2, y2 FROM roads WHERE way_id IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 50 AND l_returnflag = 'R')"))
def s13(spark, d):
    """Geometries of the ways whose ids are wanted; an id may be wanted often."""
    wanted = _read(spark, d, "lineitem").where("l_quantity >= 50 AND l_returnflag = 'R'").select(c("l_suppkey").alias("way_id"))
    return fx.roads(spark, d).join(wanted, "way_id", "left_semi").select("way_id", "x1", "y1", "x2", "y2")


@query("s14_seed_points", with_views("places", "SELECT DISTINCT p.place_id AS node_id, p.x, p.y FROM (SELECT o_custkey * 2 AS node_id FROM orders WHERE o_orderstatus = 'F') s JOIN places p ON p.place_id = s.node_id"))
def s14(spark, d):
    """Seed nodes by id; those that the extract lacks are absent."""
    seeds = _read(spark, d, "orders").where("o_orderstatus = 'F'").select((c("o_custkey") * 2).alias("place_id")).distinct()
    return fx.places(spark, d).join(seeds, "place_id").select(c("place_id").alias("node_id"), "x", "y")


@query("s06_prefilter_merge", with_views("roads", f"SELECT way_id, highway FROM roads WHERE highway IN ({TAGS_A})"))
def s06(spark, d):
    """Two overlapping extracts: the wanted tags of each, merged, an object once."""
    ways = fx.roads(spark, d).select("way_id", "highway", "x1")
    parts = [ways.where(f"x1 {test}").where(in_scenario(c("highway"), "A")).select("way_id", "highway") for test in ("<= 120000", ">= 80000")]
    return files.union_all(parts).dropDuplicates(["way_id"])


@query("s07_layer_export", with_views("roads", f"SELECT way_id AS osm_id, highway, name, CAST(NULL AS VARCHAR) AS ref FROM roads WHERE highway IN ({TAGS_B}, 'path')"))
def s07(spark, d):
    """A layer with its list of fields; a field that the source lacks is null."""
    rows, wanted = fx.roads(spark, d).withColumnRenamed("way_id", "osm_id"), ("osm_id", "highway", "name", "ref")
    have = [c(n) if n in rows.columns else F.lit(None).cast("string").alias(n) for n in wanted]
    return rows.where(c("highway").isin(*ROADS_B, "path")).select(*have)


@query("s08_lines", "SELECT doc_id, len(string_split(text, chr(10))) AS lines, len(text) AS chars FROM documents WHERE text IS NOT NULL")
def s08(spark, d):
    """Texts cut at line ends, no line in two pieces: lines and characters of each."""
    rows = _read(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.split("text", "\n").alias("l"))
    chars = F.aggregate("l", F.lit(0).cast("long"), lambda s, x: s + F.length(x)) + F.size("l") - 1
    return rows.select("doc_id", F.size("l").cast("long").alias("lines"), chars.alias("chars"))


@query("s09_filtered_conversion", "SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents FROM lineitem WHERE l_linestatus = 'O' AND l_quantity < 10")
def s09(spark, d):
    """A conversion of those rows that pass; the predicate goes down to the scan."""
    return _read(spark, d, "lineitem").where("l_linestatus = 'O' AND l_quantity < 10").select("l_orderkey", "l_linenumber", F.floor(c("l_extendedprice") * 100 + 0.5).cast("long").alias("cents"))


@query("s10_union_view", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier")
def s10(spark, d):
    """Chunks with differing fields as one view: fields that one lacks are null."""
    one = _read(spark, d, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment"))
    return files.union_all([one, _read(spark, d, "supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name"), c("s_nationkey").alias("nation"))])


@query("s17_outlines", with_views("units", """SELECT code, CAST(ring AS BIGINT) AS ring, hole, CAST(seq AS BIGINT) AS seq, CAST(x0 + ring * 1000 + dx * (40000 - ring * 2000) AS DOUBLE) AS x, CAST(y0 + ring * 1000 + dy * (40000 - ring * 2000) AS DOUBLE) AS y
 FROM units, (VALUES (0, false), (1, true)) r(ring, hole), (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) p(seq, dx, dy)"""))
def s17(spark, d):
    """Outlines of all units, each a text of a shell and a hole, taken apart."""
    line = lambda ring, dx, dy: F.concat_ws(" ", F.lit(""), *[(c(v) + ring * 1000 + s * (40000 - ring * 2000)).cast("string") for v, s in (("x0", dx), ("y0", dy))])
    ring = lambda k: [F.lit("!2" if k else "1"), *[line(k, dx, dy) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1))], F.lit("END")]
    texts = fx.units(spark, d).withColumn("lines", F.array(c("code"), *ring(0), *ring(1), F.lit("END")))
    parsed = outline.parse_outlines(texts.select("code", F.posexplode("lines").alias("n", "line")), ["code"])
    return parsed.select("code", (c("ring") - 1).cast("long").alias("ring"), "hole", c("seq").cast("long").alias("seq"), "x", "y")


@query("s21_shaped_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def s21(spark, d):
    """JSON read by its shape; a document of another shape is an error."""
    parsed = F.from_json("props", "k BIGINT", {"mode": "FAILFAST"})
    return _read(spark, d, "events").select("event_id", parsed["k"].alias("k"))


@query("s23_countries", "SELECT n_name AS country, c_custkey AS id, CAST(c_custkey AS DOUBLE) / 4 AS x FROM customer JOIN nation ON c_nationkey = n_nationkey")
def s23(spark, d):
    """Line-wise GeoJSON of each country, with the country beside each feature."""
    rows = _read(spark, d, "customer").join(_read(spark, d, "nation"), c("c_nationkey") == c("n_nationkey"))
    line = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(c("c_custkey").alias("osm_id")).alias("properties"), F.struct(F.array(c("c_custkey") / 4, F.lit(1.5)).alias("coordinates")).alias("geometry")))
    shape = "type STRING, properties STRUCT<osm_id: BIGINT>, geometry STRUCT<coordinates: ARRAY<DOUBLE>>"
    feature = F.from_json(line, shape, {"mode": "FAILFAST"})
    return rows.select(c("n_name").alias("country"), feature.alias("f")).select("country", c("f.properties.osm_id").alias("id"), c("f.geometry.coordinates")[0].alias("x"))


@query("u01_source_union", with_views("cells", "SELECT row, col, bool_or(part < 2) AS in_primary FROM (SELECT row, col, 0 AS part FROM cells WHERE row < 120 AND col < 90 UNION ALL SELECT row, col, 1 FROM cells WHERE row BETWEEN 100 AND 180 AND col BETWEEN 60 AND 150 UNION ALL SELECT row, col, 2 FROM cells WHERE row BETWEEN 150 AND 190 AND col > 120) GROUP BY ALL"))
def u01(spark, d):
    """The primary sources' cells, and those of all sources, whose outside is the data edge."""
    cells = raster.frame(spark, CELLS, CELLS)
    parts = [cells.where(w).withColumn("part", F.lit(k)) for k, w in enumerate(("row < 120 AND col < 90", "row BETWEEN 100 AND 180 AND col BETWEEN 60 AND 150", "row BETWEEN 150 AND 190 AND col > 120"))]
    return files.union_all(parts).groupBy("row", "col").agg(F.bool_or(c("part") < 2).alias("in_primary"))


@query("u02_tag_sets", with_views("roads", f"SELECT DISTINCT highway, highway IN ({TAGS_A}) AS in_a, highway IN ({TAGS_B}) AS in_b, highway IN ({TAGS_A}) AND NOT highway IN ({TAGS_B}) AS only_a FROM roads WHERE highway IS NOT NULL"))
def u02(spark, d):
    """The set of A is that of B and the tracks, as arrays."""
    b = F.array(*map(F.lit, ROADS_B))
    a = F.array_union(b, F.array_except(F.array(*map(F.lit, ROADS_A)), b))
    rows = fx.roads(spark, d).where("highway IS NOT NULL").select("highway").distinct()
    return rows.select("highway", F.array_contains(a, c("highway")).alias("in_a"), F.array_contains(b, c("highway")).alias("in_b"), F.array_contains(F.array_except(a, b), c("highway")).alias("only_a"))


# Units, cells and areas


@query("w04_unit_index", with_views("units", "SELECT code, row_number() OVER (ORDER BY code) AS idx FROM units"))
def w04(spark, d):
    return fx.units(spark, d).select("code", F.row_number().over(Window.orderBy("code")).cast("long").alias("idx"))


@query("a04_unit_areas", with_views("cells water_cells", f"SELECT {spatial.UNIT_OF} AS unit_id, count(*) AS cells, CAST(round_even(count(*) * 0.0625, 1) AS DOUBLE) AS area_km2 FROM cells ANTI JOIN water_cells USING (row, col) GROUP BY 1"))
def a04(spark, d):
    """Cells of 250 m as square kilometres, to one decimal; a half goes to the even side."""
    n = spatial.p12(spark, d).groupBy("unit_id").agg(F.count("*").alias("cells"))
    return n.withColumn("area_km2", F.bround(c("cells").cast("decimal(18,0)") * F.lit("0.0625").cast("decimal(10,4)"), 1).cast("double"))


@query("j10_shared_cells", with_views("cells", """SELECT unit_id, row, col FROM (SELECT (row // 40) * 5 + col // 40 AS unit_id, row, col FROM cells UNION SELECT ((row - 1) // 40) * 5 + col // 40, row, col FROM cells WHERE row > 0)"""))
def j10(spark, d):
    """Cells that two units touch belong to both: the first and the second index of a cell, each pair once."""
    cells = raster.frame(spark, CELLS, CELLS)
    unit = lambda row: (F.floor(row / 40) * 5 + F.floor(c("col") / 40)).cast("long").alias("unit_id")
    second = cells.where("row > 0").select(unit(c("row") - 1), "row", "col")
    return cells.select(unit(c("row")), "row", "col").unionByName(second).distinct()


@query("a10_fragment_merge", """WITH RECURSIVE piece AS (SELECT p_partkey AS id, p_size * 100 AS side, (p_partkey * 6151) % 200000 AS x, (p_partkey * 3079) % 200000 AS y FROM part),
 met AS (SELECT a.id, b.id AS other, b.side FROM piece a JOIN piece b ON a.side < 1500 AND (b.side > a.side OR (b.side = a.side AND b.id < a.id)) AND a.x <= b.x + b.side AND b.x <= a.x + a.side AND a.y <= b.y + b.side AND b.y <= a.y + a.side),
 into_ AS (SELECT id, arg_max(other, (side, -other)) AS target FROM met GROUP BY id),
 walk AS (SELECT id, id AS body FROM piece UNION ALL SELECT w.id, i.target FROM walk w JOIN into_ i ON i.id = w.body)
 SELECT id, body FROM walk WHERE body NOT IN (SELECT id FROM into_)""")
def a10(spark, d):
    """Small pieces of land join the largest that they touch, and go where that goes."""
    rows = _read(spark, d, "part").selectExpr("p_partkey AS id", "p_size * 100 AS side", f"(p_partkey * 6151) % {fx.SIDE} AS x", f"(p_partkey * 3079) % {fx.SIDE} AS y")
    return merging.merged_fragments(rows, 1500, 8000)


@query("g04_half_diagonals", "SELECT p_partkey, CAST(floor(p_size * 100 * sqrt(2) / 2 * 1000) AS BIGINT) AS half_mm FROM part")
def g04(spark, d):
    return _read(spark, d, "part").select("p_partkey", F.floor(c("p_size") * 100 * F.sqrt(F.lit(2.0)) / 2 * 1000).alias("half_mm"))


@query("x04_buffer", with_views("points units", """SELECT event_id FROM points p, (SELECT * FROM units WHERE code = 'nation_12') u WHERE greatest(u.x0 - p.x, p.x - u.x0 - 40000, 0) * greatest(u.x0 - p.x, p.x - u.x0 - 40000, 0)
 + greatest(u.y0 - p.y, p.y - u.y0 - 40000, 0) * greatest(u.y0 - p.y, p.y - u.y0 - 40000, 0) <= 20000 * 20000"""))
def x04(spark, d):
    """Points within 20 km of one unit, which has to be one row."""
    unit = fx.units(spark, d).where("code = 'nation_12'").select("x0", "y0")
    one = unit.agg(F.count("*").alias("n"), F.max("x0").alias("x0"), F.max("y0").alias("y0")).withColumn("n", F.when(c("n") == 1, 1).otherwise(F.raise_error(F.lit("not exactly one unit"))))
    away = lambda v: F.greatest(c(f"{v}0") - c(v), c(v) - c(f"{v}0") - 40000, F.lit(0))
    return fx.points(spark, d).join(F.broadcast(one)).where((c("n") == 1) & (away("x") * away("x") + away("y") * away("y") <= 20000 * 20000)).select("event_id")


@query("x06_ring_export", with_views("water", "SELECT water_id, CAST(floor(x / 100.0 + 0.5) AS BIGINT) AS x, CAST(floor(y / 100.0 + 0.5) AS BIGINT) AS y FROM water WHERE side * side >= 23040000"))
def x06(spark, d):
    """Holes of some area, in whole hundreds of metres."""
    area = polygons.polygon_areas(polygons.ring_edges(fx.water_corners(spark, d), ["water_id"]), ["water_id"]).where("area2 >= 2 * 23040000")
    whole = lambda v: F.floor(c(v) / 100.0 + 0.5).alias(v)
    return fx.water(spark, d).join(area, "water_id", "left_semi").select("water_id", whole("x"), whole("y"))


@query("x07_land_simplification", "SELECT p_partkey AS id, p_size % 2 = 1 AS hole, CAST(p_size AS BIGINT) * p_size * 10000 AS area_m2 FROM part WHERE CAST(p_size AS BIGINT) * p_size * 10000 >= CASE WHEN p_size % 2 = 1 THEN 3000000 ELSE 2000000 END")
def x07(spark, d):
    """Parts of 2 km2 and holes of 3 km2 stay."""
    rows = _read(spark, d, "part").select(c("p_partkey").alias("id"), (c("p_size") % 2 == 1).alias("hole"), (c("p_size").cast("long") * c("p_size") * 10000).alias("area_m2"))
    return rows.where(c("area_m2") >= F.when(c("hole"), 3_000_000).otherwise(2_000_000))


@query("x11_rounded_coordinates", with_views("water", "SELECT water_id, list_transform([[x, y], [x + side, y], [x + side, y + side], [x, y + side]], lambda p: list_transform(p, lambda v: CAST(floor(v / 1000.0 + 0.5) AS BIGINT))) AS ring FROM water"))
def x11(spark, d):
    """Coordinates of nested rings, rounded where they stand."""
    rows = fx.water_corners(spark, d).groupBy("water_id").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("l"))
    return rows.select("water_id", F.transform("l", lambda p: F.transform(F.array(p["x"], p["y"]), lambda v: F.floor(v / 1000.0 + 0.5))).alias("ring"))


@query("x20_pyramid_bounds", with_views("points", "SELECT unit_id, min(lon_e4) AS west, greatest(min(lat_e4), -850511) AS south, max(lon_e4) AS east, least(max(lat_e4), 850511) AS north FROM (SELECT unit_id, lon_e4, lat_e4 * 9 // 8 AS lat_e4 FROM (SELECT unit_id, lon_e4, lat_e4 + 800000 AS l, lat_e4 FROM points)) GROUP BY 1").replace("lat_e4 * 9 // 8 AS lat_e4", "l * 9 // 8 - 900000 AS lat_e4"))
def x20(spark, d):
    """Bounds of each unit's points, latitudes held within the square of the projection."""
    lat = F.floor((c("lat_e4") + 800000) * 9 / 8) - 900000
    rows = fx.points(spark, d).withColumn("lat", lat).groupBy("unit_id").agg(F.min("lon_e4").alias("west"), F.min("lat").alias("s"), F.max("lon_e4").alias("east"), F.max("lat").alias("n"))
    return rows.select("unit_id", "west", F.greatest("s", F.lit(-850511)).cast("long").alias("south"), "east", F.least("n", F.lit(850511)).cast("long").alias("north"))


@query("x24_ring_test", "SELECT l_orderkey AS ring, count(*) >= 4 AND min_by(l_suppkey % 3, (l_linenumber, l_partkey, l_suppkey)) = max_by(l_suppkey % 3, (l_linenumber, l_partkey, l_suppkey)) AS closed FROM lineitem GROUP BY 1")
def x24(spark, d):
    """Rings that have four points at least and end where they began."""
    node, place = c("l_suppkey") % 3, F.struct("l_linenumber", "l_partkey", "l_suppkey")
    rows = _read(spark, d, "lineitem").groupBy(c("l_orderkey").alias("ring"))
    return rows.agg(((F.count("*") >= 4) & (F.min_by(node, place) == F.max_by(node, place))).alias("closed"))


@query("x26_polygon_parts", with_views("places", "SELECT place_id, CAST(k AS BIGINT) AS part FROM places, (SELECT unnest(generate_series(0, 3)) AS k) WHERE (place_id + k) % 3 = 0"))
def x26(spark, d):
    """Of nested collections only the polygons stay, one row each."""
    kinds = F.array(*[F.struct(F.lit(k).cast("long").alias("part"), F.element_at(F.array(F.lit("polygon"), F.lit("line"), F.lit("point")), ((c("place_id") + k) % 3 + 1).cast("int")).alias("kind")) for k in range(4)])
    nested = fx.places(spark, d).select("place_id", F.array(F.slice(kinds, 1, 2), F.slice(kinds, 3, 2)).alias("parts"))
    return nested.select("place_id", F.explode(F.flatten("parts")).alias("p")).where("p.kind = 'polygon'").select("place_id", "p.part")


@query("w12_first_by_key", "SELECT l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n FROM lineitem) WHERE n = 1")
def w12(spark, d):
    return segments.first_by(_read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], ["l_linenumber", "l_partkey"]).select("l_orderkey", "l_partkey")


# Published records


@query("w05_display_numbers", with_views("ranked", "SELECT scenario, unit_id, event_id, rank, display FROM (SELECT *, row_number() OVER (PARTITION BY scenario, unit_id ORDER BY rank) AS display FROM kept WHERE island IS NULL) WHERE display <= 10"))
def w05(spark, d):
    return ranking.visible(_kept(spark, d), islands=False, top=10).select("scenario", "unit_id", "event_id", "rank", "display")


@query("t10_top_three", with_views("ranked", "SELECT scenario, unit_id, event_id, rank FROM kept WHERE rank <= 3"))
def t10(spark, d):
    return _kept(spark, d).where("rank <= 3").select("scenario", "unit_id", "event_id", "rank")


@query("u06_stale_documents", with_views("ranked units", "SELECT scenario || '/' || code AS name FROM units, (VALUES ('A'), ('B')) s(scenario) EXCEPT SELECT k.scenario || '/' || u.code FROM kept k JOIN units u USING (unit_id) WHERE k.rank = 1 AND k.dist_cm > 12000"))
def u06(spark, d):
    """Documents that are there and weren't written again."""
    name = F.concat_ws("/", "scenario", "code").alias("name")
    there = fx.units(spark, d).withColumn("scenario", F.explode(F.array(F.lit("A"), F.lit("B")))).select(name)
    written = _kept(spark, d).where("rank = 1 AND dist_cm > 12000").join(fx.units(spark, d).select("unit_id", "code"), "unit_id").select(name)
    return there.exceptAll(written.distinct())


@query("f13_record_rounding", "SELECT event_id, CAST(round_even(CAST(value AS DECIMAL(18, 4)) * 1.125, 2) AS DOUBLE) AS dist_m, CAST(round_even(CAST(event_id AS DECIMAL(18, 0)) / 16 * 0.000001, 6) AS DOUBLE) AS lat FROM events".replace("/ 16 * 0.000001", "* 0.0000000625"))
def f13(spark, d):
    """Records' figures to 2 and 6 decimals, a half to the even side."""
    dist = c("value").cast("decimal(18,4)") * F.lit("1.125").cast("decimal(4,3)")
    lat = c("event_id").cast("decimal(18,0)") * F.lit("0.0000000625").cast("decimal(11,10)")
    return _read(spark, d, "events").select("event_id", F.bround(dist, 2).cast("double").alias("dist_m"), F.bround(lat, 6).cast("double").alias("lat"))


@query("k05_report", with_views("ranked", """SELECT scenario AS check, count(*) FILTER (WHERE dist_cm > 5000) AS passed, count(*) FILTER (WHERE dist_cm <= 5000) AS failed, list(DISTINCT unit_id ORDER BY unit_id) FILTER (WHERE dist_cm <= 5000) AS failing FROM kept GROUP BY 1"""))
def k05(spark, d):
    """Passes and failures of each check, and the units that fail."""
    ok = c("dist_cm") > 5000
    failing = F.array_sort(F.collect_set(F.when(~ok, c("unit_id"))))
    return _kept(spark, d).groupBy(c("scenario").alias("check")).agg(F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"), F.when(F.size(failing) > 0, failing).alias("failing"))


@query("k07_tile_rows", with_views("points", "SELECT 9 AS zoom, x * 512 // 200000 AS tile_column, 511 - y * 512 // 200000 AS tile_row, count(*) AS n FROM points GROUP BY ALL"))
def k07(spark, d):
    """Rows of a tile archive, which count from the bottom."""
    zoom = 9
    flipped = F.lit((1 << zoom) - 1) - F.floor(c("y") * (1 << zoom) / fx.SIDE)
    return fx.points(spark, d).groupBy(F.lit(zoom).alias("zoom"), F.floor(c("x") * (1 << zoom) / fx.SIDE).alias("tile_column"), flipped.alias("tile_row")).agg(F.count("*").alias("n"))


@query("k10_site_documents", with_views("ranked units", """, written AS (SELECT DISTINCT u.code, u.country_id FROM kept k JOIN units u USING (unit_id) WHERE k.rank = 1 AND k.dist_cm > 12000)
 SELECT 'units/' || code || '.json' AS key, 1 AS step, 'write' AS action FROM written UNION ALL SELECT DISTINCT 'countries/' || country_id || '.json', 2, 'write' FROM written UNION ALL SELECT 'manifest.json', 3, 'write'
 UNION ALL SELECT 'units/' || code || '.json', 4, 'prune' FROM units WHERE code NOT IN (SELECT code FROM written)""").replace("\n, written", ",\n written"))
def k10(spark, d):
    """Documents in the order in which they are written, inwards out, and those that go afterwards."""
    units = fx.units(spark, d).select("unit_id", "code", "country_id")
    written = _kept(spark, d).where("rank = 1 AND dist_cm > 12000").join(units, "unit_id").select("code", "country_id").distinct()
    key = lambda folder, v: F.concat(F.lit(f"{folder}/"), c(v).cast("string"), F.lit(".json")).alias("key")
    as_ = lambda df, step, action="write": df.withColumns({"step": F.lit(step), "action": F.lit(action)})
    gone = units.join(written, "code", "left_anti").select(key("units", "code"))
    top = spark.range(1).select(F.lit("manifest.json").alias("key"))
    return files.union_all([as_(written.select(key("units", "code")), 1), as_(written.select(key("countries", "country_id")).distinct(), 2), as_(top, 3), as_(gone, 4, "prune")])


@query("k13_upload_keys", with_views("ranked units", """SELECT 'r/s/' || scenario || '.pmtiles' AS key, 'application/octet-stream' AS type FROM (VALUES ('A'), ('B')) t(scenario)
 UNION ALL SELECT 'r/s/detail/' || code || '/' || event_id || e, CASE e WHEN '.png' THEN 'image/png' ELSE 'application/json' END FROM kept JOIN units USING (unit_id), (VALUES ('.png'), ('.json')) x(e)
 UNION ALL SELECT 'r/s/validation/report.json', 'application/json'"""))
def k13(spark, d):
    """Every object that the site fetches, with its type."""
    tops = spark.range(2).select(F.concat(F.lit("r/s/"), F.element_at(F.array(F.lit("A"), F.lit("B")), (c("id") + 1).cast("int")), F.lit(".pmtiles")).alias("key"))
    kept = _kept(spark, d).join(fx.units(spark, d).select("unit_id", "code"), "unit_id")
    each = kept.withColumn("e", F.explode(F.array(F.lit(".png"), F.lit(".json"))))
    detail = each.select(F.concat(F.lit("r/s/detail/"), c("code"), F.lit("/"), c("event_id").cast("string"), c("e")).alias("key"))
    keys = files.union_all([tops, detail, spark.range(1).select(F.lit("r/s/validation/report.json").alias("key"))])
    return keys.select("key", content_type(c("key")).alias("type"))


@query("x22_metadata_resume", with_views("units", "SELECT u.code, m.unit_id IS NULL AS missing, m.area FROM units u LEFT JOIN (SELECT unit_id, x0 + y0 AS area FROM units WHERE country_id <> 2) m USING (unit_id)"))
def x22(spark, d):
    """Units with their cached figures; one without an entry is told."""
    units = fx.units(spark, d)
    cached = units.where("country_id <> 2").select("unit_id", (c("x0") + c("y0")).alias("area"))
    return units.select("code", "unit_id").join(cached.withColumn("_m", F.lit(True)), "unit_id", "left").select("code", c("_m").isNull().alias("missing"), "area")


@query("x23_tile_guards", with_views("touched", "SELECT count(*) AS indexed, count(DISTINCT way_id) AS ways, count(*) <= 40000000 AND count(DISTINCT way_id) = (SELECT count(*) FROM roads) AS passed FROM touched"))
def x23(spark, d):
    """The index isn't over its limit, and holds every way."""
    ways = fx.roads(spark, d)
    cells = segments.supercover(ways, RES).agg(F.count("*").alias("indexed"), F.countDistinct("way_id").alias("ways"))
    return cells.join(F.broadcast(ways.agg(F.count("*").alias("have")))).select("indexed", "ways", ((c("indexed") <= 40_000_000) & (c("ways") == c("have"))).alias("passed"))


@query("x29_reference_placeholder", with_views("points units", "SELECT u.code, coalesce(min(p.dist_cm), -1) AS ref, count(p.event_id) = 0 AS placeholder FROM units u LEFT JOIN points p ON p.unit_id = u.unit_id AND p.event_type = 'purchase' AND u.country_id <> 1 GROUP BY 1"))
def x29(spark, d):
    """Units without references get a row that says so."""
    refs = fx.points(spark, d).where("event_type = 'purchase'").join(fx.units(spark, d).where("country_id <> 1").select("unit_id"), "unit_id", "left_semi").groupBy("unit_id").agg(F.min("dist_cm").alias("ref"))
    rows = fx.units(spark, d).select("unit_id", "code").join(refs, "unit_id", "left")
    return rows.select("code", F.coalesce("ref", F.lit(-1).cast("long")).alias("ref"), c("ref").isNull().alias("placeholder"))


@query("x30_verdicts", with_views("ranked", """SELECT scenario, unit_id, event_id, CASE WHEN passed THEN 'pass' WHEN tie THEN 'tie: equal maximum elsewhere' WHEN blocking THEN 'FAIL' ELSE 'warning' END AS verdict, row_number() OVER (PARTITION BY unit_id ORDER BY scenario, rank, event_id) AS line
 FROM (SELECT *, dist_cm > 2000 AS passed, event_id % 7 = 0 AS tie, scenario = 'A' AS blocking FROM ranked WHERE excluded)"""))
def x30(spark, d):
    """What the report says of each withheld point, numbered as its unit's table has them."""
    rows = ranking.ranked(fx.points(spark, d)).where("excluded")
    verdict = F.when(c("dist_cm") > 2000, "pass").when(c("event_id") % 7 == 0, "tie: equal maximum elsewhere").when(c("scenario") == "A", "FAIL").otherwise("warning")
    order = Window.partitionBy("unit_id").orderBy("scenario", "rank", "event_id")
    return rows.select("scenario", "unit_id", "event_id", verdict.alias("verdict"), F.row_number().over(order).cast("long").alias("line"))


@query("x33_base_url", "SELECT page_id, regexp_replace(url, '^https?://[^/]+', 'http://localhost:8000') AS url FROM pages")
def x33(spark, d):
    return _read(spark, d, "pages").select("page_id", F.regexp_replace("url", "^https?://[^/]+", "http://localhost:8000").alias("url"))


@query("x34_region_links", with_views("units", "SELECT country_id, code FROM (SELECT *, count(*) OVER (PARTITION BY country_id) AS n FROM units WHERE unit_id <> 4 AND (country_id <> 3 OR unit_id = 3)) WHERE n >= 2"))
def x34(spark, d):
    """Links between the regions of a country; none where there is but one."""
    rows = fx.units(spark, d).where("unit_id <> 4 AND (country_id <> 3 OR unit_id = 3)")
    many = rows.groupBy("country_id").agg(F.count("*").alias("n")).where("n >= 2")
    return rows.join(many, "country_id", "left_semi").select("country_id", "code")


@query("x35_object_urls", with_views("points", "SELECT event_id, CASE WHEN island IS NOT NULL THEN rtrim('https://cdn.example.org' || repeat('/', CAST(event_id % 3 AS INTEGER)), '/') || '/r/s/' || event_id || '.png' END AS url FROM points"))
def x35(spark, d):
    """Addresses of detail files; null without a detail."""
    base = F.regexp_replace(F.concat(F.lit("https://cdn.example.org"), F.expr("repeat('/', CAST(event_id % 3 AS INT))")), "/+$", "")
    return fx.points(spark, d).select("event_id", F.when(c("island").isNotNull(), F.concat(base, F.lit("/r/s/"), c("event_id").cast("string"), F.lit(".png"))).alias("url"))


@query("x40_card_facts", with_views("roads", "SELECT way_id, coalesce(CASE WHEN way_id % 3 = 0 THEN name END, CASE WHEN way_id % 3 = 1 THEN 'R' || way_id END, 'unnamed') AS road, coalesce(highway, 'road') AS kind, CASE WHEN way_id % 5 = 0 THEN 'withheld' ELSE 'none' END AS reason FROM roads"))
def x40(spark, d):
    """What the card says: the road by name, then by number; why there is nothing."""
    name, ref = F.when(c("way_id") % 3 == 0, c("name")), F.when(c("way_id") % 3 == 1, F.concat(F.lit("R"), c("way_id").cast("string")))
    return fx.roads(spark, d).select("way_id", F.coalesce(name, ref, F.lit("unnamed")).alias("road"), F.coalesce("highway", F.lit("road")).alias("kind"), F.when(c("way_id") % 5 == 0, "withheld").otherwise("none").alias("reason"))


@query("x42_class_bytes", "SELECT doc_id, ord(substr(hex(encode(text)), 1, 1)) * 256 + ord(substr(hex(encode(text)), 2, 1)) AS first, length(hex(encode(text))) // 8 AS pixels FROM documents WHERE text <> ''")
def x42(spark, d):
    """Classes out of the first of four channels: the first byte of each pixel."""
    h = F.hex(F.encode("text", "UTF-8"))
    return _read(spark, d, "documents").where("text <> ''").select("doc_id", (F.ascii(F.substring(h, 1, 1)) * 256 + F.ascii(F.substring(h, 2, 1))).alias("first"), F.floor(F.length(h) / 8).alias("pixels"))


_META = "trim(CASE o_orderkey % 4 WHEN 0 THEN 'LT-' || substr(o_orderpriority, 1, 1) WHEN 1 THEN ' de ' WHEN 2 THEN 'x' || o_orderstatus || '-ABCD' ELSE 'Fr-' || o_orderstatus END)"


@query("x43_visitor_meta", f"SELECT o_orderkey, CASE WHEN regexp_full_match(m, '[A-Za-z]{{2}}(-[A-Za-z0-9]{{1,3}})?') THEN lower(substr(m, 1, 2)) END AS country, CASE WHEN regexp_full_match(m, '[A-Za-z]{{2}}-[A-Za-z0-9]{{1,3}}') THEN lower(substr(m, 4)) END AS region FROM (SELECT o_orderkey, {_META} AS m FROM orders)")
def x43(spark, d):
    """Country and region of a visitor out of a page's meta element."""
    rows = _read(spark, d, "orders").select("o_orderkey", F.expr(_META).alias("m"))
    part = lambda k: F.nullif(F.lower(F.regexp_extract("m", "^([A-Za-z]{2})(?:-([A-Za-z0-9]{1,3}))?$", k)), F.lit(""))
    return rows.select("o_orderkey", part(1).alias("country"), part(2).alias("region"))


@query("x15_stamps", with_views("units", "SELECT code, CASE WHEN unit_id % 5 = 0 THEN 'forced' WHEN country_id = 2 THEN 'adopted' WHEN unit_id % 4 = 1 THEN 'reset' ELSE 'kept' END AS action FROM units"))
def x15(spark, d):
    """Whether artefacts stay: forced or changed ones are reset; without a stamp they are taken as they are."""
    now = fx.units(spark, d).select("code", "unit_id", (c("x0") + F.when(c("unit_id") % 4 == 1, 1).otherwise(0)).alias("stamp"))
    old = fx.units(spark, d).where("country_id <> 2").select("code", c("x0").alias("old"))
    action = F.when(c("unit_id") % 5 == 0, "forced").when(c("old").isNull(), "adopted").when(c("old") != c("stamp"), "reset").otherwise("kept")
    return now.join(old, "code", "left").select("code", action.alias("action"))


@query("x17_commit_ids", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE nullif(trim(CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE ' ' || md5(c_name) || ' ' END), '') END AS commit_id FROM customer")
def x17(spark, d):
    """The commit of a tree, null where that is dirty or unknown."""
    head = F.when(c("c_custkey") % 5 == 0, " ").otherwise(F.concat(F.lit(" "), F.md5("c_name"), F.lit(" ")))
    return _read(spark, d, "customer").select("c_custkey", F.when(c("c_custkey") % 3 == 0, None).otherwise(clean(F.nullif(F.trim(head), F.lit("")))).alias("commit_id"))


# Checks by their rules


_STRUCT = """SELECT scenario, unit_id, bool_and(rank = nth) AND bool_and(dist_cm >= 0) AND bool_and(lon_e4 BETWEEN -1800000 AND 1800000 AND lat_e4 BETWEEN -700000 AND 700000) AND count(*) FILTER (WHERE island IS NULL) >= 140
 AND count(*) FILTER (WHERE island IS NOT NULL) <= 45 AS passed FROM (SELECT *, row_number() OVER (PARTITION BY scenario, unit_id ORDER BY rank) AS nth FROM listed) GROUP BY ALL"""


@query("v09_structure", with_views("ranked", f", listed AS (SELECT * REPLACE (CASE WHEN unit_id % 6 = 5 THEN rank + rank // 50 ELSE rank END AS rank) FROM kept) {_STRUCT}").replace("\n, listed", ",\n listed"))
def v09(spark, d):
    """Lists whose ranks have gaps, whose counts are off or whose coordinates are out of range don't pass."""
    rank = F.when(c("unit_id") % 6 == 5, c("rank") + F.floor(c("rank") / 50)).otherwise(c("rank"))
    return checks.list_structure(_kept(spark, d).withColumn("rank", rank), ["scenario", "unit_id"], least=140, islands=45, south=-700000, north=700000)


@query("v06_references", with_views("ranked", """SELECT r.event_id, r.unit_id, r.event_id % 2 = 1 AS external, k.event_id IS NOT NULL AND CASE WHEN r.event_id % 2 = 1 THEN abs(k.dist_cm - r.dist_cm) * 5 <= r.dist_cm AND (k.x - r.x) * (k.x - r.x) + (k.y - r.y) * (k.y - r.y) <= 5000 * 5000
  ELSE abs(k.dist_cm - r.dist_cm) * 100 <= r.dist_cm AND (k.x - r.x) * (k.x - r.x) + (k.y - r.y) * (k.y - r.y) <= 500 * 500 END AS passed
 FROM (SELECT event_id, unit_id, scenario, dist_cm, least(x + event_id % 900, 199999) AS x, y FROM ranked WHERE rank <= 4 AND dist_cm > 0) r LEFT JOIN (SELECT * FROM kept WHERE rank = 1) k USING (scenario, unit_id)"""))
def v06(spark, d):
    """References against the leading points: own ones within 500 m and 1 %, others within 5 km and 20 %."""
    refs = ranking.ranked(fx.points(spark, d)).where("rank <= 4 AND dist_cm > 0").select("scenario", "unit_id", "event_id", c("dist_cm").alias("ref"), F.least(c("x") + c("event_id") % 900, F.lit(199999)).alias("rx"), c("y").alias("ry"))
    tops = ranking.best(_kept(spark, d)).select("scenario", "unit_id", "top.dist_cm", "top.x", "top.y")
    both = refs.join(tops, ["scenario", "unit_id"], "left").withColumn("external", c("event_id") % 2 == 1)
    moved2 = (c("x") - c("rx")) * (c("x") - c("rx")) + (c("y") - c("ry")) * (c("y") - c("ry"))
    off = F.abs(c("dist_cm") - c("ref"))
    own = (off * 100 <= c("ref")) & (moved2 <= checks.REF_MOVE**2)
    other = (off * 5 <= c("ref")) & (moved2 <= checks.EXTERNAL_MOVE**2)
    return both.select("event_id", "unit_id", "external", (c("x").isNotNull() & F.coalesce(F.when(c("external"), other).otherwise(own), F.lit(False))).alias("passed"))


@query("c04_attributed_places", spatial._sql("roads water cells water_cells places", f"{spatial.LATTICE_VIEWS},\nopen_points AS MATERIALIZED ({spatial._refined_sql(TAGS_A, 'A')}),\n{spatial.greedy_sql('scenario, unit_id', 3, 6000)}",
  "SELECT unit_id, rank, place_id, d2 FROM (SELECT *, row_number() OVER (PARTITION BY unit_id, rank ORDER BY d2, place_id) AS n FROM (SELECT t.unit_id, t.rank, p.place_id, (p.x - t.x) * (p.x - t.x) + (p.y - t.y) * (p.y - t.y) AS d2 FROM taken3 t, places p)) WHERE n = 1"))
def c04(spark, d):
    """After the search, once: the nearest place of each found point."""
    found = spatial.search_scenario(spark, d, "A", 3, 6000.0)
    near = spatial._nearest_places(spark, d, found.withColumn("event_id", c("unit_id") * 100 + c("rank")))
    return near.select(F.floor(c("event_id") / 100).alias("unit_id"), (c("event_id") % 100).alias("rank"), "place_id", "d2")


@query("x12_land_pixels", with_views("points water", "SELECT event_id, NOT EXISTS (SELECT 1 FROM water w WHERE side >= 4800 AND p.x >= w.x AND p.x < w.x + side AND p.y >= w.y AND p.y < w.y + side) AND x BETWEEN 2000 AND 197999 AND y BETWEEN 2000 AND 197999 AS on_land FROM points p"))
def x12(spark, d):
    """Pixels on land: within the land's outline, and in no big water, whatever their unit."""
    points = fx.points(spark, d).select("event_id", c("x").alias("px"), c("y").alias("py"))
    dry = spatial.allowed_points(spark, d, points, ["event_id"]).select("event_id").withColumn("_d", F.lit(True))
    inside = c("px").between(2000, 197999) & c("py").between(2000, 197999)
    return points.join(dry, "event_id", "left").select("event_id", (c("_d").isNotNull() & inside).alias("on_land"))


@query("x13_blank_window", with_views("points", "SELECT event_id, CASE WHEN off = 0 THEN 'fine' WHEN off > 100 THEN 'error' ELSE 'islet' END AS verdict FROM (SELECT event_id, greatest(2000 - x, x - 197999, 2000 - y, y - 197999, 0) AS off FROM points)"))
def x13(spark, d):
    """A window without land: an error where the nearest is over 100 m away, else an islet under a pixel."""
    off = F.greatest(2000 - c("x"), c("x") - 197999, 2000 - c("y"), c("y") - 197999, F.lit(0))
    return fx.points(spark, d).select("event_id", F.when(off == 0, "fine").when(off > 100, "error").otherwise("islet").alias("verdict"))


@query("x03_road_records", with_views("roads places", f"""SELECT place_id, way_id, highway, name FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY dist, way_id) AS n FROM
 (SELECT place_id, way_id, highway, CASE WHEN way_id % 3 = 0 THEN NULL ELSE name END AS name, {spatial.DIST} AS dist FROM (SELECT *, {spatial.SHARE} AS t FROM (SELECT place_id, x AS px, y AS py FROM places), (SELECT * FROM roads WHERE highway IN ({TAGS_A}))))) WHERE n = 1"""))
def x03(spark, d):
    """The nearest road's record; texts that say nothing are null."""
    points = fx.places(spark, d).select("place_id", c("x").alias("px"), c("y").alias("py"))
    ways = fx.roads(spark, d).where(in_scenario(c("highway"), "A"))
    near = segments.nearest_segment(spatial._bounded(spark, d, points, "A"), ways, 5000, ["place_id"])
    named = ways.select("way_id", "highway", clean(F.when(c("way_id") % 3 == 0, "nan").otherwise(c("name"))).alias("name"))
    return near.join(named, "way_id").select("place_id", "way_id", "highway", "name")


@query("x05_local_roads", with_views("roads", """SELECT way_id, least(x1, x2) AS w FROM roads WHERE greatest(x1, x2) >= 40000 AND least(x1, x2) < 160000 AND greatest(y1, y2) >= 40000 AND least(y1, y2) < 160000
 AND ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) >= 3000 * 3000 OR way_id = (SELECT arg_min(way_id, (abs(x1 - 100000) + abs(y1 - 100000), way_id)) FROM roads))"""))
def x05(spark, d):
    """Roads of a window: short pieces go unless it is the nearest."""
    ways = fx.roads(spark, d)
    nearest = ways.agg(F.min(F.struct((F.abs(c("x1") - 100000) + F.abs(c("y1") - 100000)).alias("d"), "way_id")).alias("b")).select(c("b.way_id").alias("best"))
    inside = ways.where("greatest(x1, x2) >= 40000 AND least(x1, x2) < 160000 AND greatest(y1, y2) >= 40000 AND least(y1, y2) < 160000").join(F.broadcast(nearest))
    return inside.where("(x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) >= 3000 * 3000 OR way_id = best").select("way_id", F.least("x1", "x2").alias("w"))
