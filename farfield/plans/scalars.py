"""Registered queries over scalar functions: predicates, classes, formats, projections, parsers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farfield.functions import classes, crs, geodesy, lon, tags, text
from farfield.operators.segments import densified
from farfield.plans import fixtures as fx
from farfield.plans.fixtures import TAGS_A, TAGS_B, with_views

c = F.col
CASES: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        CASES[name] = (f, sql)
        return f

    return add


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _literals(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    values = ", ".join("(" + ", ".join("NULL" if v is None else "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def _values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows) + ")"


@query("p01_classify_highway", with_views("roads", f"SELECT way_id, highway, coalesce(highway IN ({TAGS_A}), false) AS in_a, coalesce(highway IN ({TAGS_B}), false) AS in_b FROM roads"))
def p01(spark, d):
    return fx.roads(spark, d).select("way_id", "highway", *tags.classify(c("highway")))


@query("p02_scenario_filter", with_views("roads", f"SELECT way_id, highway, name FROM roads WHERE highway IN ({TAGS_B})"))
def p02(spark, d):
    return fx.roads(spark, d).where(c("highway").isin(*tags.ROADS_B)).select("way_id", "highway", "name")


@query("p03_scenario_layers", with_views("roads", f"SELECT 'A' AS scenario, way_id, highway, name FROM roads WHERE highway IN ({TAGS_A}) UNION ALL SELECT 'B', way_id, highway, name FROM roads WHERE highway IN ({TAGS_B})"))
def p03(spark, d):
    ways = fx.roads(spark, d)
    one = lambda s: ways.where(tags.in_scenario(c("highway"), s)).select(F.lit(s).alias("scenario"), "way_id", "highway", "name")
    return one("A").unionByName(one("B"))


@query("p07_big_water", with_views("water", "SELECT water_id, side * side AS area_m2 FROM water WHERE side * side >= 4800 * 4800"))
def p07(spark, d):
    return fx.water(spark, d).select("water_id", (c("side") * c("side")).alias("area_m2")).where(c("area_m2") >= 4800 * 4800)


@query("p08_territory_mask", with_views("places", "SELECT place_id, x, y FROM places WHERE NOT (x BETWEEN 20000 AND 60000 AND y BETWEEN 30000 AND 90000) AND NOT (x BETWEEN 150000 AND 160000 AND y BETWEEN 0 AND 199999)"))
def p08(spark, d):
    masks = ((20000, 30000, 60000, 90000), (150000, 0, 160000, 199999))
    rows = fx.places(spark, d).select("place_id", "x", "y")
    for w, s, e, n in masks:
        rows = rows.where(~(c("x").between(w, e) & c("y").between(s, n)))
    return rows


@query("p10_unit_country", with_views("units", "SELECT code, country_id <> 3 AND country_id IN (0, 1, 2, 3) AS is_unit_country FROM units"))
def p10(spark, d):
    return fx.units(spark, d).select("code", ((c("country_id") != 3) & c("country_id").isin(0, 1, 2, 3)).alias("is_unit_country"))


@query("p17_describe_class", with_views("points", """SELECT event_id, event_id % 256 AS cls, CASE WHEN event_id % 256 = 255 THEN 'nodata' WHEN event_id % 256 = 254 THEN 'edge' ELSE 'class' END AS kind FROM points"""))
def p17(spark, d):
    return fx.points(spark, d).select("event_id", (c("event_id") % 256).alias("cls")).withColumn("kind", classes.kind(c("cls")))


PATHS = [("/",), ("/europe",), ("/Europe/LT/",), ("/europe/lt/x",), ("/index.html",), ("/%65urope",), ("/a_b",), ("//",), ("/europe//",)]


@query("p18_landing", "SELECT * FROM (VALUES ('/', true, '', ''), ('/europe', true, 'europe', ''), ('/Europe/LT/', true, 'europe', 'lt'), ('/europe/lt/x', false, '', ''), ('/index.html', false, '', ''), ('/%65urope', true, 'europe', ''), ('/a_b', false, '', ''), ('//', true, '', ''), ('/europe//', true, 'europe', '')) t(path, page, region, unit)")
def p18(spark, d):
    return _literals(spark, "path", PATHS).withColumn("l", text.landing(c("path"))).select("path", "l.page", "l.region", "l.unit")


AGENTS = [
    ("Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/120.0 Safari/537.36 Edg/120.0", "Edge", "Windows"), ("Mozilla/5.0 (Linux; Android 13) SamsungBrowser/20.0 Chrome/106.0 Mobile Safari/537.36", "Samsung Internet", "Android"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15) Version/17.0 Safari/605.1.15", "Safari", "macOS"), ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) CriOS/119.0 Mobile Safari/604.1", "Chrome", "iOS"),
    ("Mozilla/5.0 (X11; Linux x86_64; rv:120.0) Firefox/120.0", "Firefox", "Linux"), ("Googlebot/2.1 (+http://example.com/bot.html)", "Bot", "Other"), ("", "Other", "Other"), ("Opera/9.80 (X11; Linux)", "Opera", "Linux"),
]


@query("p19_user_agents", f"SELECT * FROM {_values(AGENTS)} t(ua, browser, os)")
def p19(spark, d):
    return _literals(spark, "ua", [(a[0],) for a in AGENTS]).select("ua", text.browser_family(c("ua")).alias("browser"), text.os_family(c("ua")).alias("os"))


_VISITS = "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN lower(substr(c_mktsegment, 1, 2)) WHEN 1 THEN 'T1' WHEN 3 THEN substr(c_mktsegment, 1, 2) END AS country, CASE c_custkey % 3 WHEN 0 THEN substr(c_mktsegment, 2, 2) || (c_nationkey % 10) WHEN 2 THEN 'TOOLONG' END AS region FROM customer"


@query("p18_visitor_code", f"""SELECT c_custkey, CASE WHEN country IS NULL OR NOT regexp_full_match(upper(country), '[A-Z]{{2}}') THEN '' WHEN region IS NOT NULL AND regexp_full_match(upper(region), '[A-Z0-9]{{1,3}}') THEN upper(country) || '-' || upper(region) ELSE upper(country) END AS code FROM ({_VISITS})""")
def p18b(spark, d):
    rows = spark.sql(_VISITS.replace("FROM customer", "FROM {customer}"), customer=_table(spark, d, "customer"))
    return rows.select("c_custkey", text.visitor_code(c("country"), c("region")).alias("code"))


def _lon():
    return c("lon_e4") / 10000.0


def _lat():
    return c("lat_e4") / 10000.0


@query("g01_utm_epsg", with_views("points", "SELECT event_id, CAST(CASE WHEN lat_e4 >= 0 THEN 32600 ELSE 32700 END + least(60, greatest(1, floor((lon_e4 / 10000.0 + 180.0) / 6.0) + 1)) AS INTEGER) AS epsg FROM points"))
def g01(spark, d):
    return fx.points(spark, d).select("event_id", crs.utm_epsg(_lon(), _lat()).alias("epsg"))


@query("g05_upper", with_views("points", "SELECT event_id, CAST(floor((dist_cm / 100.0 + 2 * 707.1067811865476) * (1 + 0.003) * 100) AS BIGINT) AS upper_cm FROM points"))
def g05(spark, d):
    return fx.points(spark, d).select("event_id", F.floor(crs.upper_bound(c("dist_cm") / 100.0, 1000.0, F.lit(0.003)) * 100).alias("upper_cm"))


@query("g07_densify", with_views("roads", """SELECT way_id, k, CAST(floor((x1 + CAST((x2 - x1) * k AS DOUBLE) / n) * 1000) AS BIGINT) AS px_mm, CAST(floor((y1 + CAST((y2 - y1) * k AS DOUBLE) / n) * 1000) AS BIGINT) AS py_mm
 FROM (SELECT *, unnest(generate_series(0, n)) AS k FROM (SELECT *, greatest(1, CAST(ceil(sqrt(CAST((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1) AS DOUBLE)) / 250.0) AS BIGINT)) AS n FROM roads))"""))
def g07(spark, d):
    return densified(fx.roads(spark, d), 250.0).select("way_id", "k", F.floor(c("px") * 1000).alias("px_mm"), F.floor(c("py") * 1000).alias("py_mm"))


@query("g11_cell_of", with_views("points", "SELECT event_id, CAST(floor((200000 - y) / 1000.0) AS BIGINT) AS row, CAST(floor(x / 1000.0) AS BIGINT) AS col FROM points"))
def g11(spark, d):
    row, col = crs.cell_of(c("x"), c("y"), 0, 200000, 1000)
    return fx.points(spark, d).select("event_id", row.alias("row"), col.alias("col"))


@query("g15_lon_delta", with_views("points", "SELECT event_id, -((((2 * lat_e4 - lon_e4 + 1800000) % 3600000) + 3600000) % 3600000 - 1800000) AS delta_e4 FROM points"))
def g15(spark, d):
    return fx.points(spark, d).select("event_id", lon.lon_delta(c("lon_e4"), 2 * c("lat_e4"), 3600000).alias("delta_e4"))


@query("g16_split_bbox", with_views("points", """SELECT event_id, lon_e4 AS west, least(lon_e4 + event_id % 1000000, 1800000) AS east FROM points
 UNION ALL SELECT event_id, -1800000, lon_e4 + event_id % 1000000 - 3600000 FROM points WHERE lon_e4 + event_id % 1000000 > 1800000"""))
def g16(spark, d):
    boxes = lon.split_bbox(c("lon_e4"), c("lat_e4"), c("lon_e4") + c("event_id") % 1000000, c("lat_e4") + 1, 3600000)
    return fx.points(spark, d).select("event_id", F.explode(boxes).alias("b")).select("event_id", "b.west", "b.east")


@query("g21_georef", with_views("points", """SELECT event_id, CAST(floor((lat_e4 / 10000.0 + (50.0 / 111320.0) * 40 / 2) * 1e6 + 0.5) AS BIGINT) AS north_e6, 40 AS width, 40 AS height FROM points"""))
def g21(spark, d):
    return fx.points(spark, d).select("event_id", crs.georef(_lat(), _lon(), 50.0, 2000.0).alias("g")).select("event_id", F.floor(c("g.north") * 1e6 + 0.5).alias("north_e6"), "g.width", "g.height")


@query("g23_tile_xy", with_views("points", """SELECT event_id, CAST(floor((lon_e4 / 10000.0 + 180.0) / 360.0 * 512.0) AS BIGINT) AS tx,
 CAST(floor((1.0 - ln(tan(radians(lat_e4 / 10000.0)) + 1.0 / cos(radians(lat_e4 / 10000.0))) / pi()) / 2.0 * 512.0) AS BIGINT) AS ty FROM points"""))
def g23(spark, d):
    x, y = crs.tile_xy(_lon(), _lat(), 9)
    return fx.points(spark, d).select("event_id", x.alias("tx"), y.alias("ty"))


@query("g02_project")
def g02(spark, d):
    """UTM, LAEA and Mercator coordinates of the points, in whole metres (no SQL twin: series and logarithms)."""
    rows = fx.points(spark, d).withColumn("epsg", crs.utm_epsg(_lon(), _lat()))
    sides = {"utm": crs.utm(_lon(), _lat(), c("epsg")), "laea": crs.laea(_lon(), _lat(), 10.0, 52.0, 4321000.0, 3210000.0), "merc": crs.mercator(_lon(), _lat())}
    return rows.select("event_id", "epsg", *[F.floor(v + 0.5).alias(f"{n}_{a}") for n, pair in sides.items() for a, v in zip("xy", pair, strict=True)])


@query("g03_pad")
def g03(spark, d):
    return fx.points(spark, d).select("event_id", F.floor(crs.laea_pad(_lon(), _lat(), 10.0, 52.0) * 1e6).alias("pad_e6"))


@query("g06_geodesic")
def g06(spark, d):
    near = geodesy.geodesic_m(_lon(), _lat(), _lon() + (c("event_id") % 100) / 50.0, _lat() + (c("event_id") % 70) / 50.0 - 0.7)
    return fx.points(spark, d).select("event_id", F.floor(near * 10).alias("dist_dm"))


@query("g22_search_box", with_views("points", "SELECT event_id, CAST(floor((lat_e4 / 10000.0 - dist_cm / 111320.0) * 1e6) AS BIGINT) AS south_e6, CAST(floor((lat_e4 / 10000.0 + dist_cm / 111320.0) * 1e6) AS BIGINT) AS north_e6 FROM points"))
def g22(spark, d):
    return fx.points(spark, d).select("event_id", crs.search_box(_lat(), _lon(), c("dist_cm")).alias("b")).select("event_id", F.floor(c("b.south") * 1e6).alias("south_e6"), F.floor(c("b.north") * 1e6).alias("north_e6"))


@query("g26_view_bounds", with_views("points", "SELECT event_id, lon_e4 + CASE WHEN (2 * lon_e4 + event_id % 1000000) / 2.0 > 1800000 THEN -3600000 ELSE 0 END AS west, lon_e4 + event_id % 1000000 + CASE WHEN (2 * lon_e4 + event_id % 1000000) / 2.0 > 1800000 THEN -3600000 ELSE 0 END AS east FROM points"))
def g26(spark, d):
    e = c("lon_e4") + c("event_id") % 1000000
    return fx.points(spark, d).select("event_id", lon.view_bounds(c("lon_e4"), c("lat_e4"), e, c("lat_e4"), 3600000).alias("b")).select("event_id", c("b")[0][1].alias("west"), c("b")[1][1].alias("east"))


_EDGES = "edges AS (SELECT unnest(list_concat(generate_series(0, 2450, 50), generate_series(2500, 9900, 100), generate_series(10000, 29750, 250), generate_series(30000, 59000, 1000), generate_series(60000, 230000, 10000), [240000])) AS e)"


@query("f01_default_edges", f"WITH {_EDGES} SELECT row_number() OVER (ORDER BY e) - 1 AS cls, e AS lower FROM edges")
def f01(spark, d):
    return spark.range(1).select(F.posexplode(classes.edges_column()).alias("cls", "lower")).select(c("cls").cast("long").alias("cls"), c("lower").cast("long").alias("lower"))


@query("f02_class", with_views("points", "SELECT event_id, least(253, CASE WHEN m < 2500 THEN m // 50 WHEN m < 10000 THEN 50 + (m - 2500) // 100 WHEN m < 30000 THEN 125 + (m - 10000) // 250 WHEN m < 60000 THEN 205 + (m - 30000) // 1000 ELSE 235 + (m - 60000) // 10000 END) AS cls FROM (SELECT event_id, dist_cm * 7 % 300000 AS m FROM points)"))
def f02(spark, d):
    return fx.points(spark, d).select("event_id", classes.to_class(c("dist_cm") * 7 % 300000).cast("long").alias("cls"))


@query("f03_class_bounds", f"WITH {_EDGES} SELECT row_number() OVER (ORDER BY e) - 1 AS cls, e AS lower, lead(e) OVER (ORDER BY e) AS upper, coalesce((e + lead(e) OVER (ORDER BY e)) / 2.0, e) AS mid FROM edges")
def f03(spark, d):
    k = c("id").cast("int")
    return spark.range(254).select(c("id").alias("cls"), classes.class_lower(k).cast("long").alias("lower"), classes.class_upper(k).cast("long").alias("upper"), classes.class_mid(k).alias("mid"))


@query("f04_precedence", with_views("points", "SELECT event_id, CASE WHEN excluded THEN 255 WHEN island IS NOT NULL THEN 254 ELSE event_id % 254 END AS cls FROM points"))
def f04(spark, d):
    return fx.points(spark, d).select("event_id", classes.precedence(c("excluded"), c("island").isNotNull(), c("event_id") % 254).alias("cls"))


@query("f05_ladder", with_views("points", "SELECT event_id, CAST(CASE WHEN dist_cm > 0 THEN greatest(0, least(65534, ceil(ln(dist_cm / 60000.0) / ln(0.99)))) ELSE 65535 END AS INTEGER) AS rung FROM points"))
def f05(spark, d):
    return fx.points(spark, d).select("event_id", classes.ladder_index(c("dist_cm"), 60000.0).alias("rung"))


@query("f07_col_threshold", with_views("points", "SELECT event_id, CAST(0.5 * least(dist_cm, 30000) AS DOUBLE) AS threshold FROM points"))
def f07(spark, d):
    return fx.points(spark, d).select("event_id", classes.col_threshold(c("dist_cm"), F.lit(30000), 0.5).alias("threshold"))


@query("f10_clean_text", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 2 THEN s_name END AS name FROM supplier")
def f10(spark, d):
    said = F.when(c("s_suppkey") % 3 == 0, F.lit("NaN")).when(c("s_suppkey") % 3 == 2, c("s_name"))
    return _table(spark, d, "supplier").select("s_suppkey", text.clean(said).alias("name"))


@query("f12_detail_stem", with_views("points", "SELECT event_id, printf('%s-%.6f_%.6f', scenario, lat_e4 / 10000.0, lon_e4 / 10000.0) AS stem FROM points"))
def f12(spark, d):
    return fx.points(spark, d).select("event_id", text.detail_stem(c("scenario"), _lat(), _lon()).alias("stem"))


@query("f14_fmt_dist", with_views("points", """SELECT event_id, CASE WHEN tens < 1000 THEN tens || ' m' WHEN m < 9950 THEN (CAST(floor(m / 1000.0 * 10 + 0.5) AS BIGINT) // 10) || '.' || (CAST(floor(m / 1000.0 * 10 + 0.5) AS BIGINT) % 10) || ' km'
 ELSE CAST(floor(m / 1000.0 + 0.5) AS BIGINT) || ' km' END AS said FROM (SELECT *, CAST(floor(m / 10.0 + 0.5) AS BIGINT) * 10 AS tens FROM (SELECT event_id, dist_cm * 3 % 90000 AS m FROM points))"""))
def f14(spark, d):
    return fx.points(spark, d).select("event_id", text.fmt_dist(c("dist_cm") * 3 % 90000).alias("said"))


@query("f15_fmt_exact", """SELECT p_partkey, coalesce(format('{:,}', cents // 100) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || ' km', '') AS km,
 CASE WHEN a IS NULL THEN '' WHEN a < 9.95 THEN CAST(tenths // 10 AS VARCHAR) || '.' || (tenths % 10) || ' km²' ELSE format('{:,}', CAST(floor(a + 0.5) AS BIGINT)) || ' km²' END AS km2
 FROM (SELECT p_partkey, CAST(floor(m / 1000 * 100 + 0.5) AS BIGINT) AS cents, a, CAST(floor(a * 10 + 0.5) AS BIGINT) AS tenths FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN p_retailprice * 1234.5::DOUBLE END AS m, CASE WHEN p_partkey % 5 > 0 THEN p_size * p_size * 0.37::DOUBLE END AS a FROM part))""")
def f15(spark, d):
    m, a = F.when(c("p_partkey") % 7 > 0, c("p_retailprice") * 1234.5), F.when(c("p_partkey") % 5 > 0, c("p_size") * c("p_size") * 0.37)
    return _table(spark, d, "part").select("p_partkey", text.fmt_km_exact(m).alias("km"), text.fmt_km2(a).alias("km2"))


@query("f16_flag", "SELECT c_custkey, CASE WHEN c_custkey % 3 < 2 THEN chr(127462 + ord(substr(c_mktsegment, 1, 1)) - 65) || chr(127462 + CAST(c_nationkey AS INTEGER) % 26) ELSE '' END AS flag FROM customer")
def f16(spark, d):
    """Two-letter codes in either case; others have none."""
    code = F.concat(F.substring("c_mktsegment", 1, 1), F.chr(65 + c("c_nationkey") % 26))
    code = F.when(c("c_custkey") % 3 == 0, F.lower(code)).when(c("c_custkey") % 3 == 1, code).otherwise(F.concat(code, F.lit("-x")))
    return _table(spark, d, "customer").select("c_custkey", text.flag(code).alias("flag"))


@query("f17_palette_band", f"WITH {_EDGES} SELECT row_number() OVER (ORDER BY e) - 1 AS cls, CASE WHEN e >= 50000 THEN 5 WHEN e >= 20000 THEN 4 WHEN e >= 10000 THEN 3 WHEN e >= 5000 THEN 2 WHEN e >= 2500 THEN 1 WHEN e >= 1000 THEN 0 END AS band FROM edges")
def f17(spark, d):
    return spark.range(254).select(c("id").alias("cls"), classes.palette_band(c("id").cast("int")).alias("band"))


@query("f19_total_size", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS total FROM orders")
def f19(spark, d):
    total = F.when(c("o_orderkey") % 10 == 5, "*").when(c("o_orderkey") % 10 == 0, "").otherwise(c("o_custkey").cast("string"))
    return _table(spark, d, "orders").select("o_orderkey", text.total_size(F.concat(F.lit("bytes 0-99/"), total)).alias("total"))


@query("f21_snapshot", with_views("points", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS snapshot FROM points"))
def f21(spark, d):
    return fx.points(spark, d).select("event_id", text.snapshot_id(c("ts")).alias("snapshot"))


@query("x39_hex_rgb", """SELECT s_suppkey, list_transform([1, 3, 5], lambda k: CAST('0x' || substr(h, k, 2) AS INTEGER)) AS rgb FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN substr(md5(s_name), 1, 6)
 ELSE repeat(substr(md5(s_name), 1, 1), 2) || repeat(substr(md5(s_name), 2, 1), 2) || repeat(substr(md5(s_name), 3, 1), 2) END AS h FROM supplier)""")
def x39(spark, d):
    """Colours of six digits, and of three."""
    color = F.concat(F.lit("#"), F.when(c("s_suppkey") % 2 == 0, F.substring(F.md5("s_name"), 1, 6)).otherwise(F.substring(F.md5("s_name"), 1, 3)))
    return _table(spark, d, "supplier").select("s_suppkey", text.hex_rgb(color).alias("rgb"))




@query("s03_checksum", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 3 THEN '' ELSE md5(s_name) END AS md5 FROM supplier")
def s03(spark, d):
    """Checksum lines: the digest first or last, in either case, or none."""
    h = F.md5("s_name")
    line = F.when(c("s_suppkey") % 4 == 0, F.concat(h, F.lit("  a-latest.osm.pbf"))).when(c("s_suppkey") % 4 == 1, F.concat(F.lit("MD5 (a) = "), F.upper(h))).when(c("s_suppkey") % 4 == 2, h).otherwise(F.concat(F.lit("x"), h))
    return _table(spark, d, "supplier").select("s_suppkey", text.checksum(line).alias("md5"))


@query("s15_opl_unescape", "SELECT c_custkey, c_mktsegment || chr(CAST(code AS INTEGER)) || 'x%' || chr(CAST(c_nationkey + 32 AS INTEGER)) AS said FROM (SELECT *, CASE WHEN c_custkey * 97 % 120000 BETWEEN 55000 AND 57400 THEN 32 ELSE c_custkey * 97 % 120000 + 32 END AS code FROM customer)")
def s15(spark, d):
    """Escapes of code points of one to four bytes, beside a percent sign that is none."""
    code = F.when((c("c_custkey") * 97 % 120000).between(55000, 57400), 32).otherwise(c("c_custkey") * 97 % 120000 + 32)
    raw = F.concat(c("c_mktsegment"), F.lit("%"), F.lower(F.hex(code)), F.lit("%x%%"), F.hex(c("c_nationkey") + 32), F.lit("%"))
    return _table(spark, d, "customer").select("c_custkey", text.decode_escapes(raw).alias("said"))


@query("s16_opl_parse", """SELECT c_custkey AS id, key, value, CAST(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 2 END AS BIGINT) AS members FROM customer, (VALUES ('type'), ('name')) t(key), LATERAL (SELECT CASE key WHEN 'type' THEN 'boundary' ELSE 'A=' || c_mktsegment || ', ' || c_nationkey END AS value)
 WHERE c_custkey % 4 > 0 UNION ALL SELECT c_custkey, NULL, NULL, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 2 END FROM customer WHERE c_custkey % 4 = 0""")
def s16(spark, d):
    """Tags and members out of their fields; empty fields have none."""
    tags = F.when(c("c_custkey") % 4 > 0, F.concat(F.lit("type=old,type=boundary,name=A%3d%"), c("c_mktsegment"), F.lit("%2c%%20%"), c("c_nationkey"))).otherwise("")
    members = F.when(c("c_custkey") % 3 > 0, F.concat(F.lit("w"), c("c_custkey"), F.lit("@outer,n5@"))).otherwise("")
    rows = _table(spark, d, "customer").select(c("c_custkey").alias("id"), text.parse_tags(tags).alias("t"), F.size(text.parse_members(members)).cast("long").alias("members"))
    return rows.select("id", F.explode_outer("t").alias("key", "value"), "members")


@query("s19_poly_url", "SELECT c_custkey, 'http://example.org/' || lower(c_mktsegment) || '/u' || c_custkey || '.poly' AS poly FROM customer")
def s19(spark, d):
    url = F.concat(F.lit("http://example.org/"), F.lower("c_mktsegment"), F.lit("/u"), c("c_custkey"), F.lit("-latest.osm.pbf"))
    return _table(spark, d, "customer").select("c_custkey", text.poly_url(url).alias("poly"))
