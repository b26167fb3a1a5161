"""Registered queries over published points: ranks, exclusions, checks, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.functions import lon
from farfield.operators import checks, ranking
from farfield.plans import fixtures as fx
from farfield.plans.fixtures import with_views
from farfield.sources import sinks
from farfield.sources.files import changed_stamps
from farfield.streaming.views import window_counts

c = F.col
CASES: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        CASES[name] = (f, sql)
        return f

    return add


def _ranked(spark, d) -> DataFrame:
    return ranking.ranked(fx.points(spark, d))


def _kept(spark, d) -> DataFrame:
    """Points after validation's exclusions, ranks renumbered."""
    rows = _ranked(spark, d)
    return ranking.without(rows, rows.where("excluded").select("scenario", "unit_id", "rank"))[0]


@query("p11_select_units", with_views("units", "SELECT code, row_number() OVER (ORDER BY code) AS unit_index FROM units WHERE country_id <> 3"))
def p11(spark, d):
    """Units of the wanted countries, numbered by code: a list of some hundred rows."""
    from pyspark.sql import Window

    return fx.units(spark, d).where("country_id <> 3").select("code", F.row_number().over(Window.orderBy("code")).cast("long").alias("unit_index"))


@query("w03_renumber", with_views("ranked", "SELECT event_id, scenario, unit_id, old_rank, rank FROM kept"))
def w03(spark, d):
    return _kept(spark, d).select("event_id", "scenario", "unit_id", c("old_rank").cast("long").alias("old_rank"), c("rank").cast("long").alias("rank"))


@query("j14_exclusions_antijoin", with_views("ranked", "SELECT scenario, unit_id, count(*) AS kept FROM kept GROUP BY ALL"))
def j14(spark, d):
    return _kept(spark, d).groupBy("scenario", "unit_id").agg(F.count("*").alias("kept"))


@query("a22_withheld", with_views("ranked", "SELECT scenario, unit_id, count(*) FILTER (WHERE excluded) AS withheld FROM ranked GROUP BY ALL"))
def a22(spark, d):
    return ranking.withheld(_ranked(spark, d), _kept(spark, d))


@query("u04_unmatched_exclusions", with_views("ranked", "SELECT scenario, unit_id, rank FROM (SELECT scenario, unit_id, rank + 150 AS rank FROM ranked WHERE excluded EXCEPT SELECT scenario, unit_id, rank FROM ranked)"))
def u04(spark, d):
    rows = _ranked(spark, d)
    asked = rows.where("excluded").select("scenario", "unit_id", (c("rank") + 150).alias("rank"))
    return ranking.without(rows, asked)[1].select("scenario", "unit_id", c("rank").cast("long").alias("rank"))


@query("j13_edge_exclusions", with_views("ranked", "SELECT scenario, unit_id, rank, event_id FROM ranked WHERE 100 * least(x, 200000 - x, y, 200000 - y) <= dist_cm"))
def j13(spark, d):
    """Points that fail the data-edge check, as exclusions by scenario, unit and rank."""
    edge = F.least(c("x"), fx.SIDE - c("x"), c("y"), fx.SIDE - c("y"))
    rows = _ranked(spark, d)
    failed = rows.where(100 * edge <= c("dist_cm")).select("scenario", "unit_id", "rank")
    return failed.join(rows.select("scenario", "unit_id", "rank", "event_id"), ["scenario", "unit_id", "rank"]).withColumn("rank", c("rank").cast("long"))


@query("p15_visible_points", with_views("ranked", "SELECT event_id, rank, display FROM (SELECT *, row_number() OVER (PARTITION BY scenario, unit_id ORDER BY rank) AS display FROM kept WHERE island IS NULL) WHERE display <= 10"))
def p15(spark, d):
    return ranking.visible(_kept(spark, d), islands=False, top=10).select("event_id", c("rank").cast("long").alias("rank"), c("display").cast("long").alias("display"))


_REGIONAL = "SELECT scenario, unit_id, dist_cm, dense_rank() OVER (PARTITION BY scenario ORDER BY dist_cm DESC) AS regional_rank FROM (SELECT *, row_number() OVER (PARTITION BY scenario, unit_id ORDER BY rank) AS k FROM kept {}) WHERE k = 1"


@query("w01_regional_rank", with_views("ranked", _REGIONAL.format("")))
def w01b(spark, d):
    return ranking.regional_ranks(_kept(spark, d)).withColumn("regional_rank", c("regional_rank").cast("long"))


@query("w02_mainland_rank", with_views("ranked", _REGIONAL.format("WHERE island IS NULL")))
def w02(spark, d):
    return ranking.regional_ranks(_kept(spark, d), mainland_only=True).withColumn("regional_rank", c("regional_rank").cast("long"))


@query("w06_sort_units", with_views("ranked units", f", reg AS ({_REGIONAL.format('')}) SELECT u.code, row_number() OVER (ORDER BY a.regional_rank NULLS LAST, b.regional_rank NULLS LAST, u.code) AS place FROM units u LEFT JOIN (SELECT * FROM reg WHERE scenario = 'A') a USING (unit_id) LEFT JOIN (SELECT * FROM reg WHERE scenario = 'B') b USING (unit_id)").replace("\n, reg", ",\n reg"))
def w06(spark, d):
    ranks = ranking.regional_ranks(_kept(spark, d))
    return ranking.unit_order(ranks.where("scenario = 'A'"), ranks.where("scenario = 'B'"), fx.units(spark, d)).select("code", c("place").cast("long").alias("place"))


@query("w07_winner", with_views("ranked units", f", reg AS ({_REGIONAL.format('')}) SELECT scenario, code FROM (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY regional_rank, code) AS k FROM reg JOIN units USING (unit_id)) WHERE k = 1").replace("\n, reg", ",\n reg"))
def w07(spark, d):
    rows = ranking.regional_ranks(_kept(spark, d)).join(fx.units(spark, d), "unit_id")
    return rows.groupBy("scenario").agg(ranking.winner(c("regional_rank"), c("code")).alias("code"))


@query("w08_first_kept", with_views("ranked", "SELECT scenario, unit_id, event_id, dist_cm FROM kept WHERE rank = 1"))
def w08(spark, d):
    return ranking.best(_kept(spark, d)).select("scenario", "unit_id", "top.event_id", "top.dist_cm")


@query("x18_unit_summary", with_views("ranked units", "SELECT u.code, s.scenario, k.dist_cm, k.event_id FROM units u CROSS JOIN (VALUES ('A'), ('B')) s(scenario) LEFT JOIN (SELECT * FROM kept WHERE rank = 1 AND dist_cm > 20000) k ON k.unit_id = u.unit_id AND k.scenario = s.scenario"))
def x18(spark, d):
    """Each unit in each scenario with its leading point over 200 m, or nulls."""
    both = fx.units(spark, d).withColumn("scenario", F.explode(F.array(F.lit("A"), F.lit("B"))))
    top = ranking.best(_kept(spark, d)).where("top.dist_cm > 20000")
    return both.join(top, ["unit_id", "scenario"], "left").select("code", "scenario", "top.dist_cm", "top.event_id")


_FEW = "few AS (SELECT unit_id, count(*) AS n FROM points WHERE unit_id IN (SELECT unit_id FROM units WHERE country_id <> 3) AND scenario = 'A' GROUP BY 1)"


@query("j18_not_searched", with_views("points units", f", {_FEW} SELECT code, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'not searched' END AS reason FROM units LEFT JOIN few USING (unit_id)").replace("\n, few", ",\n few"))
def j18(spark, d):
    """The search went over the units of the wanted countries."""
    wanted = fx.units(spark, d).where("country_id <> 3").select("unit_id")
    return _not_searched(spark, d, fx.points(spark, d).join(wanted, "unit_id", "left_semi"))


def _not_searched(spark, d, points) -> DataFrame:
    few = points.where("scenario = 'A'").groupBy("unit_id").agg(F.count("*").alias("n"))
    rows = fx.units(spark, d).join(few, "unit_id", "left")
    return rows.select("code", F.coalesce("n", F.lit(0)).alias("n"), F.when(c("n").isNull(), "not searched").alias("reason"))


@query("u03_stray_units", with_views("points units", "SELECT DISTINCT unit_id FROM points EXCEPT SELECT unit_id FROM units WHERE country_id <> 3"))
def u03(spark, d):
    return fx.points(spark, d).select("unit_id").distinct().join(fx.units(spark, d).where("country_id <> 3").select(c("unit_id").cast("long").alias("unit_id")), "unit_id", "left_anti")


_PAIR = "least(abs(a.lon_e4 - b.lon_e4), 3600000 - abs(a.lon_e4 - b.lon_e4))"


@query("j15_nearest_counterpart", with_views("ranked", f"SELECT a.scenario, a.unit_id, a.rank, b.rank AS other FROM (SELECT * FROM kept WHERE rank <= 3) a JOIN (SELECT * FROM kept WHERE rank BETWEEN 4 AND 12) b USING (scenario, unit_id) QUALIFY row_number() OVER (PARTITION BY a.scenario, a.unit_id, a.rank ORDER BY {_PAIR} * {_PAIR} + (a.lat_e4 - b.lat_e4) * (a.lat_e4 - b.lat_e4), b.rank) = 1"))
def j15(spark, d):
    rows = _kept(spark, d)
    other = rows.where("rank BETWEEN 4 AND 12").select("scenario", "unit_id", c("rank").alias("other"), c("lon_e4").alias("blon"), c("lat_e4").alias("blat"))
    near = rows.where("rank <= 3").join(other, ["scenario", "unit_id"])
    dx, dy = F.abs(lon.lon_delta(c("lon_e4"), c("blon"), 3600000)), c("lat_e4") - c("blat")
    best = near.groupBy("scenario", "unit_id", "rank").agg(F.min(F.struct((dx * dx + dy * dy).alias("d"), "other")).alias("b"))
    return best.select("scenario", "unit_id", c("rank").cast("long").alias("rank"), c("b.other").cast("long").alias("other"))


@query("j16_pairwise", with_views("ranked", "SELECT a.scenario, a.unit_id, a.rank AS rank_i, b.rank AS rank_j, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM kept a JOIN kept b USING (scenario, unit_id) WHERE a.rank < b.rank AND b.rank <= 10"))
def j16(spark, d):
    pairs = checks.pairs(_kept(spark, d).where("rank <= 10"), ["scenario", "unit_id"], ["x", "y"])
    dx, dy = c("x_i") - c("x_j"), c("y_i") - c("y_j")
    return pairs.select("scenario", "unit_id", c("rank_i").cast("long").alias("rank_i"), c("rank_j").cast("long").alias("rank_j"), (dx * dx + dy * dy).alias("d2"))


_BUNCH = """, pair AS (SELECT a.scenario, a.unit_id, a.rank AS i, b.rank AS j, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM kept a JOIN kept b USING (scenario, unit_id) WHERE a.rank <> b.rank AND a.rank <= 10 AND b.rank <= 10),
 nearest AS (SELECT scenario, unit_id, i, min(d2) AS d2, max(d2) AS far FROM pair GROUP BY ALL),
 bunch AS (SELECT scenario, unit_id, min(d2) AS nn_min2, count(*) FILTER (WHERE d2 <= 400000000) AS near, max(far) AS diameter2, max(far) <= 400000000 AS bunched FROM nearest GROUP BY ALL)
"""


@query("a17_bunching", with_views("ranked", _BUNCH + "SELECT * FROM bunch").replace("\n, pair", ",\n pair"))
def a17(spark, d):
    pairs = j16(spark, d)
    both = pairs.select("scenario", "unit_id", c("rank_i").alias("i"), "d2").unionByName(pairs.select("scenario", "unit_id", c("rank_j").alias("i"), "d2"))
    nearest = both.groupBy("scenario", "unit_id", "i").agg(F.min("d2").alias("d2"), F.max("d2").alias("far"))
    return nearest.groupBy("scenario", "unit_id").agg(F.min("d2").alias("nn_min2"), F.count_if(c("d2") <= 400000000).alias("near"), F.max("far").alias("diameter2"), (F.max("far") <= 400000000).alias("bunched"))


@query("a18_region_totals_rollup", with_views("ranked units", "SELECT country_id, scenario, count(*) AS points, count(DISTINCT unit_id) AS units, max(dist_cm) AS farthest FROM kept JOIN units USING (unit_id) GROUP BY ROLLUP (country_id, scenario)"))
def a18(spark, d):
    rows = _kept(spark, d).join(fx.units(spark, d).select("unit_id", "country_id"), "unit_id")
    return rows.rollup("country_id", "scenario").agg(F.count("*").alias("points"), F.countDistinct("unit_id").alias("units"), F.max("dist_cm").alias("farthest"))


@query("a19_island_changes", with_views("ranked", """, a AS (SELECT scenario, unit_id, min_by(event_id, rank) AS shown, min_by(event_id, rank) FILTER (WHERE island IS NULL) AS hidden, count(island) AS islands FROM kept GROUP BY ALL)
 SELECT scenario, unit_id, islands, shown, hidden FROM a WHERE shown IS DISTINCT FROM hidden""").replace("\n, a AS", ",\n a AS"))
def a19(spark, d):
    """Lists whose leading point changes when islands are left out."""
    mainland = F.when(c("island").isNull(), c("rank"))
    rows = _kept(spark, d).groupBy("scenario", "unit_id").agg(F.count("island").alias("islands"), F.min_by("event_id", "rank").alias("shown"), F.min_by("event_id", mainland).alias("hidden"))
    return rows.where(~c("shown").eqNullSafe(c("hidden")))


@query("a24_ranked_units", with_views("ranked", "SELECT scenario, count(DISTINCT unit_id) AS ranked_units FROM kept GROUP BY 1"))
def a24(spark, d):
    return ranking.regional_ranks(_kept(spark, d)).groupBy("scenario").agg(F.count("*").alias("ranked_units"))


@query("x41_first_visible", with_views("ranked", "SELECT scenario, unit_id, min(rank) AS first_rank FROM kept WHERE island IS NULL GROUP BY ALL"))
def x41(spark, d):
    rows = ranking.visible(_kept(spark, d), islands=False, top=10)
    return rows.groupBy("scenario", "unit_id").agg(F.min_by("rank", "display").cast("long").alias("first_rank"))


@query("j17_references", with_views("ranked", """SELECT r.event_id, r.unit_id, coalesce(abs(k.dist_cm - r.dist_cm) * 100 <= r.dist_cm AND (k.x - r.x) * (k.x - r.x) + (k.y - r.y) * (k.y - r.y) <= 250000, false) AS passed
 FROM (SELECT * FROM points WHERE scenario = 'A' AND dist_cm > 0) r LEFT JOIN (SELECT * FROM kept WHERE rank = 1 AND scenario = 'A' AND unit_id <> 7) k ON k.unit_id = r.unit_id"""))
def j17(spark, d):
    return _references(spark, d, fx.points(spark, d))


def _references(spark, d, points) -> DataFrame:
    refs = points.where("scenario = 'A' AND dist_cm > 0").select("event_id", "unit_id", c("dist_cm").alias("ref"), c("x").alias("rx"), c("y").alias("ry"))
    tops = ranking.best(_kept(spark, d)).where("scenario = 'A' AND unit_id <> 7").select("unit_id", "top.dist_cm", "top.x", "top.y")
    dx, dy = c("x") - c("rx"), c("y") - c("ry")
    near = (F.abs(c("dist_cm") - c("ref")) * 100 <= c("ref")) & (dx * dx + dy * dy <= checks.REF_MOVE**2)
    return refs.join(tops, "unit_id", "left").select("event_id", "unit_id", F.coalesce(near, F.lit(False)).alias("passed"))


@query("j20_unit_at", with_views("points units", """SELECT event_id, code FROM (SELECT p.event_id, u.code, row_number() OVER (PARTITION BY p.event_id ORDER BY CASE WHEN u.country_id = p.event_id % 5 THEN 0 ELSE 1 END, u.area, u.code) AS k
 FROM (SELECT * FROM points) p JOIN (SELECT *, (unit_id % 7 + 1) * 9000 AS w, CAST((unit_id % 7 + 1) * 9000 AS BIGINT) * 50000 AS area FROM units) u ON p.x >= u.x0 AND p.x <= u.x0 + 40000 + u.w AND p.y >= u.y0 AND p.y <= u.y0 + 50000) WHERE k = 1"""))
def j20(spark, d):
    return _unit_at(spark, d, fx.points(spark, d))


def _unit_at(spark, d, points) -> DataFrame:
    """Of the overlapping boxes at a point: the visitor's own country first, then the smallest."""
    size = 20000
    boxes = fx.units(spark, d).withColumn("w", ((c("unit_id") % 7 + 1) * 9000).cast("long")).withColumn("area", c("w") * 50000)
    cover = boxes.withColumn("bx", F.explode(F.sequence(F.floor(c("x0") / size), F.floor((c("x0") + 40000 + c("w")) / size)))).withColumn("by", F.explode(F.sequence(F.floor(c("y0") / size), F.floor((c("y0") + 50000) / size))))
    asked = points.select("event_id", "x", "y").withColumn("bx", F.floor(c("x") / size)).withColumn("by", F.floor(c("y") / size))
    hits = asked.join(cover, ["bx", "by"]).where("x >= x0 AND x <= x0 + 40000 + w AND y >= y0 AND y <= y0 + 50000")
    own = F.when(c("country_id") == c("event_id") % 5, 0).otherwise(1)
    return hits.groupBy("event_id").agg(F.min(F.struct(own.alias("own"), "area", "code")).alias("b")).select("event_id", "b.code")


@query("j21_opening_unit", with_views("ranked units", """, reg AS (SELECT unit_id, dense_rank() OVER (ORDER BY dist_cm DESC) AS r FROM kept WHERE rank = 1 AND scenario = 'A')
 SELECT v.event_id, coalesce(p.code, o.code, (SELECT code FROM reg JOIN units USING (unit_id) ORDER BY r, code LIMIT 1)) AS code FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN unit_id END AS asked, CASE WHEN event_id % 3 = 1 THEN unit_id END AS visitor FROM points) v
 LEFT JOIN units p ON p.unit_id = v.asked LEFT JOIN units o ON o.unit_id = v.visitor""").replace("\n, reg", ",\n reg"))
def j21(spark, d):
    return _opening_unit(spark, d, fx.points(spark, d))


def _opening_unit(spark, d, points) -> DataFrame:
    """Which unit a page opens with: the path's, else the visitor's, else the winner."""
    units = fx.units(spark, d).select(c("unit_id").cast("long").alias("unit_id"), "code")
    ranks = ranking.regional_ranks(_kept(spark, d)).where("scenario = 'A'").join(units, "unit_id").agg(ranking.winner(c("regional_rank"), c("code")).alias("winner"))
    rows = points.select("event_id", F.when(c("event_id") % 3 == 0, c("unit_id")).alias("asked"), F.when(c("event_id") % 3 == 1, c("unit_id")).alias("visitor"))
    rows = rows.join(units.select(c("unit_id").alias("asked"), c("code").alias("p")), "asked", "left").join(units.select(c("unit_id").alias("visitor"), c("code").alias("o")), "visitor", "left")
    return rows.crossJoin(F.broadcast(ranks)).select("event_id", F.coalesce("p", "o", "winner").alias("code"))


_SPANS = "spans AS (SELECT unit_id, lon_e4 AS w, lon_e4 + event_id % 40000 AS e FROM points)"


@query("w09_span_merge", with_views("points", f""", {_SPANS}, marked AS (SELECT *, CASE WHEN w <= max(e) OVER (PARTITION BY unit_id ORDER BY w, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM spans),
 grouped AS (SELECT *, sum(n) OVER (PARTITION BY unit_id ORDER BY w, e ROWS UNBOUNDED PRECEDING) AS g FROM marked) SELECT unit_id, min(w) AS west, max(e) AS east FROM grouped GROUP BY unit_id, g""").replace("\n, spans", ",\n spans"))
def w09(spark, d):
    return _merged(fx.points(spark, d))


def _merged(points) -> DataFrame:
    spans = points.select("unit_id", c("lon_e4").alias("west"), (c("lon_e4") + c("event_id") % 40000).alias("east"))
    return lon.merged_spans(spans, ["unit_id"])


@query("g17_wrapped_bounds", "SELECT * FROM (VALUES (1, 172, 230), (2, -10, 20), (3, -180, 180)) t(id, west, east)")
def g17(spark, d):
    spans = spark.sql("SELECT * FROM VALUES (1, 172, 180), (1, -180, -130), (2, -10, 5), (2, 4, 20), (3, -180, 180) t(id, west, east)")
    return lon.wrapped_spans(lon.merged_spans(spans, ["id"]), ["id"], turn=360)


@query("w11_ring_unwrap", with_views("points", """, steps AS (SELECT event_id, unit_id, lon_e4, CASE WHEN lon_e4 - lag(lon_e4) OVER o > 1800000 THEN -3600000 WHEN lon_e4 - lag(lon_e4) OVER o < -1800000 THEN 3600000 ELSE 0 END AS jump FROM points WINDOW o AS (PARTITION BY unit_id ORDER BY event_id)),
 run AS (SELECT event_id, unit_id, lon_e4 + sum(jump) OVER (PARTITION BY unit_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS lon_e4 FROM steps)
 SELECT event_id, unit_id, CAST(lon_e4 + CASE WHEN min(lon_e4) OVER (PARTITION BY unit_id) < -1800000 THEN 3600000 ELSE 0 END AS BIGINT) AS lon_e4 FROM run""").replace("\n, steps", ",\n steps"))
def w11(spark, d):
    return _unwrapped(fx.points(spark, d))


def _unwrapped(points) -> DataFrame:
    rows = points.select("event_id", "unit_id", "lon_e4")
    return lon.unwrapped_rings(rows, ["unit_id"], "event_id", "lon_e4", 3600000)


_INV = """, a AS (SELECT * FROM kept WHERE rank = 1 AND scenario = 'A'), b AS (SELECT * FROM kept WHERE rank = 1 AND scenario = 'B'),
 res AS (SELECT 'a_le_b' AS name, u.unit_id, '*' AS scenario, coalesce(a.dist_cm <= b.dist_cm + 1, true) AS passed FROM units u LEFT JOIN a ON a.unit_id = u.unit_id LEFT JOIN b ON b.unit_id = u.unit_id
 UNION ALL SELECT 'mainland', u.unit_id, s.scenario, count(k.event_id) >= 150 FROM units u CROSS JOIN (VALUES ('A'), ('B')) s(scenario) LEFT JOIN (SELECT * FROM kept WHERE island IS NULL) k ON k.unit_id = u.unit_id AND k.scenario = s.scenario GROUP BY ALL)
"""


def _invariants(spark, d) -> DataFrame:
    units, rows = fx.units(spark, d).select("unit_id"), _kept(spark, d)
    top = lambda s: rows.where((c("rank") == 1) & (c("scenario") == s)).select("unit_id", c("dist_cm").alias(s))
    order = units.join(top("A"), "unit_id", "left").join(top("B"), "unit_id", "left").select(F.lit("a_le_b").alias("name"), "unit_id", F.lit("*").alias("scenario"), F.coalesce(c("A") <= c("B") + 1, F.lit(True)).alias("passed"))
    mainland = rows.where(c("island").isNull()).groupBy("unit_id", "scenario").agg(F.count("*").alias("n"))
    lists = units.withColumn("scenario", F.explode(F.array(F.lit("A"), F.lit("B")))).join(mainland, ["unit_id", "scenario"], "left")
    return order.unionByName(lists.select(F.lit("mainland").alias("name"), "unit_id", "scenario", (F.coalesce("n", F.lit(0)) >= 150).alias("passed")))


@query("v07a_invariants", with_views("ranked units", _INV + "SELECT * FROM res").replace("\n, a AS", ",\n a AS"))
def v07a(spark, d):
    return _invariants(spark, d)


@query("a16_check_summary", with_views("ranked units", _INV + "SELECT name AS check, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed, count(*) FILTER (WHERE NOT passed AND name = 'a_le_b') AS blocking, count(*) FILTER (WHERE NOT passed AND name <> 'a_le_b') AS warnings FROM res GROUP BY ROLLUP (name)").replace("\n, a AS", ",\n a AS"))
def a16(spark, d):
    rows = _invariants(spark, d).withColumnRenamed("name", "check").withColumn("blocking", c("check") == "a_le_b")
    return checks.summary(rows)


@query("k04_unit_lists", with_views("ranked", "SELECT scenario, unit_id, count(*) AS n, min(dist_cm) AS nearest, list(event_id ORDER BY rank)[1:3] AS first_three FROM kept GROUP BY ALL"))
def k04(spark, d):
    lists = sinks.nested_lists(_kept(spark, d).select("scenario", "unit_id", "rank", "event_id", "dist_cm"), ["scenario", "unit_id"])
    return lists.select("scenario", "unit_id", F.size("points").cast("long").alias("n"), F.array_min(F.transform("points", lambda p: p["dist_cm"])).alias("nearest"), F.transform(F.slice("points", 1, 3), lambda p: p["event_id"]).alias("first_three"))


@query("k11_document_merge", with_views("units", "SELECT unit_id, CASE WHEN unit_id % 3 = 0 THEN upper(code) ELSE code END AS code FROM units UNION ALL SELECT 100, 'NEW'"))
def k11(spark, d):
    old = fx.units(spark, d).select("unit_id", "code")
    new = old.where("unit_id % 3 = 0").select("unit_id", F.upper("code").alias("code")).unionByName(spark.sql("SELECT 100 AS unit_id, 'NEW' AS code"))
    return ranking.merged_documents(old, new, "unit_id")


@query("k12_upload_plan", with_views("points", "SELECT key, size FROM (SELECT event_id || '.json' AS key, dist_cm AS size FROM points) l WHERE NOT EXISTS (SELECT 1 FROM (SELECT event_id || '.json' AS key, dist_cm + event_id % 2 AS size FROM points WHERE NOT excluded) r WHERE r.key = l.key AND r.size = l.size)"))
def k12(spark, d):
    """The other side lacks the excluded points and has some in another size."""
    key = F.concat(c("event_id").cast("string"), F.lit(".json")).alias("key")
    rows = fx.points(spark, d)
    remote = rows.where("NOT excluded").select(key, (c("dist_cm") + c("event_id") % 2).alias("size"))
    return sinks.upload_plan(rows.select(key, c("dist_cm").alias("size")), remote).select("key", "size")


@query("k15_orphans", with_views("points", "SELECT 'r/s/detail/' || event_id || '.png' AS key FROM points WHERE coalesce(excluded, true)"))
def k15(spark, d):
    """Nothing refers to the excluded points' files."""
    stem = F.concat(F.lit("r/s/detail/"), c("event_id").cast("string"))
    rows = fx.points(spark, d)
    return sinks.orphans(rows.select(F.concat(stem, F.lit(".png")).alias("key")), rows.where("NOT excluded").select(stem.alias("stem")))


@query("f22_changed_stamps", with_views("units", "SELECT code AS path FROM units WHERE unit_id % 4 = 0 OR unit_id > 20"))
def f22(spark, d):
    rows = fx.units(spark, d).select(c("code").alias("path"), c("x0").alias("size"), c("y0").alias("mtime"), "unit_id")
    new = rows.where("unit_id <= 20").withColumn("size", c("size") + F.when(c("unit_id") % 4 == 0, 1).otherwise(0))
    return changed_stamps(rows, new)


@query("x14_render_fingerprint", with_views("ranked", "SELECT scenario, unit_id, sha256(string_agg(event_id || ':' || dist_cm, ',' ORDER BY rank)) AS sha FROM kept GROUP BY ALL"))
def x14(spark, d):
    one = F.concat_ws(":", c("event_id").cast("string"), c("dist_cm").cast("string"))
    parts = _kept(spark, d).groupBy("scenario", "unit_id").agg(F.array_sort(F.collect_list(F.struct("rank", one.alias("s")))).alias("l"))
    return parts.select("scenario", "unit_id", F.sha2(F.array_join(F.transform("l", lambda x: x["s"]), ","), 256).alias("sha"))


@query("x36_name_fallback", with_views("places", "SELECT place_id, coalesce(CASE WHEN place_id % 3 = 0 THEN name END, CASE WHEN place_id % 3 = 1 THEN kind END, CAST(place_id AS VARCHAR)) AS shown FROM places"))
def x36(spark, d):
    from farfield.functions.text import fallback_name

    return fx.places(spark, d).select("place_id", fallback_name(F.when(c("place_id") % 3 == 0, c("name")), F.when(c("place_id") % 3 == 1, c("kind")), c("place_id").cast("string")).alias("shown"))


@query("k16_view_counts", with_views("points", "SELECT time_bucket(INTERVAL '10 minutes', ts) AS start, event_type, count(*) AS n FROM points GROUP BY ALL"))
def k16(spark, d):
    """Counts of a page-view stream by window (here over the table as a batch)."""
    return window_counts(fx.points(spark, d))
