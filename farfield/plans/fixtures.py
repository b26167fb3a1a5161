"""Views over the star-schema tables that stand for roads, units, places, water and published points.

Both engines derive them by whole-number arithmetic. The plane is 200 km square in metres; cells are 1,000 m, so rows
and columns run from 0 to 199. SQL has the same views as common table expressions for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farfield.functions.tags import ROADS_A, ROADS_B, in_scenario
from farfield.operators.segments import supercover

SIDE, RES = 200_000, 1000
CELLS = SIDE // RES


def _read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    kinds = {0: "motorway", 1: "primary", 2: "residential", 3: "service", 4: "track", 5: "track", 6: "busway", 7: "path", 8: "primary_link"}
    highway = F.lit(None).cast("string")
    for k, kind in kinds.items():
        highway = F.when(key % 10 == k, kind).otherwise(highway)
    end = lambda start, factor: F.least(F.greatest(start + (F.col("way_id") * factor) % 12001 - 6000, F.lit(0)), F.lit(SIDE - 1))
    rows = _read(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey").select(
        key.alias("way_id"), highway.alias("highway"), F.col("s_name").alias("name"), ((key * 7919 + F.col("s_nationkey") * 1009) % SIDE).alias("x1"), ((key * 15487 + F.col("s_nationkey") * 3001) % SIDE).alias("y1")
    )
    return rows.withColumn("x2", end(F.col("x1"), 311)).withColumn("y2", end(F.col("y1"), 523))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey").selectExpr(
        "lower(n_name) AS code", "n_nationkey AS unit_id", "n_regionkey AS country_id", "(n_nationkey % 5) * 40000 AS x0", "(n_nationkey div 5) * 40000 AS y0"
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment").selectExpr(
        "c_custkey AS place_id", "c_name AS name", "c_mktsegment AS kind", f"(c_custkey * 4099) % {SIDE} AS x", f"(c_custkey * 7283) % {SIDE} AS y"
    )


def water(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "part", "p_partkey", "p_size").where("p_size >= 46")
    return rows.selectExpr("p_partkey AS water_id", "p_size * 100 AS side", f"(p_partkey * 6151) % {SIDE} AS x", f"(p_partkey * 3079) % {SIDE} AS y")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published points: 25 units in two scenarios."""
    rows = _read(spark, sf_dir, "events", "event_id", "user_id", "value", "event_type", "ts")
    return rows.selectExpr(
        "event_id", "user_id % 25 AS unit_id", "CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS scenario", "CAST(floor(value * 100 + 0.5) AS BIGINT) AS dist_cm",
        "CASE WHEN event_id % 5 = 0 THEN event_id % 997 END AS island", f"(event_id * 7919) % {SIDE} AS x", f"(event_id * 15487) % {SIDE} AS y",
        "(event_id * 7919) % 3600000 - 1800000 AS lon_e4", "(event_id * 104729) % 1600000 - 800000 AS lat_e4", "event_type = 'error' AS excluded", "event_type", "ts",
    )


def road_cells(spark: SparkSession, sf_dir: str, scenario: str = "A") -> DataFrame:
    ways = roads(spark, sf_dir)
    return supercover(ways.where(in_scenario(F.col("highway"), scenario)), RES).select("row", "col").distinct()


def water_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The squares' corners, as rings."""
    ring = F.array(*[F.struct(F.lit(i).alias("seq"), (F.col("x") + a * F.col("side")).alias("cx"), (F.col("y") + b * F.col("side")).alias("cy")) for i, (a, b) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1)))])
    return water(spark, sf_dir).select("water_id", F.explode(ring).alias("c")).select("water_id", "c.seq", F.col("c.cx").alias("x"), F.col("c.cy").alias("y"))


def water_cells(spark: SparkSession, sf_dir: str, least: int = 4800) -> DataFrame:
    """Cells whose centre lies in big water."""
    half = RES // 2
    span = lambda c: F.sequence(F.ceil((F.col(c) - half) / RES), F.ceil((F.col(c) + F.col("side") - half) / RES) - 1)
    rows = water(spark, sf_dir).where(F.col("side") >= least).withColumn("row", F.explode(span("y"))).withColumn("col", F.explode(span("x")))
    return rows.where(f"row < {CELLS} and col < {CELLS}").select("row", "col").distinct()


TAGS_A, TAGS_B = (", ".join(f"'{t}'" for t in tags) for tags in (ROADS_A, ROADS_B))

VIEWS = {
    "roads": """roads AS (
  SELECT way_id, highway, name, x1, y1, least(greatest(x1 + (way_id * 311) % 12001 - 6000, 0), 199999) AS x2,
         least(greatest(y1 + (way_id * 523) % 12001 - 6000, 0), 199999) AS y2
  FROM (SELECT s_suppkey AS way_id, s_name AS name, (s_suppkey * 7919 + s_nationkey * 1009) % 200000 AS x1,
               (s_suppkey * 15487 + s_nationkey * 3001) % 200000 AS y1,
               CASE s_suppkey % 10 WHEN 0 THEN 'motorway' WHEN 1 THEN 'primary' WHEN 2 THEN 'residential' WHEN 3 THEN 'service'
                    WHEN 4 THEN 'track' WHEN 5 THEN 'track' WHEN 6 THEN 'busway' WHEN 7 THEN 'path' WHEN 8 THEN 'primary_link' ELSE NULL END AS highway
        FROM supplier))""",
    "units": "units AS (SELECT lower(n_name) AS code, n_nationkey AS unit_id, n_regionkey AS country_id, (n_nationkey % 5) * 40000 AS x0, (n_nationkey // 5) * 40000 AS y0 FROM nation)",
    "places": "places AS (SELECT c_custkey AS place_id, c_name AS name, c_mktsegment AS kind, (c_custkey * 4099) % 200000 AS x, (c_custkey * 7283) % 200000 AS y FROM customer)",
    "water": "water AS (SELECT p_partkey AS water_id, p_size * 100 AS side, (p_partkey * 6151) % 200000 AS x, (p_partkey * 3079) % 200000 AS y FROM part WHERE p_size >= 46)",
    "points": """points AS (
  SELECT event_id, user_id % 25 AS unit_id, CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS scenario,
         CAST(floor(value * 100 + 0.5) AS BIGINT) AS dist_cm, CASE WHEN event_id % 5 = 0 THEN event_id % 997 END AS island,
         (event_id * 7919) % 200000 AS x, (event_id * 15487) % 200000 AS y, (event_id * 7919) % 3600000 - 1800000 AS lon_e4,
         (event_id * 104729) % 1600000 - 800000 AS lat_e4, event_type = 'error' AS excluded, event_type, ts FROM events)""",
    "touched": """boxes AS (SELECT *, unnest(generate_series(least(y1, y2) // 1000, greatest(y1, y2) // 1000)) AS r FROM roads),
 touched AS (SELECT way_id, highway, r AS row, c AS col FROM (SELECT *, unnest(generate_series(least(x1, x2) // 1000, greatest(x1, x2) // 1000)) AS c FROM boxes)
  WHERE least((x2-x1)*(r*1000-y1)-(y2-y1)*(c*1000-x1), (x2-x1)*(r*1000+1000-y1)-(y2-y1)*(c*1000-x1),
              (x2-x1)*(r*1000-y1)-(y2-y1)*(c*1000+1000-x1), (x2-x1)*(r*1000+1000-y1)-(y2-y1)*(c*1000+1000-x1)) <= 0
    AND greatest((x2-x1)*(r*1000-y1)-(y2-y1)*(c*1000-x1), (x2-x1)*(r*1000+1000-y1)-(y2-y1)*(c*1000-x1),
              (x2-x1)*(r*1000-y1)-(y2-y1)*(c*1000+1000-x1), (x2-x1)*(r*1000+1000-y1)-(y2-y1)*(c*1000+1000-x1)) >= 0)""",
    "cells": "cells AS (SELECT r AS row, c AS col FROM (SELECT unnest(generate_series(0, 199)) AS r), (SELECT unnest(generate_series(0, 199)) AS c))",
    "edt": f"""ra AS (SELECT DISTINCT row, col FROM touched WHERE highway IN ({TAGS_A})), rb AS (SELECT DISTINCT row, col FROM touched WHERE highway IN ({TAGS_B})),
 da AS (SELECT c.row, c.col, min((c.row-s.row)*(c.row-s.row)+(c.col-s.col)*(c.col-s.col)) AS d2 FROM cells c, ra s GROUP BY ALL),
 db AS (SELECT c.row, c.col, min((c.row-s.row)*(c.row-s.row)+(c.col-s.col)*(c.col-s.col)) AS d2 FROM cells c, rb s GROUP BY ALL)""",
    "water_cells": """water_rows AS (SELECT x, side, unnest(generate_series((y + 499) // 1000, (y + side + 499) // 1000 - 1)) AS row FROM water WHERE side >= 4800),
 water_cells AS (SELECT DISTINCT row, col FROM (SELECT row, unnest(generate_series((x + 499) // 1000, (x + side + 499) // 1000 - 1)) AS col FROM water_rows) WHERE row < 200 AND col < 200)""",
    "ranked": """ranked AS (SELECT *, row_number() OVER (PARTITION BY scenario, unit_id ORDER BY dist_cm DESC, event_id) AS rank FROM points),
 kept AS (SELECT * EXCLUDE (rank), rank AS old_rank, row_number() OVER (PARTITION BY scenario, unit_id ORDER BY rank) AS rank FROM ranked WHERE NOT excluded)""",
}
NEEDS = {"touched": ["roads"], "edt": ["touched", "cells"], "water_cells": ["water"], "ranked": ["points"]}


def with_views(names: str, body: str, recursive: bool = False) -> str:
    """body with the named views, and those that they need, before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n ".join(VIEWS[n] for n in order) + "\n" + body
