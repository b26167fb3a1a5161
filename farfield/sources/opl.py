"""Objects of a map extract from OPL text, one per line: n, w or r and an id, then fields by their first letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farfield.functions.text import parse_members, parse_tags


def _field(letter: str) -> Column:
    return F.regexp_extract("value", rf"(?:^| ){letter}(\S*)", 1)


def read_opl(spark: SparkSession, path: str) -> DataFrame:
    """kind, id, tags, lon, lat (of nodes), nodes (of ways), members (of relations)."""
    return parse_opl(spark.read.text(path))


def parse_opl(lines: DataFrame) -> DataFrame:
    number = lambda x: F.when(_field(x) != "", _field(x).cast("double"))
    nodes = F.transform(F.filter(F.split(_field("N"), ","), lambda x: x != ""), lambda x: F.regexp_extract(x, r"n(-?\d+)", 1).cast("long"))
    return lines.where(F.col("value").rlike("^[nwr]-?[0-9]")).select(
        F.substring("value", 1, 1).alias("kind"), F.regexp_extract("value", r"^.(-?\d+)", 1).cast("long").alias("id"), parse_tags(_field("T")).alias("tags"),
        number("x").alias("lon"), number("y").alias("lat"), nodes.alias("nodes"), parse_members(_field("M")).alias("members"),
    )


def relations(objects: DataFrame, levels: list[str]) -> DataFrame:
    """Boundaries and multipolygons of the wanted levels."""
    kind = F.col("tags")["type"]
    return objects.where((F.col("kind") == "r") & kind.isin("boundary", "multipolygon") & F.col("tags")["admin_level"].isin(*levels))
