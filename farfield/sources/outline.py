"""Outlines of extracts: text files of named sections, each a ring, those with a leading "!" cut out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_outline(spark: SparkSession, path: str) -> DataFrame:
    """ring, hole, seq, x, y. A file is one text, so its lines keep their order."""
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split("value", "\r?\n")).alias("n", "line")).withColumn("line", F.trim("line"))
    return parse_outline(lines)


def parse_outline(lines: DataFrame) -> DataFrame:
    """lines: n (0 is the name), line."""
    return parse_outlines(lines.withColumn("_file", F.lit(0)), ["_file"]).drop("_file")


def parse_outlines(lines: DataFrame, keys: list[str]) -> DataFrame:
    """The same of many outlines, told apart by keys (an outline has some hundred lines)."""
    rows = lines.where("n > 0 and trim(line) <> ''").withColumn("line", F.trim("line")).withColumn("point", F.col("line").rlike(r"^[-+0-9.eE]+\s+[-+0-9.eE]+$"))
    rows = rows.withColumn("ring", F.sum(F.when(~F.col("point") & (F.col("line") != "END"), 1).otherwise(0)).over(Window.partitionBy(*keys).orderBy("n")))
    rows = rows.withColumn("hole", F.max(F.when(~F.col("point"), F.col("line").startswith("!"))).over(Window.partitionBy(*keys, "ring")))
    parts = F.split("line", r"\s+")
    points = rows.where("point").select(*keys, "ring", "hole", "n", F.get(parts, F.lit(0)).cast("double").alias("x"), F.get(parts, F.lit(1)).cast("double").alias("y"))
    return points.withColumn("seq", F.row_number().over(Window.partitionBy(*keys, "ring").orderBy("n")) - 1).drop("n")
