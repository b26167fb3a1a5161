"""Files: digests, checksums beside them, and JSON read with its shape enforced."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def digests(spark: SparkSession, path: str) -> DataFrame:
    """path, size, md5, sha256 of each file; a file is one row, read once."""
    rows = spark.read.format("binaryFile").load(path)
    return rows.select("path", F.col("length").alias("size"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON documents; any that doesn't fit the schema is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All frames as one; the schema is the union of their columns."""
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def changed_stamps(old: DataFrame, new: DataFrame, key: str = "path") -> DataFrame:
    """Keys whose size or time differ between two listings, or that only one has."""
    o, n = old.select(key, F.struct("size", "mtime").alias("o")), new.select(key, F.struct("size", "mtime").alias("n"))
    return o.join(n, key, "full_outer").where(~F.col("o").eqNullSafe(F.col("n"))).select(key)
