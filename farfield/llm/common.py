"""What the operators of this subpackage share: the folder that all executors see, and word counting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of a batch that goes to or comes from Python, about.
BATCH_BYTES = 8_000_000


def small_batches(spark: SparkSession) -> None:
    """Batches of BATCH_BYTES, where the session has no size of its own: Spark's default holds 64 MB at both ends."""
    name, default = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20
    if spark.conf.get(name) in (f"{default}b", str(default)):
        spark.conf.set(name, str(BATCH_BYTES))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, which driver and executors share. Its folder goes when the session's JVM ends.

    Where the setting is absent, a temporary folder becomes the checkpoint folder within one process (tests); on a
    cluster executors couldn't see it, so that is an error.
    """
    small_batches(spark)
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if sc.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="farfield-"))
        base = sc.getCheckpointDir()
    path = f"{base.rstrip('/')}/farfield-{uuid.uuid4().hex}-{name}"
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
