"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(name: str = "farelake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library relies on: UTC calendar parts and strict (ANSI) casts.

    Partition counts are left to the cluster's configuration; pass them in ``settings`` where needed.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``, which all executors share.

    Only a local master may go without the setting; it then gets a temporary folder of its own.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="farelake-")
        base = _local_scratch.name
    return f"{_run_folder(spark, base)}/{label}-{uuid.uuid4().hex}"


def _run_folder(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/farelake/{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder. Call it when its results are stored."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark, base))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_PART_BYTES = 256 << 20
_SCRATCH_GROUP_BYTES = 16 << 20  # a writer holds a row group in memory
_UNKNOWN_BYTES = 1 << 50


def sized_partitions(df: DataFrame, bytes_per_part: int = _PART_BYTES) -> int:
    """Partitions for a shuffle of ``df``: about 256 MB each by the size of the tables it reads, and never fewer than
    ``spark.sql.shuffle.partitions``. Where the optimizer knows no size (it then assumes more than any table has), that.

    The estimate of a whole plan is of no use here: it multiplies the sides of a join.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    return least if size >= _UNKNOWN_BYTES else max(least, -(-size // bytes_per_part))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared scratch and return a scan of it; later steps no longer depend on its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").option("compression", "zstd").option("parquet.block.size", _SCRATCH_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
