"""Session settings and the shared folder jobs write intermediate tables to."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Rows a table known on the driver may have and still be hinted for broadcast.
MAX_BROADCAST_ROWS = 10_000


def build_session(master: str | None = None, app: str = "cohortmill", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    A local master without the setting gets a fresh temporary folder; a cluster
    without it is an error, because a machine-local folder would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="cohortmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/cohortmill/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_default_system(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the default file system, as Spark resolves it; local paths stay plain."""
    if "://" in path:
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if default.startswith("file:"):
        return path.removeprefix("file:")
    return default.rstrip("/") + (path if path.startswith("/") else f"/{path}")


def worker_partitions(spark: SparkSession) -> int:
    """Partitions for work whose cost its bytes do not show, such as calls and listings.

    Passed to ``repartition`` as a number, which adaptive execution leaves alone; it
    would merge partitions that look small.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def send_package_by_value() -> None:
    """Let workers that lack this package run its functions, by pickling them whole."""
    cloudpickle.register_pickle_by_value(sys.modules["cohortmill"])
