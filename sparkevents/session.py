"""Session defaults and the scratch location shared by all executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # the JVM never compiles a longer method; Spark then cuts the expressions of a step into shorter ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str = "*", app: str = "sparkevents", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
    )
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """All calendar rules (daily files, chunk names) are in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def compiled_methods(spark: SparkSession) -> None:
    """Generated methods that the JVM would only interpret are not used, whatever session is given."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(DEFAULTS[name]):
        spark.conf.set(name, DEFAULTS[name])


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session, once."""
    context = spark.sparkContext
    if getattr(context, "_sparkevents_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="sparkevents-"), "sparkevents"), "zip", os.path.dirname(root), "sparkevents"
    )
    context.addPyFile(archive)
    context._sparkevents_shipped = True


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sparkevents-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, empty path below the cluster's shared folder.

    The folder is the one named by ``spark.checkpoint.dir``. Only a local-mode session, where driver and tasks
    share one disk, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """A table written to the shared folder and read back, so that later plans start from its files."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
