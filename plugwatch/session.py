"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that suit every job here: runtime re-planning with skew splitting.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "plugwatch", cores: str = "*", partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("PLUGWATCH_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _own_folder() -> str:
    """A folder of this process, removed when it ends: executors of a local session are in it."""
    path = tempfile.mkdtemp(prefix="plugwatch-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def work_dir(spark: SparkSession) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/plugwatch-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table read back.

    Cuts the lineage in a way that survives lost executors, unlike a cached frame.
    """
    spark = df.sparkSession
    path = path or work_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores when a scan has fewer partitions than there are cores.

    For small files with much work per row. A scan of many files or row groups is left as
    it is, so large tables are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
