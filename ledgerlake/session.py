"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs the plan one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle files go when their query ends, not when the driver happens to collect its garbage: a
    # build of many queries otherwise keeps those of all of them.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

STARTUP_SETTINGS = {
    "spark.ui.enabled": "false",
    # Recording the Python call site of every column costs more than building the column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every model relies on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlake")
        .config(map=STARTUP_SETTINGS)
        .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder on storage that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="ledgerlake-")
    return f"{shared.rstrip('/')}/ledgerlake/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str, spark: SparkSession | None = None, compression: str = "snappy") -> DataFrame:
    """Cut the lineage of ``df``: write it once to ``path`` (see ``work_dir``), read it back.

    Unlike a cache the written copy survives the loss of any executor. The caller removes
    it when done. ``spark`` is the session to read with, by default that of ``df``.
    """
    df.write.option("compression", compression).parquet(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have Spark drop the broadcasts and plans of queries that are done.

    Its cleaner follows the garbage collection of the driver. Many queries in a row fill the heap with what
    is no longer used before a collection finds it; Spark itself asks for one every half hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def observed(seen: Observation, default: dict) -> dict:
    """What was observed during a write; ``default`` where its plan turned out to be empty."""
    try:
        return seen.get
    except Py4JJavaError:
        return default
