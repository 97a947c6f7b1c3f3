"""Spark session settings shared by the bench, the tests and interactive use."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | None = None, app: str = "tidemark", **extra: str) -> SparkSession:
    """A local session. On a cluster, submit with cluster settings and use ``getOrCreate``."""
    cpus = cpus or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for streaming state and materialised tables.

    The cluster names it in ``spark.checkpoint.dir``. Only when that is unset (tests,
    a laptop) is a fresh local folder made and recorded in the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    made = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", made)
    spark.sparkContext.setCheckpointDir(made)
    return made


def materialise(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, for a small result read several times.

    A reliable checkpoint: it survives the loss of executors, and later steps read it
    instead of going back to the raw rows.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
