"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "opinionlake", cores: int | str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect.

    On a cluster only the SQL settings matter: master, memory and
    ``spark.checkpoint.dir`` come from spark-submit and are left alone.  ``cores``
    asks for a local session (tests, bench).
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.driver.memory", os.environ.get("OPINIONLAKE_DRIVER_MEMORY", "12g"))
            .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, below the shared folder the cluster names.

    That is ``spark.checkpoint.dir``.  Only a session inside one process, which
    shares every folder with itself, gets a setting of its own where it is unset.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith(("local[", "local,")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = "file:/tmp/checkpoints"
    return f"{shared.rstrip('/')}/opinionlake/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once below the shared folder, and read from there."""
    path = scratch_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
