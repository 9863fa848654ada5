"""Session construction and the settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings that results depend on. ANSI stays on: operators use try_* where input may be bad.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
}

#: Settings that only change speed.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def local_session(cores: int | str = 8, *, app: str = "quillmesh", memory: str = "12g", partitions: int = 8) -> SparkSession:
    """A session in one JVM, for tests and the bench. On a cluster the caller brings its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUILLMESH_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
