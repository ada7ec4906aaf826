"""Spark session settings."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# What the plans count on, on any cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites are not recorded: a large spec builds many thousand columns.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "slotweave", **extra: str) -> SparkSession:
    """The session of a submitted job; master and sizes come from the submit command."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: str | None = None, app: str = "slotweave-local") -> SparkSession:
    """A single-machine session for tests and the bench."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    local = {
        "spark.sql.shuffle.partitions": cores,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
    }
    for key, value in {**SETTINGS, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
