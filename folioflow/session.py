"""Spark session with the settings that the operators assume."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "folioflow", *, cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session: UTC, adaptive execution, few shuffle partitions.  On a cluster the submitter's settings hold."""
    builder = SparkSession.builder.appName(app)
    if "SPARK_MASTER" not in os.environ:
        cores = cores or os.cpu_count() or 4
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores)).config("spark.driver.memory", "8g")
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
