"""Session and table helpers shared by queries, tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ionloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("IONLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables; Spark's reader opens it, wherever it lies."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
