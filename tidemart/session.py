"""Session settings for local work."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str, cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
