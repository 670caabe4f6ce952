"""Session settings the plans are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide at first, for tables of many TB; adaptive execution merges what is small.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Semi joins with repeated groups: the filter is built from up to 512 MB of hashes and used on scans of 1 GB or more.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "512m",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "16000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "268435456",
}


def local_session(cores: int | str | None = None) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass SETTINGS to its own."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ledgerlens")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
