"""Session settings the library is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join side is split even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def local_session(cpus: int | None = None, **more: str) -> SparkSession:
    """A session in this process, for tests and measurements."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (configured(SparkSession.builder.master(f"local[{cpus}]").appName("retally"))
               .config("spark.sql.shuffle.partitions", str(cpus)).config("spark.ui.enabled", "false")
               .config("spark.driver.memory", os.environ.get("RETALLY_DRIVER_MEMORY", "8g"))
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in more.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
