"""A local session for tests and benchmarks; clusters bring their own."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str | None = None, memory: str = "8g") -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ledgerspark")
    if not SparkSession.getActiveSession():
        # One machine, so its own folder is shared by all; a cluster names a shared one.
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerspark-"))
    spark = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
