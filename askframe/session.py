"""A session for benchmarks and tests; on a cluster the operators take yours."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cores: int = 8, memory: str = "8g", name: str = "askframe", shared: str | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
