"""Requests as lines of text files, answers as lines of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_requests(spark: SparkSession, path: str, column: str = "line") -> DataFrame:
    """One request per line: ``request_id`` (unique, not consecutive) and ``column``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.monotonically_increasing_id().alias("request_id"), F.col("value").alias(column))


def stream_requests(spark: SparkSession, path: str, column: str = "line") -> DataFrame:
    """One request per line of every file that arrives in a directory."""
    lines = spark.readStream.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").alias(column))


def write_messages(answers: DataFrame, path: str, column: str = "message") -> None:
    """One line per answer that has something to say; order is not kept."""
    said = answers.where(F.col(column).isNotNull()).select(F.col(column).cast("string"))
    said.write.mode("overwrite").option("lineSep", "\n").text(path)
