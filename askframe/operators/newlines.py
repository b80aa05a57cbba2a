"""Newline counts per row and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askframe.functions.lines import newline_count


def count_newlines(table: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The ``keep`` columns plus ``newline_count``: a projection, no shuffle."""
    return table.select(*keep, newline_count(F.col(text)).alias("newline_count"))


def total_newlines(table: DataFrame, *by: str, text: str = "text") -> DataFrame:
    """Sum of the newline counts per group, or over everything.

    The sums are partial before the shuffle, so a group of any size costs one
    row per task.
    """
    counted = count_newlines(table, *by, text=text)
    return counted.groupBy(*by).agg(F.coalesce(F.sum("newline_count"), F.lit(0)).alias("newline_count"))
