"""Newline counting on a string column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def newline_count(text: Column) -> Column:
    """Number of newline characters; an unterminated last line does not count.

    Byte lengths are stored with the value, so this costs one pass over the
    text, where length() would decode it twice more.
    """
    without = F.replace(text, F.lit("\n"), F.lit(""))
    return (F.octet_length(text) - F.octet_length(without)).cast("bigint")
