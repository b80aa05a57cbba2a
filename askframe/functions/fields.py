"""Typed fields out of a request line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t"


def split_line(line: Column) -> tuple[Column, Column]:
    """First word and the rest of the line; the rest is NULL when there is none.

    Outer blanks are dropped and a run of blanks counts as one separator, but
    blanks inside the rest stay as they are.
    """
    # btrim with an explicit set: plain trim() would leave tabs in place.
    parts = F.split(F.btrim(line, F.lit(BLANKS)), f"[{BLANKS}]+", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def whole_number(text: Column) -> Column:
    """Decimal integer as bigint, NULL for anything else."""
    return text.try_cast("bigint")


def next_number(number: Column) -> Column:
    """``number + 1``, NULL where that does not fit a bigint."""
    return F.try_add(number, F.lit(1).cast("bigint"))
