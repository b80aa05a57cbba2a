"""Path and name expressions with POSIX basename/dirname results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from askframe.functions.messages import ARCHIVE_SUFFIX, BACKUP_PREFIX


def _unslashed(path: Column) -> Column:
    return F.rtrim(path, F.lit("/"))


def _or_root(bare: Column, path: Column) -> Column:
    """What is left of a path without its slashes, ``/`` if it had nothing else."""
    return F.when((bare == "") & (path != ""), F.lit("/")).otherwise(bare)


def clean_dir(path: Column) -> Column:
    """The path without trailing slashes; the root stays ``/``."""
    return _or_root(_unslashed(path), path)


def base_name(path: Column) -> Column:
    return _or_root(F.substring_index(_unslashed(path), "/", -1), path)


def dir_name(path: Column) -> Column:
    bare = _unslashed(path)
    head = F.left(bare, F.length(bare) - F.length(F.substring_index(bare, "/", -1)))
    return (
        F.when(bare.contains("/"), clean_dir(head))
        .when((bare == "") & (path != ""), F.lit("/"))
        .when(path.isNotNull(), F.lit("."))
    )


def ancestors(path: Column) -> Column:
    """All directories that lead to a path, the nearest last: what ``dir_name`` gives
    again and again, down to ``/`` or ``.``."""
    bare = _unslashed(path)
    ends = F.filter(
        F.sequence(F.lit(1), F.greatest(F.length(bare), F.lit(1))),
        lambda i: (i > 1) & (F.substr(bare, i, F.lit(1)) == "/") & (F.substr(bare, i - 1, F.lit(1)) != "/"),
    )
    inner = F.transform(ends, lambda i: F.substr(bare, F.lit(1), i - 1))
    first = F.when(path.startswith("/"), F.lit("/")).when(path != "", F.lit("."))
    above = F.when(bare != "", F.concat(F.array(first), inner)).when(path != "", F.array(first))
    return F.when(path.isNotNull(), F.coalesce(above, F.array().cast("array<string>")))


def is_hidden(name: Column) -> Column:
    return name.startswith(".")


def day_text(day: Column) -> Column:
    """``YYYY-MM-DD``; by way of a date, so that no time zone can shift it."""
    return day.cast("date").cast("string")


def archive_name(base: Column, day: Column, suffix: str = ARCHIVE_SUFFIX) -> Column:
    return F.concat(base, F.lit("_"), day_text(day), F.lit(suffix))


def backup_name(name: Column, prefix: str = BACKUP_PREFIX) -> Column:
    return F.concat(F.lit(prefix), name)
