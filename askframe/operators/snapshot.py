"""Dated snapshots: which requests are valid, what the archives are called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askframe.functions.messages import ARCHIVE_SUFFIX, SNAPSHOT_DIR_MISSING, SNAPSHOT_DONE, fill
from askframe.functions.paths import archive_name, base_name, clean_dir
from askframe.operators.presence import check_presence, status_of


def plan_snapshots(
    requests: DataFrame, known: DataFrame, key: str = "dir", day: str = "day", suffix: str = ARCHIVE_SUFFIX
) -> DataFrame:
    """Every request plus ``archive_name`` (NULL if rejected) and ``status``,
    ``planned`` for those that can be fulfilled.

    ``known`` holds the existing directories, or one row per record of them, in
    its column ``key``.
    """
    asked = requests.withColumn("_asked", clean_dir(F.col(key)))
    there = known.select(F.col(key).alias("_asked")).where("_asked != ''")
    known_as = status_of(key)
    status = F.when(F.col(day).isNull(), "no_request").when(known_as == "ok", "planned").otherwise(known_as)
    name = archive_name(base_name(F.col(key)), F.col(day), suffix)
    return check_presence(asked, there, "_asked").select(
        *requests.columns, F.when(status == "planned", name).alias("archive_name"), status.alias("status")
    )


def report_snapshots(
    planned: DataFrame,
    key: str = "dir",
    written: bool = False,
    done_text: str = SNAPSHOT_DONE,
    missing_text: str = SNAPSHOT_DIR_MISSING,
) -> DataFrame:
    """Adds the ``message``. What is planned is ``ok`` and told of only once it is
    ``written``, that is after the write has committed."""
    if written:
        status = F.when(F.col("status") == "planned", "ok").otherwise(F.col("status"))
        planned = planned.withColumn("status", status)
    done = fill(done_text, archive_name=F.col("archive_name"))
    rejected = fill(missing_text, dir=F.col(key))
    message = F.when(F.col("status") == "ok", done).when(F.col("status") == "not_found", rejected)
    return planned.withColumn("message", message)
