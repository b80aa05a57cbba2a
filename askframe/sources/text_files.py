"""Exact newline counts of files of any size.

Two ways, one result. The text reader splits large files and stays in the JVM,
but passes over some names and unpacks others; those files are counted in byte
ranges. A file of any size is spread over many tasks either way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askframe.operators.presence import distinct_keys, fits_broadcast, keep_wanted, lookup
from askframe.sources.manifest import files, list_tree, local_path, open_storage
from askframe.sources.storage import full_path, literal_path, path_exists, scratch_path, task_count

# Endings by which the text reader recognises compressed files.
PACKED = [".bz2", ".deflate", ".gz", ".lz4", ".snappy", ".zst"]
RANGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
RANGES_PER_TASK = 16
# Paths the text reader passes over or cannot open: hidden names, copies under way,
# names with a colon, names in percent form.
PASSED_OVER = r"/[._]|\._COPYING_(/|$)|:|//"


def plain_path(file_path: Column) -> Column:
    """``_metadata.file_path`` as manifests write it: decoded, ``file:/x``."""
    # A plus sign is not encoded there, but url_decode would make it a blank.
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def count_by_lines(spark: SparkSession, root: str) -> DataFrame:
    """``path, newline_count`` of the non-empty files the text reader takes as they are.

    Records are lines, of which the last may lack its newline. Adding one byte
    to every record tells: the sum is the file size if no newline is lacking, one
    more if one is; and three less in either case if the reader dropped a byte
    order mark. These four values differ.
    """
    scheme = re.match("[a-z0-9+.-]+:(//[^/]*)?", full_path(spark, root))[0]
    behind = F.substr("file_path", F.lit(len(scheme) + 1))
    lines = (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .text(literal_path(root))
        .select("_metadata.file_path", "_metadata.file_size", (F.octet_length("value") + 1).alias("bytes"))
        # Constant per file, so these files are not even opened; but tested again for every line.
        .where(~_is_packed(F.col("file_path")) & ~behind.contains(":") & ~behind.contains("%3A"))
    )
    surplus = F.sum("bytes") - F.col("file_size")
    return (
        lines.groupBy("file_path", "file_size")
        .agg((F.count("*") - surplus.isin(1, -2).cast("bigint")).alias("newline_count"))
        .select(plain_path(F.col("file_path")).alias("path"), "newline_count")
    )


def count_by_ranges(manifest: DataFrame) -> DataFrame:
    """``path, newline_count`` of any files, read as raw bytes in ranges.

    Tasks are as many as the bytes ask for. A file that cannot be read has NULL.
    """
    many = manifest.agg(F.sum(F.ceil(F.greatest("length", F.lit(1)) / RANGE_BYTES))).first()[0] or 0
    starts = F.sequence(F.lit(0), F.greatest("length", F.lit(1)) - 1, F.lit(RANGE_BYTES).cast("bigint"))
    ranges = manifest.select("path", F.explode(starts).alias("start"))
    spread = ranges.repartition(task_count(manifest.sparkSession, int(many), RANGES_PER_TASK), "path", "start")
    counted = spread.mapInPandas(_count_ranges, "path string, newline_count bigint")
    whole = F.count("newline_count") == F.count("*")
    return counted.groupBy("path").agg(F.when(whole, F.sum("newline_count")).alias("newline_count"))


def count_files(spark: SparkSession, root: str, manifest: DataFrame | None = None, raw: bool = False) -> DataFrame:
    """``path, newline_count`` of every regular file below a directory.

    The listing is an argument where there already is one. ``raw`` counts all files
    in byte ranges: for lines too long to be held as one value.
    """
    found = files(list_tree(spark, root) if manifest is None else manifest).select("path", "name", "length")
    if raw:
        return count_by_ranges(found)
    if not path_exists(spark, root):  # the listing says so
        return count_by_ranges(found)
    inside = F.substr("path", F.lit(len(full_path(spark, root).rstrip("/")) + 1))
    apart = inside.rlike(PASSED_OVER) | _is_packed(F.col("name"))
    # Paths are unique on both sides; an empty file has no lines to join.
    read = found.where(~apart).join(count_by_lines(spark, root), "path", "left")
    return _with_ranges(read, found.where(apart))


def _with_ranges(read: DataFrame, apart: DataFrame) -> DataFrame:
    """Counts of the text reader; files apart, and those with bytes that it did not
    return, are counted in ranges. Only an empty file has 0 newlines unread."""
    scratch = scratch_path(read.sparkSession, "counts")
    read.select("path", "length", F.when(F.col("length") == 0, 0).otherwise(F.col("newline_count")).cast("bigint").alias("newline_count")).write.parquet(scratch)
    read = read.sparkSession.read.schema("path string, length bigint, newline_count bigint").parquet(scratch)
    apart = apart.select("path", "length").unionByName(read.where("newline_count is null").drop("newline_count"))
    return read.where("newline_count is not null").select("path", "newline_count").unionByName(count_by_ranges(apart))


def answer_line_counts(requests: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Every request plus ``newline_count`` and ``status``.

    Only requested files are read, each once. A directory is not a file; an entry
    that is neither is ``no_file``, a file that cannot be read ``unreadable``.
    """
    wanted = distinct_keys(requests, path).withColumnRenamed(path, "path")
    asked = keep_wanted(manifest.select("path", "kind", "length"), wanted, "path").where("kind in ('file', 'other')")
    counts = count_by_ranges(files(asked)).withColumn("found", F.when(F.col("newline_count").isNull(), "unreadable").otherwise("ok"))
    others = asked.where("kind = 'other'").select("path", F.lit(None).cast("bigint").alias("newline_count"), F.lit("no_file").alias("found"))
    known = counts.unionByName(others).withColumnRenamed("path", path)
    answered = lookup(requests, known, path, small=fits_broadcast(wanted))
    status = F.when(F.col(path).isNull(), "no_request").otherwise(F.coalesce("found", F.lit("not_found")))
    return answered.select(*requests.columns, "newline_count", status.alias("status"))


def _is_packed(name: Column) -> Column:
    tests = [name.endswith(ending) for ending in PACKED]
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def _count_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for ranges in batches:
        yield pd.DataFrame(
            {
                "path": ranges["path"],
                "newline_count": pd.array([_count_range(p, s) for p, s in zip(ranges["path"], ranges["start"])], dtype="Int64"),
            }
        )


def _count_range(path: str, start: int) -> int | None:
    count, left = 0, RANGE_BYTES
    try:
        with _opened(path) as file:
            file.seek(start)
            while left and (chunk := file.read(min(READ_BYTES, left))):
                count += chunk.count(b"\n")
                left -= len(chunk)
    except (FileNotFoundError, PermissionError):
        return None
    return count


def _opened(path: str):
    if path.startswith("file:"):
        return open(local_path(path), "rb")
    storage, inner = open_storage(path)
    return storage.open_input_file(inner)
