"""What several operators need: whole tables, written intermediate results, words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askframe.sources.storage import remove_read, scratch_path

#: Words are separated by blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns.
BLANKS = r"[\x20\x09-\x0D]+"
ROWS_PER_RUN = 100_000
#: Whether the shuffle files of an execution go when it ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, whatever executors are lost later.
    What was shuffled for it is gone when it is written."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def drop(*frames: DataFrame) -> None:
    """Deletes the tables of ``written`` that these frames read: for when nothing else does."""
    for frame in frames:
        remove_read(frame)


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, some at a time: as many as hold ``most`` bytes in a binary
    column, one at least. What a task makes of a batch is a multiple of its size."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo ``by``; a missing key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(by))


def words(text: Column) -> Column:
    """The words of a text, none where it is null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def count_words(text: Column) -> Column:
    """Their number without building them: one per change from blank to word."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cell(number: Column) -> Column:
    """The histogram cell of a number from 0 on: its number of bits above six, and its
    first six bits. Cells are in order of their numbers, exact up to 63, no wider than
    1/32 of a number beyond, and fewer than 4000."""
    over = F.greatest(F.length(F.bin(number)) - 6, F.lit(0))
    return (over * 64 + F.call_function("shiftright", number, over)).cast("int")


def least_hashed(rows: DataFrame, by: list[str], n: int, total: int) -> DataFrame:
    """The ``n`` rows, of ``total``, with the least hashes of their columns ``by``.

    A first cut by the hash alone leaves about twice as many, so that tasks need not
    each pass on n rows; from 1000 rows on it never leaves fewer than n but by a chance
    that can be ruled out, and smaller samples are not cut.
    """
    hashed = rows.withColumn("_hash", F.shiftrightunsigned(F.xxhash64(*by), 1))
    if n >= 1000 and total > 2 * n:
        hashed = hashed.where(F.col("_hash") < int(2 * n / total * 2**63))
    return hashed.orderBy("_hash", *by).limit(n).drop("_hash")


def numbered(rows: DataFrame, by: str, most: int, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 without gaps within ``by``, as column ``name``.

    A group is cut into runs by a hash of the ``order`` columns, so that no task
    numbers a whole group; ``most`` is the size of the largest. A run's rows follow
    those of the runs before it.
    """
    runs = max(1, -(-most // ROWS_PER_RUN))
    dealt = rows.withColumn("_run", F.pmod(F.xxhash64(*order), F.lit(runs)).cast("int"))
    sizes = dealt.groupBy(by, "_run").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(by).orderBy("_run")) - F.col("_n")
    starts = written(sizes.select(by, "_run", before.alias("_before")), "runs")
    within = F.row_number().over(W.partitionBy(by, "_run").orderBy(*order)) - 1
    joined = dealt.withColumn("_within", within).join(starts, [by, "_run"])
    return joined.withColumn(name, (F.col("_within") + F.col("_before")).cast("long")).drop("_run", "_within", "_before")
