"""Which requested keys exist in a table of known ones.

Sizes are measured before anything is broadcast. Beyond the bound, keys held by
so many rows that they would fill one task are taken out and joined on their own;
arithmetic bounds how many such keys there can be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
FEW_KEYS = 64
HOT_SHARE = 1_000  # a key is hot with more than 1/1000 of the rows: at most 999 are
TRACKED = 10_000  # items in the sketch that finds them
SALTS = 64  # tasks over which the rows of one hot key are dealt


def fits_broadcast(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measures a table against the broadcast bounds; one row per task leaves its task."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(0))
    seen = table.select(width.alias("width")).agg(F.count("*"), F.sum("width")).first()
    return seen[0] <= rows and (seen[1] or 0) <= size


def lookup(left: DataFrame, right: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """Left join on a ``key`` that is unique on the right and may be hot on the left.

    ``small`` tells whether the right side is known to be bounded; None measures it.
    """
    if small is None:
        small = fits_broadcast(right)
    if small:
        return left.join(F.broadcast(right), key, "left")
    # Adaptive execution splits skewed partitions only between two plain
    # exchanges, and a right side that comes out of an aggregation is none.
    # So rows of hot keys, and rows without a key, which match nothing, are dealt
    # out by a salt as well, and the few hot rows on the right go to every salt.
    salt, is_hot = unused("salt", left, right), unused("hot", left, right)
    keys = left.sparkSession.createDataFrame([(k,) for k in hot_keys(left, key)], left.select(key).schema)
    hot = F.broadcast(keys.withColumn(is_hot, F.lit(True)))
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in left.columns]), F.lit(SALTS)).cast("int")
    salted = left.join(hot, key, "left").withColumn(salt, F.when(F.col(is_hot) | F.col(key).isNull(), spread).otherwise(0)).drop(is_hot)
    salts = F.when(F.col(is_hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = right.join(hot, key, "left").withColumn(salt, F.explode(salts)).drop(is_hot)
    return salted.join(copies, [key, salt], "left").drop(salt)


def unused(name: str, *tables: DataFrame) -> str:
    """The name of a column for a while, none that the tables have; case does not tell names apart."""
    taken = {c.lower() for table in tables for c in table.columns}
    while name in taken:
        name = f"_{name}"
    return name


def hot_keys(table: DataFrame, key: str) -> list:
    """The keys held by more than 1/HOT_SHARE of the rows, from one aggregation.

    The sketch behind it errs on the side of more keys; it never misses one, as it
    tracks far more items than there can be hot keys.
    """
    tracked = table.select(key).agg(F.count("*").alias("total"), F.expr(f"approx_top_k(`{key}`, {HOT_SHARE}, {TRACKED})").alias("top"))
    row = tracked.first()
    return [item["item"] for item in row["top"] or [] if item["item"] is not None and item["count"] > row["total"] / HOT_SHARE]


def mark_present(
    left: DataFrame, keys: DataFrame, key: str, flag: str = "present", small: bool | None = None
) -> DataFrame:
    """``left`` plus a boolean: is its ``key`` one of the (distinct) ``keys``?"""
    joined = lookup(left, keys.select(key, F.lit(True).alias(flag)), key, small)
    return joined.select(*left.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def distinct_keys(table: DataFrame, key: str) -> DataFrame:
    return table.select(key).where(F.col(key).isNotNull()).distinct()


def check_presence(requests: DataFrame, known: DataFrame, key: str, flag: str = "present") -> DataFrame:
    """Every request plus a boolean: does its ``key`` occur in ``known``?

    ``known`` may be huge and repeat its keys at will: it is filtered by the
    requested keys while there are not too many of those, and each key crosses
    the shuffle once per task that saw it.
    """
    wanted = distinct_keys(requests, key)
    values = few_keys(wanted, key)
    small = values is not None or fits_broadcast(wanted)
    if values is not None:
        found = distinct_keys(known.where(F.col(key).isin(values)), key)
    elif small:
        found = known.select(key).join(F.broadcast(wanted), key, "left_semi").distinct()
    else:
        found = distinct_keys(known, key).join(wanted, key, "left_semi")
    return mark_present(requests, found, key, flag, small)


def keep_wanted(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is one of the (distinct) ``wanted``."""
    values = few_keys(wanted, key)
    if values is not None:
        return table.where(F.col(key).isin(values))
    return mark_present(table, wanted, key, "_wanted").where("_wanted").drop("_wanted")


def few_keys(keys: DataFrame, key: str) -> list | None:
    """The keys themselves if there are few: as constants they reach the scan."""
    rows = keys.select(key).limit(FEW_KEYS + 1).collect()
    return [row[0] for row in rows] if len(rows) <= FEW_KEYS else None


def present(requests: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Requests whose key is known."""
    return check_presence(requests, known, key, "_present").where("_present").drop("_present")


def missing(requests: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Requests whose key is not known, those without a key among them."""
    return check_presence(requests, known, key, "_present").where("not _present").drop("_present")


def status_of(asked: str, flag: str = "present"):
    """``ok``, ``not_found``, or ``no_request`` where nothing was asked."""
    return F.when(F.col(asked).isNull(), "no_request").when(F.col(flag), "ok").otherwise("not_found")
