"""Sharding by vector bin packing (operator 8).

Bytes, tokens and rows are balanced jointly. Rows are gathered into a bounded number
of items: every group of equal texts that holds a noticeable part of a shard in any
of the three measures is an item of its own, or several if it is over ``WHOLE`` of a shard
(so a text that a third of all rows share is spread, be they repeated rows: the rows
are dealt out by task and place in it, not by their values), and all other groups are pooled
by the hash of their text. The items, of a number bounded by ``FINE``, the shards and
the pools, are placed one after another, the largest first, on the
shard where the dot product of item and residual capacity is highest. Places travel
back to the rows as a broadcast table of that bounded size.

Defined results: a null text has no bytes and no tokens and groups with the empty
text; repeated rows are rows of their own; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askframe.llm.common import count_words, numbered, written

SHARDS = 24
FINE = 256  # a group is placed on its own from 1/FINE of a shard on
WHOLE = 1 / 4  # and split from this share of a shard on
PIECES = 16  # into so many pieces per shard that it fills
POOLS_PER_SHARD = 512
MEASURES = ("size", "tokens", "rows")


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every item; items are rows of measures.

    Capacities are equal shares of the totals. Where an item fits nowhere the dot
    product still leads to the shard with most room for it.
    """
    totals = items.sum(axis=0)
    parts = items * (shards / np.where(totals > 0, totals, 1))
    residual = np.ones((shards, items.shape[1]))
    chosen = np.zeros(len(items), dtype=np.int32)
    for i in np.argsort(-parts.max(axis=1, initial=0), kind="stable"):
        chosen[i] = np.argmax(residual @ parts[i])
        residual[chosen[i]] -= parts[i]
    return chosen


def shard(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``size``, ``tokens``, ``text_crc32``, ``shard`` and ``slot`` of every row."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    crc = F.crc32(body.cast("binary"))
    size = (F.octet_length(body) + 8).cast("long")
    rows = docs.select(F.col(key).alias("key"), size.alias("size"), count_words(body).alias("tokens"), crc.alias("crc"), F.xxhash64(body).alias("mark"))
    # Equal rows are told apart by a number that is written, as it may not change later.
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    totals = rows.agg(*sums).first()
    share = F.greatest(*[(F.col(m) * (shards / totals[m])) if totals[m] else F.lit(0.0) for m in MEASURES])
    pieces = F.when(share <= WHOLE, 1).otherwise(F.ceil(share * PIECES)).cast("int")
    groups = rows.groupBy("mark", "crc").agg(*sums).withColumn("parts", pieces)
    # At most 3 * shards * FINE groups have such a share in one of the measures.
    large = groups.where(share >= 1 / FINE).select("mark", "crc", "parts").sort("mark", "crc").toPandas()
    pools = shards * POOLS_PER_SHARD
    large["base"] = pools + large["parts"].cumsum() - large["parts"]
    known = spark.createDataFrame(list(large.astype("int64").itertuples(index=False, name=None)), "mark long, crc long, parts long, base long")
    marked = rows.join(F.broadcast(known), ["mark", "crc"], "left")
    part = F.col("base") + F.pmod(F.xxhash64("row"), F.col("parts"))
    rows = marked.select("key", "size", "tokens", "crc", F.coalesce(part, F.pmod("mark", F.lit(pools))).alias("item"))
    items = rows.groupBy("item").agg(*sums).sort("item").toPandas()
    items["shard"] = place(items[list(MEASURES)].to_numpy(dtype=float), shards)
    places = spark.createDataFrame(list(items[["item", "shard"]].astype("int64").itertuples(index=False, name=None)), "item long, shard int")
    placed = rows.join(F.broadcast(places), "item")
    placed = numbered(placed, "shard", int(items.groupby("shard")["rows"].sum().max()) if len(items) else 0, ["key", "crc", "size"], "slot")
    return placed.select(F.col("key").alias(key), "size", "tokens", F.col("crc").alias("text_crc32"), "shard", "slot")
