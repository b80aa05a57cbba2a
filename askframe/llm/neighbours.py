"""Approximate nearest neighbours by a permutation index (operator 6).

A vector is represented by its nearest pivots in order. The rows are dealt into
blocks, and each block posts its vectors in one file per pivot, holding how near the
pivot stands in each vector's order (0: not among its nearest). A query goes through
the files of its own pivots: the sum of ``min(near, near')`` over them is, up to a
constant, minus half the footrule distance of the two orders. The candidates with the
least distance, a share of the block and all that are close, are compared with the
query exactly. A block returns its nearest of
every query, and the nearest of all blocks are the answer.

Pivots come from a bounded sample, ``SAMPLE`` rows with the least hashes of their id;
every row is indexed. Within a block equal vectors are one candidate, which stands for
its rows in order of their ids: repeated vectors never crowd out others.

Defined results: vectors that are null, empty or zero, hold null or non-finite
components, or have another length than most take no part, neither do rows without an
id; equal rows count once, rows with a query's id are never its neighbours. Queries
without any candidate have no rows; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askframe.llm.common import least_hashed, written

PIVOTS = 256
POSTED = 128  # pivots in a vector's order; sums of places fit 16 bits
SAMPLE = 4_096
BLOCK = 16_384  # rows of a block
QUERIES = 2_048  # queries that meet a block in one task
CANDIDATES = 0.25  # the share of a block's vectors that are reranked
LEAST = 1_000  # and their number at least
CLOSE = 0.6  # besides them, all whose order agrees with the query's to this share


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Distinct ``vec_id`` and ``v`` (array of doubles) of the rows that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & good)
    return rows.distinct()


def choose_pivots(rows: DataFrame, total: int) -> np.ndarray:
    """Distinct vectors of the sample, in order of the hash of their ids."""
    sample = least_hashed(rows, ["vec_id"], SAMPLE, total).select("v").toPandas()["v"]
    return np.array(list(dict.fromkeys(map(tuple, sample)))[:PIVOTS], dtype=float)


def orders(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The indices of each vector's nearest pivots, nearest first."""
    posted = min(POSTED, max(1, len(pivots) // 2))
    nearness = np.einsum("ij,kj->ik", vectors, pivots, optimize=True)
    return np.argsort(-nearness, axis=1, kind="stable")[:, :posted].astype(np.int16)


def post(order: np.ndarray, pivots: int) -> np.ndarray:
    """The files: for every pivot, how near it is to each vector."""
    posted = order.shape[1]
    files = np.zeros((pivots, len(order)), dtype=np.int16)
    for place in range(posted):
        files[order[:, place], np.arange(len(order))] = posted - place
    return files


def search_block(ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, queries: pd.DataFrame, pivots: int, k: int) -> Iterator[tuple]:
    """(query, vec_id, score) of the nearest rows of one block."""
    _, first, member = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    by_class = np.lexsort([ids, member.ravel()])
    starts = np.searchsorted(member.ravel()[by_class], np.arange(len(first) + 1))
    distinct, files = vectors[first], post(order[first], pivots)
    wanted = min(len(first), max(LEAST, int(CANDIDATES * len(first))))
    posted = order.shape[1]
    full = posted * (posted + 1) / 2
    for query, q, own in zip(queries["vec_id"], queries["v"], queries["pivots"]):
        if wanted < len(first):
            near, step = np.zeros(len(first), dtype=np.int16), np.empty(len(first), dtype=np.int16)
            for place, pivot in enumerate(own):
                near += np.minimum(files[pivot], np.int16(posted - place), out=step)
            # Of a crowd of like vectors none is left out, however many they are.
            cut = min(np.partition(near, len(near) - wanted)[len(near) - wanted], CLOSE * full)
            chosen = np.nonzero(near >= cut)[0]
        else:
            chosen = np.arange(len(first))
        q = np.asarray(q)
        if len(chosen) > k + 1:  # one more: the query itself may be among them
            scores = distinct[chosen] @ q
            cut = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
            chosen = chosen[scores >= cut - 1e-9 * max(1.0, abs(cut))]
        # Summed in one way wherever a vector lies, so that equal vectors have equal scores.
        scores = (distinct[chosen] * q[None, :]).sum(axis=1)
        found = []
        for c, score in zip(chosen, scores):
            rows = ids[by_class[starts[c] : starts[c + 1]]]
            found += [(-score, int(i)) for i in rows[: k + 1] if i != query]
        for negative, i in sorted(found)[:k]:
            yield int(query), i, float(-negative)


def nearest(vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of every query's k nearest found.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).collect()
    length, total = (sizes[0]["n"], sizes[0]["rows"]) if sizes else (0, 0)
    rows = written(rows.where(F.size("v") == length), "vectors")
    pivots = choose_pivots(rows, total).reshape(-1, max(length, 1))
    shared, count = spark.sparkContext.broadcast(pivots), len(pivots)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
            if batch.num_rows:
                found = orders(v, shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(found), pa.list_(pa.int16()))], ["vec_id", "v", "pivots"])

    indexed = written(rows.mapInArrow(index, "vec_id long, v array<double>, pivots array<short>"), "index")
    asked = indexed.where(is_query)
    blocks = max(1, -(-total // BLOCK))
    groups = max(1, -(-asked.count() // QUERIES))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int")
    data = indexed.withColumn("block", part).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("group", group).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def cell(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(queries):
            v, order = np.stack(data["v"].to_numpy()), np.stack(data["pivots"].to_numpy())
            found = list(search_block(data["vec_id"].to_numpy(), v, order, queries, count, k))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    both = data.groupBy("block", "group").cogroup(asked.groupBy("block", "group"))
    found = both.applyInPandas(cell, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
