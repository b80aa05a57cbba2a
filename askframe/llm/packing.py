"""Packing by optimal length buckets (operator 5).

Lengths are counted in one global histogram whose cells are exact up to 64 and no
wider than 1/32 of a length beyond, so that it has under 2000 cells whatever the
corpus. Dynamic programming over the cells finds the bucket boundaries that minimise
padding if every row is padded to its bucket's longest. Inside a bucket rows are
numbered without gaps, and each run of as many as the token budget admits is a batch.

Defined results: null lengths count 0; rows longer than the budget, and never parts
of them, have a batch of their own; rows of length 0 are padded to one token; equal
rows are rows of their own; no rows give no rows. Columns of the input that are
named like the new ones are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askframe.llm.common import cell, numbered

BUCKETS = 16
BUDGET = 16_384
NEW = ["n_tokens", "bucket", "pad_to", "batch", "slot"]


def boundaries(counts: np.ndarray, longest: np.ndarray, buckets: int) -> list[int]:
    """The last cell of every bucket, cells being sorted by length.

    ``best[j]`` is the least padded size of the first j cells; a bucket from cell i
    to j costs its rows times its longest row.
    """
    upto = np.concatenate([[0], np.cumsum(counts)]).astype(float)
    widths = np.maximum(longest, 1).astype(float)
    n = len(counts)
    best = np.concatenate([[0.0], np.full(n, np.inf)])
    choices = []
    ends = np.arange(1, n + 1)
    for _ in range(min(buckets, n)):
        cost = best[None, :n] + widths[:, None] * (upto[ends, None] - upto[None, :n])
        cost[np.arange(n)[None, :] >= ends[:, None]] = np.inf
        choice = cost.argmin(axis=1)
        choices.append(choice)
        best = np.concatenate([[np.inf], cost[np.arange(n), choice]])
    # best[n] after k rounds is for exactly k buckets; as costs only fall, the last is least.
    last, found = n, []
    for choice in reversed(choices):
        found.append(last - 1)
        last = int(choice[last - 1])
    return found[::-1]


def pack(docs: DataFrame, length: Column, key: str = "doc_id", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Every row plus ``n_tokens``, ``bucket`` (from 0), ``pad_to``, ``batch`` (within the
    bucket, from 0) and ``slot`` (within the batch, from 0)."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in NEW]
    rows = docs.select(*kept, F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"))
    by_cell = rows.groupBy(cell(F.col("n_tokens")).alias("cell"))
    cells = by_cell.agg(F.count("*").alias("n"), F.max("n_tokens").alias("longest")).sort("cell").toPandas()
    ends = boundaries(cells["n"].to_numpy(), cells["longest"].to_numpy(), buckets)
    sizes = np.diff(np.concatenate([[0], cells["n"].cumsum().to_numpy()[ends]])) if len(cells) else []
    facts = [(bucket, int(cells["longest"][end])) for bucket, end in enumerate(ends)]
    # Lengths of a bucket lie above the bucket before: at most as many comparisons a row as buckets.
    bucket = sum(((F.col("n_tokens") > longest).cast("int") for _, longest in facts[:-1]), F.lit(0))
    widths = F.array(*[F.lit(max(1, longest)).cast("long") for _, longest in facts]) if facts else F.array(F.lit(1).cast("long"))
    placed = rows.withColumn("bucket", bucket).withColumn("pad_to", F.element_at(widths, F.col("bucket") + 1))
    numbered_rows = numbered(placed, "bucket", int(max(sizes, default=0)), [key, "n_tokens"], "_at")
    at = F.col("_at")
    admits = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("pad_to"))).cast("long")
    batch = F.floor(at / admits).cast("long")
    return numbered_rows.select(*kept, "n_tokens", "bucket", "pad_to", batch.alias("batch"), (at % admits).cast("int").alias("slot"))
