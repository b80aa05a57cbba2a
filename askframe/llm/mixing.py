"""Mixing sources to target weights by hash thresholds (operator 7, native).

Every row has a hash of its key; a source gives the rows whose hash lies below its
threshold once more than the others. The thresholds come from nested histograms:
sizes are summed by source and hash bucket, the bucket in which a source's budget
ends is cut again, and so on until it holds a single hash. No rows are sorted, and
every pass but the first reads only rows of such boundary buckets.

Defined results: a null key hashes as empty text, so do repeated keys alike, which
are taken together; a null source is a source of its own, last in order; sizes that
are null count 0; a source of size 0 has target 0; no rows give no rows. Columns of
the input that are named like the new ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askframe.llm.common import written
from askframe.operators.presence import lookup

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # the mix holds 3/2 of all sizes
MOST = 2  # and no row more often than this
LEVEL_BITS = 12
LEVELS = 5  # 5 * 12 bits: all of the hash
KEY, HASH, SIZE = "_mix_source", "_mix_hash", "_mix_size"


def hash_of(key: Column) -> Column:
    """60 bits of the key's md5."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(rows: DataFrame, weights: tuple = WEIGHTS, share: tuple = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: its size and target. Sources, not rows, pass one task.

    What is over a source's limit is dealt to the others by weight until none is
    above. In order of size by weight the sources that end at their limit come
    first, and whether one does depends only on those before it.
    """
    sources = rows.groupBy(KEY, "_mix_null").agg(F.sum(SIZE).alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_mix_rank") - 1) % len(weights) + 1)
    ranked = sources.withColumn("_mix_rank", F.row_number().over(W.orderBy("_mix_null", KEY)))
    ranked = ranked.withColumns({"_mix_weight": weight.cast("long"), "_mix_limit": F.col("source_size") * most})
    by_ratio = W.orderBy(F.col("source_size") / F.col("_mix_weight"), "_mix_rank")
    up, down = share
    total = F.sum("source_size").over(W.partitionBy()) * up
    before = F.coalesce(F.sum("_mix_limit").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) * down
    rest = F.sum("_mix_weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)) * down
    full = ranked.withColumn("_mix_full", F.col("_mix_limit") * rest <= F.col("_mix_weight") * (total - before))
    given = F.sum(F.when(F.col("_mix_full"), F.col("_mix_limit")).otherwise(0)).over(W.partitionBy()) * down
    open_weight = F.sum(F.when(F.col("_mix_full"), 0).otherwise(F.col("_mix_weight"))).over(W.partitionBy()) * down
    offered = (F.col("_mix_weight") * (total - given)).cast("double") / open_weight.cast("double")
    target = F.when(F.col("_mix_full"), F.col("_mix_limit").cast("double")).otherwise(offered)
    return full.select(KEY, "source_size", target.alias("target"))


def thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` plus how often each row is taken at least, and up to which hash once more."""
    base = F.when(F.col("target") >= 2 * F.col("source_size"), 2).when(F.col("target") >= F.col("source_size"), 1).otherwise(0)
    sources = sources.withColumn("_mix_base", base)
    budget = (F.col("target") - F.col("_mix_base") * F.col("source_size")).alias("_mix_budget")
    state = sources.select(KEY, budget, F.lit(0).cast("long").alias("_mix_before"))
    inside = rows.select(KEY, HASH, SIZE)
    for level in range(LEVELS):
        bucket = F.shiftright(HASH, LEVEL_BITS * (LEVELS - 1 - level))
        histogram = inside.groupBy(KEY, bucket.alias("_mix_bucket")).agg(F.sum(SIZE).alias("_mix_sum"))
        upto = F.col("_mix_before") + F.sum("_mix_sum").over(W.partitionBy(KEY).orderBy("_mix_bucket"))
        cut = histogram.join(state, KEY).withColumn("_mix_upto", upto).where("_mix_upto > _mix_budget")
        first = cut.groupBy(KEY, "_mix_budget").agg(F.min(F.struct("_mix_bucket", "_mix_sum", "_mix_upto")).alias("_mix_cut"))
        before = F.col("_mix_cut._mix_upto") - F.col("_mix_cut._mix_sum")
        state = written(
            first.select(KEY, "_mix_budget", F.col("_mix_cut._mix_bucket").alias("_mix_edge"), before.alias("_mix_before"), F.col("_mix_cut._mix_sum").alias("_mix_sum")),
            "mix-state",
        )
        if level < LEVELS - 1:
            edges = state.select(KEY, "_mix_edge")
            inside = written(lookup(inside, edges, KEY).where(bucket == F.col("_mix_edge")).drop("_mix_edge"), "mix-rows")
            state = state.drop("_mix_edge", "_mix_sum")
    # The hash at which the budget ends: in if more than half of its rows' size is within.
    is_in = F.col("_mix_before") + F.col("_mix_sum") / 2 <= F.col("_mix_budget")
    ends = state.select(KEY, F.when(is_in, F.col("_mix_edge")).otherwise(F.col("_mix_edge") - 1).alias("_mix_end"))
    return sources.join(ends, KEY, "left").withColumn("_mix_end", F.coalesce("_mix_end", F.lit(-1).cast("long")))


def mix(
    docs: DataFrame,
    size: Column,
    key: str = "doc_id",
    source: str = "source",
    weights: tuple = WEIGHTS,
    share: tuple = SHARE,
    most: int = MOST,
) -> DataFrame:
    """Every row plus ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    added = {
        SIZE: F.coalesce(size, F.lit(0)).cast("long"),
        HASH: hash_of(F.col(key)),
        "_mix_null": F.col(source).isNull(),
        KEY: F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")),
    }
    marked = docs.withColumns(added)
    sizes = written(marked.select(KEY, "_mix_null", HASH, SIZE), "mix-sizes")
    plan = written(thresholds(sizes, written(targets(sizes, weights, share, most), "mix-targets")), "mix-plan")
    new = ["size", "source_size", "target", "copies", "taken"]
    plan = plan.select(KEY, *[F.col(c).alias(f"_mix_{c}_") for c in ("source_size", "target")], "_mix_base", "_mix_end")
    joined = lookup(marked.drop("_mix_null"), plan, KEY)
    copies = F.col("_mix_base") + (F.col(HASH) <= F.col("_mix_end")).cast("int")
    values = [F.col(SIZE), F.col("_mix_source_size_"), F.col("_mix_target_"), copies, copies * F.col(SIZE)]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    return joined.select(*kept, *[v.alias(n) for v, n in zip(values, new)])


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    times = mixed.where("copies > 0").withColumn("_mix_time", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return times.select(*columns)
