"""Connected components by distributed union-find on tables, without Python in the tasks.

Large-star and small-star steps in turn: every step hooks nodes onto the least
neighbour known to them, and the edges shrink to one star per component. A step
aggregates within tasks before it shuffles, writes the least neighbours, and joins
them to the edges by a broadcast or, if there are too many, by a salted lookup, so
that the centre of a huge star fills no task. The tables of a step go when the next is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askframe.llm.common import drop, written
from askframe.operators import presence
from askframe.operators.presence import lookup


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node that has an edge.

    ``edges`` has two columns of longs, either order, repeats and loops allowed; edges
    with a null end count for nothing. No edges give no rows.
    """
    one, other = (F.col(c) for c in edges.columns)
    ordered = edges.where(one.isNotNull() & other.isNotNull() & (one != other))
    ordered = written(ordered.select(F.greatest(one, other).alias("u"), F.least(one, other).alias("v")).distinct(), "edges")
    before = _state(ordered)
    while before[0]:
        ordered = _small_star(_large_star(ordered))
        after = _state(ordered)
        if after == before:
            break
        before = after
    leaves = ordered.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = ordered.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Edges as a set, in two numbers: it is settled when a round changes neither."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _least(edges: DataFrame) -> tuple[DataFrame, bool]:
    """The least neighbour ``m`` of every ``u``, and whether the table fits a broadcast:
    its rows are two numbers wide."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    return least, presence.BROADCAST_ROWS >= least.count()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hooked onto the node's least neighbour."""
    least, small = _least(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    # A larger neighbour of v is the u of an edge, so the edges need no second direction here.
    hooked = lookup(edges.withColumnRenamed("u", "w"), least.withColumnRenamed("u", "v"), "v", small)
    found = written(hooked.select(F.col("w").alias("u"), F.least("v", "m").alias("v")).distinct(), "edges")
    drop(edges, least)
    return found


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hooked onto the least of them."""
    least, small = _least(edges)
    hooks = lookup(edges, least, "u", small).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    found = written(hooks.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
    drop(edges, least)
    return found
