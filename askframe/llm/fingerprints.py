"""Document fingerprints: bottom-k sketches of word shingles (operator 10, native).

A sketch is the sorted array of the k least distinct 64-bit hashes of a text's
shingles of five words; a text of one to four words is one shingle, a text without
words has an empty sketch. Sketches of parts merge into the sketch of the whole.
From two sketches follow resemblance and containment, from one the number of
distinct shingles. Two empty sketches resemble each other by 1, an empty and
another one by 0. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askframe.llm.common import words, written

K = 128
SHINGLE = 5
ROWS_PER_RANGE = 200_000


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The k least shingle hashes, ascending."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(h) - (shingle - 1), F.lit(1)))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(-1, shingle - 1)]))

    # A one-element array binds the hashed words to a name, so that they are made once.
    bound = F.element_at(F.transform(F.array(hashed), lambda h: F.when(F.size(h) > 0, shingles(h))), 1)
    return F.slice(F.array_sort(F.array_distinct(F.coalesce(bound, F.array().cast("array<bigint>")))), 1, k)


def merged(one: Column, other: Column, k: int = K) -> Column:
    """The sketch of both texts' shingles."""
    return F.slice(F.array_sort(F.array_union(one, other)), 1, k)


def merge_all(frame: DataFrame, by: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch per group: distinct hashes, ranked, the k least. Groups of any size:
    hashes are made distinct within tasks first."""
    each = frame.select(*by, F.explode(column).alias("_hash")).distinct()
    rank = F.row_number().over(W.partitionBy(*by).orderBy("_hash"))
    least = each.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return least.groupBy(*by).agg(F.array_sort(F.collect_list("_hash")).alias(column))


def resemblance(one: Column, other: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the texts' shingles."""
    union = merged(one, other, k)
    shared = F.size(F.array_intersect(F.array_intersect(union, one), other))
    return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.size(union))


def distinct_shingles(one: Column, k: int = K) -> Column:
    """Exact below k, else estimated from the place of the k-th least hash."""
    share = (F.element_at(one, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(one) < k, F.size(one).cast("double")).otherwise((k - 1) / share)


def containment(one: Column, other: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second one has."""
    alike = resemblance(one, other, k)
    both = alike * distinct_shingles(merged(one, other, k), k)
    own = distinct_shingles(one, k)
    return F.when(F.size(one) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / own))


def as_text(one: Column) -> Column:
    """Hex digits, 16 a hash."""
    return F.array_join(F.transform(one, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def next_keys(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` (key first) plus ``next_<column>`` of the next row in order of the key,
    the first row's for the last one.

    Spark's range partitioning deals the keys out in order; what is next within a
    range comes from a window, what is next after it from the least of the ranges.
    """
    parts = max(1, -(-keys.count() // ROWS_PER_RANGE))
    columns = keys.columns
    dealt = keys.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    row = F.struct(*columns)
    firsts = dealt.groupBy("_range").agg(F.min(row).alias("_first"))
    in_order = W.orderBy("_range")
    after = F.coalesce(F.lead("_first").over(in_order), F.first("_first").over(in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    firsts = firsts.select("_range", after.alias("_after"))
    lead = F.lead(row).over(W.partitionBy("_range").orderBy(*columns))
    found = dealt.withColumn("_next", lead).join(F.broadcast(firsts), "_range")
    found = found.withColumn("_next", F.coalesce("_next", "_after"))
    return found.select(*columns, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in columns])


def edited(documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Every text (``body``) with its next document's sketch (``next_sketch``) and the
    text whose last quarter is replaced by the next document's beginning (``edited``).

    Rows of a repeated key follow each other in order of a hash of their text; equal
    rows count as one document here and each get its result. A single document
    follows itself. Texts cross one shuffle; of next documents only the code points
    that are needed and the sketches cross another.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    docs = documents.select(F.struct(F.col(key).alias("key"), F.xxhash64(body).alias("mark")).alias("at"), body.alias("body"))
    quarter = F.floor(F.length("body") / 4).cast("int")
    pairs = written(next_keys(docs.select("at", quarter.alias("n")).distinct(), "at"), "next")
    wanted = pairs.select(F.col("next_at").alias("at"), F.col("at").alias("for_at"), "n")
    begins = docs.join(wanted, "at").select("for_at", F.substring("body", F.lit(1), F.col("n")).alias("begin"), sketch(F.col("body"), k=k).alias("next_sketch"))
    begins = begins.groupBy(F.col("for_at").alias("at")).agg(F.max(F.struct("begin", "next_sketch")).alias("next"))
    changed = F.concat(F.substring("body", F.lit(1), F.length("body") - quarter), F.col("next.begin"))
    return docs.join(begins, "at").select(F.col("at.key").alias("key"), "body", changed.alias("edited"), F.col("next.next_sketch").alias("next_sketch"))
