"""Resampling towards a target distribution by importance weights (operator 11).

A text's features are all runs of one to ``n`` words, hashed into buckets by the crc32 of
their bytes. A bucket is worth more the more often it occurs in the target texts than in
the documents; a document weighs the sum over its features, gets a Gumbel number of its
key, and the highest sums are drawn, which is a weighted sample without replacement.

Counting goes by segments: line feeds cut the texts into lines, equal lines are brought
together, the features of each distinct line are counted once and multiplied by its
occurrences. A line feed parts words, so single words need no more; longer runs that
cross a line feed are counted apart, from whole texts. Tasks add up their buckets before
anything is shuffled, so that a table of ``buckets`` numbers is all that reaches the driver.

Weights are summed by one more pass over the whole texts, without a shuffle: it needs no
lines, as every feature lies in its document. Ranks come of a range partitioning of small
rows, by score, key and a number of the row, so that no task holds all rows, or all equal ones.

Defined results: null texts have no words; keys are hashed as text, a null one as empty
text, and come last among ties; repeated rows are rows of their own, with adjoining ranks;
without target texts or documents every gain is what the formula gives for counts of 0;
no rows give no rows. Only the key and the text are read, whatever other columns there are.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askframe.llm.common import slices, written
from askframe.sources.storage import task_count

BUCKETS = 10_000
SEED = 2024
SHARE = 10  # percent of the documents that are long enough
LEAST = 20  # words of a document that can be drawn
SLICE = 4 << 20  # bytes of text whose words are held at once
KNOWN = 200_000  # features whose buckets a task remembers
RANKED = 200_000  # rows that a task sorts
#: Upper-case letters become lower-case, all ASCII but letters and digits a blank.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
PLACE = 33  # bits of a row's number within its partition


def words(body: bytes) -> list[bytes]:
    return body.translate(LOWER).split()


def runs(tokens: list[bytes], n: int) -> list[bytes]:
    """All runs of one to ``n`` tokens."""
    return tokens + [b" ".join(tokens[i : i + k]) for k in range(2, n + 1) for i in range(len(tokens) - k + 1)]


def crossing(body: bytes, n: int) -> list[bytes]:
    """The runs of two to ``n`` tokens that lie in more than one line."""
    lines = [words(line) for line in body.split(b"\n")]
    tokens = [token for line in lines for token in line]
    line_of = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
    found = []
    for k in range(2, min(n, len(tokens)) + 1):
        for i in np.nonzero(line_of[k - 1 :] != line_of[: len(tokens) - k + 1])[0]:
            found.append(b" ".join(tokens[i : i + k]))
    return found


class Buckets(dict):
    """The bucket of every feature asked for; forgets all when there are too many."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found


def _counted(table: DataFrame, features, buckets: int) -> DataFrame:
    """``bucket`` and ``n`` of the features of ``body``, each as often as ``times`` says."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bucket_of = np.zeros(buckets, np.int64), Buckets(buckets)
        for batch in (part for whole in batches for part in slices(whole, "body", SLICE)):
            each = [features(body) for body in batch.column("body").to_pylist()]
            sizes = np.fromiter(map(len, each), np.int64, len(each))
            found = np.fromiter((bucket_of[feature] for some in each for feature in some), np.int64, int(sizes.sum()))
            times = np.repeat(batch.column("times").to_numpy(), sizes)
            order = np.argsort(found, kind="stable")
            firsts = np.nonzero(np.diff(found[order], prepend=-1))[0]
            if len(firsts):
                total[found[order][firsts]] += np.add.reduceat(times[order], firsts)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    return table.mapInArrow(count, "bucket long, n long")


def bucket_counts(texts: DataFrame, text: str = "text", n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts lie in each bucket."""
    body = F.col(text)
    lines = texts.where(body.isNotNull()).select(F.explode(F.split(body, "\n")).alias("line")).where("line != ''")
    distinct = lines.groupBy("line").agg(F.count("*").alias("times"))
    counted = _counted(distinct.select(F.col("line").cast("binary").alias("body"), "times"), lambda line: runs(words(line), n), buckets)
    if n > 1:
        whole = texts.where(body.contains("\n")).select(body.cast("binary").alias("body"), F.lit(1).cast("long").alias("times"))
        counted = counted.unionByName(_counted(whole, lambda line: crossing(line, n), buckets))
    total = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        total[row["bucket"]] = row["n"]
    return total


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths."""
    all_documents, all_target, buckets = int(documents.sum()), int(target.sum()), len(documents)

    def gain(s: int, t: int) -> int:
        return math.floor(1000 * math.log((t + 1.0) * (all_documents + buckets) / ((s + 1.0) * (all_target + buckets))))

    return np.array([gain(s, t) for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def gumbel(key: str, seed: int) -> int:
    """A number in thousandths that depends on key and seed alone."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))


def weighed(
    documents: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", n: int = 1, seed: int = SEED
) -> DataFrame:
    """Key, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row."""
    schema = documents.select(F.col(key)).schema
    for name in ("n_words", "n_features", "weight", "score"):
        schema = schema.add(name, "long")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = Buckets(len(gain))
        for batch in (part for whole in batches for part in slices(whole, "body", SLICE)):
            found = []
            for body, name in zip(batch.column("body").to_pylist(), batch.column("name").to_pylist()):
                tokens = words(body)
                features = runs(tokens, n)
                weight = int(gain[np.fromiter(map(bucket_of.__getitem__, features), np.int64, len(features))].sum())
                found.append((len(tokens), len(features), weight, weight + gumbel(name, seed)))
            numbers = [pa.array(column, pa.int64()) for column in zip(*found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers], schema.names)

    name, body = F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")).cast("binary")
    return documents.select(F.col(key), name.alias("name"), body.alias("body")).mapInArrow(weigh, schema)


def ranked(rows: DataFrame, eligible: str, order: list[str], name: str = "rank") -> DataFrame:
    """The rows plus their places, from 1, among those that are ``eligible``, in the
    ``order`` of columns (``-`` before a name: falling; nulls last); null for the others."""
    spark = rows.sparkSession
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "scored")
    by = [F.col(c[1:]).desc_nulls_last() if c[0] == "-" else F.col(c).asc_nulls_last() for c in [*order, "_row"]]
    by = [F.col(eligible).desc(), *by]
    # The row's number parts even equal rows, so a range never has to hold all of them.
    ranges = rows.repartitionByRange(task_count(spark, rows.count(), RANKED), *by).sortWithinPartitions(*by)
    ranges = written(ranges.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", PLACE)
    counts = sorted(ranges.groupBy(part.alias("part")).count().collect())  # one row a task
    before = np.concatenate([[0], np.cumsum([row["count"] for row in counts])]).tolist()
    starts = spark.createDataFrame([(row["part"], n) for row, n in zip(counts, before)], "_part long, _before long")
    placed = ranges.withColumn("_part", part).join(F.broadcast(starts), "_part", "left")
    place = F.col("_before") + F.col("_place").bitwiseAND(2**PLACE - 1) + 1
    return placed.withColumn(name, F.when(F.col(eligible), place)).drop("_row", "_place", "_part", "_before")


def resample(
    documents: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    n: int = 1,
    buckets: int = BUCKETS,
    seed: int = SEED,
    share: int = SHARE,
    least: int = LEAST,
) -> DataFrame:
    """Every document's key, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the documents with at least ``least`` words, ``share`` percent are drawn and
    have a rank, 1 being the highest score, ties by the smaller key; the others have none.
    """
    gain = gains(bucket_counts(documents, text, n, buckets), bucket_counts(target, target_text, n, buckets))
    scored = weighed(documents, gain, key, text, n, seed).withColumn("_long", F.col("n_words") >= least)
    placed = ranked(scored, "_long", ["-score", key])
    drawn = share * placed.where("_long").count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")
    return placed.select(key, "n_words", "n_features", "weight", "score", rank.alias("rank"))


def drawn(documents: DataFrame, ranks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents, all columns, whose key was drawn."""
    keys = ranks.where("rank is not null").select(F.col(key).alias("_drawn")).distinct()
    return documents.join(keys, F.col(key).eqNullSafe(F.col("_drawn")), "left_semi")
