"""One query per operator, over whole tables, with the operators' production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askframe.llm import bestfit, fingerprints, lines, lm, mixing, neighbours, packing, quality, resampling, sharding, shinglejoin
from askframe.llm import toxicity, whitening
from askframe.llm.common import count_words, remainder, table, written

Query = Callable[[SparkSession, str], DataFrame]


THRESHOLD = 0.3


def _judged(operator, spark: SparkSession, sf_dir: str, by: int, held: int) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), by) == held
    model = operator.train(documents, labels, ~held_out)
    scored = operator.score(documents.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(toxicity, spark, sf_dir, 4, 2)


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    scored = lm.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_shinglejoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shinglejoin.joined(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", count_words(F.col("text")).alias("words"))
    return packing.pack(written(docs, "lengths"), F.col("words")).drop("words")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", count_words(F.col("text")).alias("words"))
    mixed = mixing.mix(written(docs, "sizes"), F.col("words"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    none = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none, "tokens")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(quality, spark, sf_dir, 5, 0)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = fingerprints.edited(table(spark, sf_dir, "documents"))
    sketched = both.select(
        F.col("key").alias("doc_id"),
        F.length("body").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprints.sketch(F.col("body")).alias("own"),
        fingerprints.sketch(F.col("edited")).alias("other"),
        "next_sketch",
    )
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.as_text(F.col("own")).alias("fingerprint"),
        fingerprints.as_text(F.col("other")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("own"), F.col("other")).alias("near_edited"),
        fingerprints.resemblance(F.col("own"), F.col("next_sketch")).alias("near_next"),
        fingerprints.distinct_shingles(F.col("own")).alias("distinct_shingles"),
        fingerprints.containment(F.col("own"), F.col("other")).alias("contained_in_edited"),
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_lm": op2_lm,
    "op3_lines": op3_lines,
    "op4_shinglejoin": op4_shinglejoin,
    "op5_packing": op5_packing,
    "op6_neighbours": op6_neighbours,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_quality": op9_quality,
    "op10_fingerprints": op10_fingerprints,
    "op11_resampling": op11_resampling,
    "op12_bestfit": op12_bestfit,
    "op13_whitening": op13_whitening,
}
