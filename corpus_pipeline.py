"""From raw documents to packed training batches, in five stages.

Each stage takes all that its predecessor kept, as a written table. Toxic documents go,
near copies of lines go, one document of each group of near copies stays, sources are
mixed to their target weights (so documents may repeat), and what is left is packed.
All stages but the last return the columns of ``documents``.

Defined results: without enough labelled documents to learn toxicity from, the first
stage keeps all; empty and null texts pass the first two stages as they are; equal
texts, empty ones too, are one group of the third; documents without words take part
in the mix with size 0; an empty table gives an empty table. A column of the input that
is named like one that a stage adds takes the stage's values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askframe.llm import lines, mixing, packing, shinglejoin, toxicity
from askframe.llm.common import count_words, table, written

TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under ``TOXIC``, learnt from all labelled documents of this stage.

    Where these are too few to learn from, nothing is known of any document and all stay.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    if not isinstance(model, toxicity.Machine):
        return docs
    scored = toxicity.score(docs, model, name="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines that stay, its ``n_chars`` counted anew."""
    kept = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return shinglejoin.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(mixing.mix(docs, count_words(F.col("text"))), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their bucket, batch and slot."""
    return packing.pack(docs, count_words(F.col("text")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("shingle join", join_near),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL has no string-kernel machine, so the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
