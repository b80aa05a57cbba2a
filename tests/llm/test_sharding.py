import zlib

import numpy as np
from pyspark.sql import functions as F

from askframe.llm import sharding
from askframe.llm.queries import op8_sharding


def check(rows, shards):
    slots = {}
    for r in rows:
        assert 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = op8_sharding(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == texts.keys() and len(found) == len(texts)
    check(found, 24)
    for r in found:
        body = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 8, zlib.crc32(body), "bytes", None)
        assert r.tokens == len(body.split())


def test_balance_with_a_hot_text(spark):
    text = F.when(F.col("id") % 3 == 0, F.repeat(F.lit("hot text "), 20)).otherwise(F.concat_ws(" ", "id", F.repeat(F.lit("w "), (F.col("id") * 31 % 60).cast("int"))))
    rows = spark.range(12000).select(F.col("id").alias("doc_id"), text.alias("text"))
    found = sharding.shard(rows)
    check(found.collect(), 24)
    sums = found.groupBy("shard").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).toPandas()
    assert len(sums) == 24
    for measure in ("size", "tokens", "rows"):
        assert sums[measure].max() < 1.03 * sums[measure].mean() and sums[measure].min() > 0.97 * sums[measure].mean()
    # Equal texts that are no load stay together.
    assert found.where("doc_id % 3 != 0").join(rows, "doc_id").groupBy("text").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_balance_with_a_repeated_row(spark):
    for key in (7, None):
        hot = spark.range(4000).select(F.lit(key).cast("long").alias("doc_id"), F.repeat(F.lit("hot text "), 20).alias("text"))
        rest = spark.range(8000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", "id", F.repeat(F.lit("w "), (F.col("id") * 31 % 60).cast("int"))).alias("text"))
        found = sharding.shard(hot.unionByName(rest))
        check(found.collect(), 24)
        sums = found.groupBy("shard").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).toPandas()
        assert len(sums) == 24 and sums["rows"].sum() == 12000
        for measure in ("size", "tokens", "rows"):
            assert sums[measure].max() < 1.03 * sums[measure].mean() and sums[measure].min() > 0.97 * sums[measure].mean()


def test_place_prefers_room():
    items = np.array([[4.0, 0, 1], [4, 0, 1], [0, 4, 1], [0, 4, 1]])
    chosen = sharding.place(items, 2)
    assert chosen[0] != chosen[1] and chosen[2] != chosen[3]
    assert sharding.place(np.zeros((0, 3)), 3).tolist() == []


def test_odd_rows(spark, documents):
    found = sharding.shard(documents((None, None), (1, ""), (1, ""), (2, "ä b")), shards=2).collect()
    check(found, 2)
    assert sorted((r.size, r.tokens) for r in found) == [(8, 0), (8, 0), (8, 0), (12, 2)]
    assert sharding.shard(documents((1, "a")).limit(0)).collect() == []
