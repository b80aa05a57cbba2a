import pytest
from pyspark.sql import functions as F

from askframe.operators import presence
from askframe.operators.presence import check_presence, fits_broadcast, keep_wanted, lookup, missing, present, unused
from askframe.sources.storage import read_roots


def hot_tables(spark):
    """A third of the rows on one key, on either side, and some without any."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    left = spark.range(6000).select("id", key.alias("key"))
    known_key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") * 2).cast("string"))
    return left, spark.range(6000).select(known_key.alias("key"))


@pytest.mark.parametrize("bounds", ["few", "broadcast", "none"])
def test_presence(spark, bounds, request, monkeypatch):
    left, known = hot_tables(spark)
    if bounds == "none":
        request.getfixturevalue("nothing_fits")
    monkeypatch.setattr(presence, "FEW_KEYS", 10_000 if bounds == "few" else 0)
    marked = check_presence(left, known, "key").collect()
    there = {row.key for row in known.distinct().collect()}
    assert len(marked) == 6000 == len({row.id for row in marked})
    assert all(row.present == (row.key in there) for row in marked)
    found, gone = present(left, known, "key"), missing(left, known, "key")
    assert found.columns == gone.columns == ["id", "key"]
    assert {r.id for r in found.collect()} == {r.id for r in marked if r.present}
    assert {r.id for r in gone.collect()} == {r.id for r in marked if not r.present}


def test_large_lookup_keeps_hot_keys_out_of_the_shuffle(spark):
    left, _ = hot_tables(spark)
    right = left.where("key is not null").select("key").distinct().withColumn("size", F.length("key"))
    joined = lookup(left, right, "key", small=False)
    assert joined.columns == ["key", "id", "size"]
    rows = joined.collect()
    assert len(rows) == 6000
    assert all(r.size == (None if r.key is None else len(r.key)) for r in rows)


def test_few_keys_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "known")
    spark.range(100).select(F.col("id").cast("string").alias("key")).write.parquet(path)
    requests = spark.createDataFrame([("7",), ("x",), ("7",)], "key string")
    known = spark.read.parquet(path)
    assert "In(key, [" in check_presence(requests, known, "key")._jdf.queryExecution().toString()
    assert present(requests, known, "key").count() == 2
    kept = keep_wanted(known, requests.distinct(), "key")
    assert "In(key, [" in kept._jdf.queryExecution().toString()
    assert [row.key for row in kept.collect()] == ["7"]


def test_bounds(spark):
    table = spark.range(100).select(F.repeat(F.lit("x"), 10).alias("t"))
    assert fits_broadcast(table, rows=100, size=1000)
    assert not fits_broadcast(table, rows=99, size=1000)
    assert not fits_broadcast(table, rows=100, size=999)
    assert fits_broadcast(table.limit(0))
    assert presence.HOT_SHARE * 8 < presence.BROADCAST_ROWS


def test_large_lookup_reads_its_left_side_once(spark, tmp_path, nothing_fits):
    """In the plan it returns; the sketch of hot keys before it is one aggregation."""
    left, right = str(tmp_path / "left"), str(tmp_path / "right")
    hot_tables(spark)[0].write.parquet(left)
    spark.range(500).select(F.col("id").cast("string").alias("key"), F.col("id").alias("size")).write.parquet(right)
    joined = lookup(spark.read.parquet(left), spark.read.parquet(right), "key")
    assert sorted(root.rsplit("/", 1)[1] for root in read_roots(joined)) == ["left", "right"]
    assert joined.where("size is not null").count() == spark.read.parquet(left).where("key is not null and key != 'hot' and int(key) < 500").count()


def test_hot_rows_are_dealt_out(spark, nothing_fits):
    left, _ = hot_tables(spark)
    left = left.repartition(16)
    right = left.where("key is not null").select("key").distinct().withColumn("size", F.length("key"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = lookup(left, right, "key").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    counts = [r["count"] for r in sizes]
    assert max(counts) < 2 * 6000 / len(counts)


def test_hot_keys(spark):
    left, known = hot_tables(spark)
    assert presence.hot_keys(left, "key") == ["hot"]
    assert presence.hot_keys(known.limit(0), "key") == []


def test_columns_named_like_those_of_a_lookup(spark, nothing_fits):
    left = spark.createDataFrame([("a", 1, 2, 3), (None, 4, 5, 6)], "key string, salt int, HOT int, `odd name` int")
    right = spark.createDataFrame([("a", 7)], "key string, _salt int")
    found = lookup(left, right, "key")
    assert found.columns == ["key", "salt", "HOT", "odd name", "_salt"]
    assert sorted(map(tuple, found.collect()), key=str) == [("a", 1, 2, 3, 7), (None, 4, 5, 6, None)]
    assert (unused("salt", left, right), unused("hot", left), unused("new", left)) == ("__salt", "_hot", "new")
