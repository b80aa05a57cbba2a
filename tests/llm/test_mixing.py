from pyspark.sql import functions as F

from askframe.llm.mixing import hash_of, mix, repeated, targets


def by_hand(sizes):
    """Targets by dealing out the excess again and again."""
    order = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        rate = left / sum(weight[k] for k in open_)
        full = {k for k in open_ if weight[k] * rate >= 2 * sizes[k]}
        if not full:
            return target | {k: weight[k] * rate for k in open_}
        for k in full:
            target[k] = 2 * sizes[k]
            left -= target[k]
        open_ -= full
    return target


def mixed(rows, size="n"):
    return mix(rows, F.col(size))


def test_targets_and_thresholds(spark):
    # A third of all rows in one source, small ones, one without a name, one without words.
    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).when(F.col("id") % 50 == 2, "zero").otherwise(F.concat(F.lit("s"), F.col("id") % 7))
    size = F.when(F.col("id") % 50 == 2, 0).otherwise(F.col("id") * 7 % 93 + 1)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), source.alias("source"), size.alias("n"))
    found = mixed(rows).collect()
    sizes = {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    expected = by_hand(sizes)
    taken = {}
    for r in found:
        assert abs(r.target - expected[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[k] - expected[k]) <= 47 for k in sizes)
    again = {(r.doc_id, r.copies) for r in mixed(rows.repartition(5)).collect()}
    assert again == {(r.doc_id, r.copies) for r in found}
    assert repeated(mixed(rows), ["doc_id"]).count() == sum(r.copies for r in found)


def test_thresholds_are_nested(spark):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(1).alias("n"))
    rows = rows.unionByName(spark.range(400, 500).select(F.col("id").alias("doc_id"), F.lit("b").alias("source"), F.lit(1).alias("n")))
    found = mixed(rows).withColumn("h", hash_of(F.col("doc_id"))).where("source = 'a'").orderBy("h").collect()
    copies = [r.copies for r in found]
    assert copies == sorted(copies, reverse=True)


def test_odd_rows(spark):
    rows = spark.createDataFrame(
        [(None, None, None, 9), (1, "a", 4, 9), (1, "a", 4, 9), (2, "a", None, 9), (None, "a", 2, 9)], "doc_id long, source string, n long, size int"
    )
    found = mixed(rows)
    assert found.columns == ["doc_id", "source", "n", "size", "source_size", "target", "copies", "taken"]
    sizes = sorted(r["size"] for r in found.collect())
    assert sizes == [0, 0, 2, 4, 4]
    # Equal keys are taken alike.
    assert len({r.copies for r in found.where("doc_id = 1").collect()}) == 1
    assert mixed(rows.limit(0)).collect() == []
    only_empty = mixed(rows.withColumn("n", F.lit(0))).collect()
    assert all(r.target == 0 and r.taken == 0 for r in only_empty)


def test_targets_of_equal_ratio(spark):
    rows = spark.createDataFrame([("=a", False, 5), ("=b", False, 2), ("=c", False, 1)], "_mix_source string, _mix_null boolean, _mix_size long")
    assert {r._mix_source: r.target for r in targets(rows).collect()} == {"=a": 7.5, "=b": 3.0, "=c": 1.5}
