import hashlib

import pytest
from pyspark.sql import functions as F

from askframe.llm import fingerprints
from askframe.llm.queries import op10_fingerprints


def shingles(text):
    found = (text or "").split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def jaccard(one, other):
    a, b = shingles(one), shingles(other)
    return len(a & b) / len(a | b) if a | b else 1.0


def changed(text, following):
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def test_query_against_brute_force(spark, sf_dir):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    found = {r.doc_id: r for r in op10_fingerprints(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    prints = {}
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        edited, row = changed(text, following), found[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        small = max(len(shingles(t)) for t in (text, edited, following)) < fingerprints.K // 2
        assert row.near_edited == pytest.approx(jaccard(text, edited), abs=1e-9 if small else 0.2)
        assert row.near_next == pytest.approx(jaccard(text, following), abs=1e-9 if small else 0.2)
        many = len(shingles(text))
        assert row.distinct_shingles == pytest.approx(many, rel=1e-9 if many < fingerprints.K else 0.5)
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint


def test_odd_texts(spark, documents):
    long = " ".join(f"w{i % 4000}" for i in range(20_000))
    docs = documents((5, None), (None, "a b c d e f"), (7, ""), (9, long), (9, "x"), (9, "x"), (8, "äöü ß日本 𝄞𝄞𝄞𝄞"))
    rows = fingerprints.edited(docs).collect()
    assert len(rows) == 7
    assert {len(r.next_sketch) for r in rows} <= {0, 1, 2, fingerprints.K}
    after_null = next(r for r in rows if r.key is None)
    assert (after_null.body, after_null.edited) == ("a b c d e f", "a b c d e")  # the next text is empty
    music = next(r for r in rows if r.key == 8)
    q = len(music.body) // 4
    assert music.edited in (music.body[:-q] + "x", music.body[:-q] + long[:q])
    assert fingerprints.edited(docs.limit(0)).collect() == []
    alone = fingerprints.edited(documents((1, "abcd efgh"))).collect()
    assert [(r.body, r.edited) for r in alone] == [("abcd efgh", "abcd efab")]


def test_ranges_are_chained(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 7)
    keys = spark.range(0, 200, 3).select("id")
    pairs = {r.id: r.next_id for r in fingerprints.next_keys(keys, "id").collect()}
    assert pairs == {i: (i + 3 if i + 3 < 200 else 0) for i in range(0, 200, 3)}


def test_merging(spark):
    rows = spark.createDataFrame([("a b c d e f g",), ("b c d e f g h",), ("",)], "text string")
    one = rows.select(F.lit(1).alias("g"), fingerprints.sketch(F.col("text")).alias("s"))
    whole = fingerprints.merge_all(one, ["g"], "s").first()["s"]
    assert len(whole) == 4 and whole == sorted(whole)
    a, b = (F.lit(r.s) if r.s else F.array().cast("array<bigint>") for r in one.limit(2).collect())
    got = spark.range(1).select(fingerprints.merged(a, b).alias("m"), fingerprints.containment(a, b).alias("c"), fingerprints.resemblance(a, b).alias("r")).first()
    assert got.m == whole and got.c == pytest.approx(2 / 3) and got.r == 0.5


def test_native(spark, sf_dir):
    plan = op10_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
