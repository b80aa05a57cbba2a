import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from askframe.llm import resampling
from askframe.llm.queries import op11_resampling

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_by_hand(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LETTERS))


def features_by_hand(text, n=1):
    tokens = words_by_hand(text)
    return [" ".join(tokens[i : i + k]) for k in range(1, n + 1) for i in range(len(tokens) - k + 1)]


def by_hand(documents, target, n=1, buckets=10_000, share=10, least=20):
    """(doc_id, n_words, n_features, weight, score, rank), in order of rank and then as given."""
    bucket = lambda feature: zlib.crc32(feature.encode()) % buckets
    s = Counter(bucket(f) for _, text in documents for f in features_by_hand(text, n))
    t = Counter(bucket(f) for text in target for f in features_by_hand(text, n))
    both = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * both[0] / ((s[b] + 1.0) * both[1])))
    rows = []
    for key, text in documents:
        found = features_by_hand(text, n)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, len(words_by_hand(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    long = sorted((row for row in rows if row[1] >= least), key=lambda row: (-row[4], row[0] is None, row[0]))
    drawn = share * len(long) // 100
    ranks = long[:drawn]
    return [(*row, i + 1) for i, row in enumerate(ranks)], [(*row, None) for row in long[drawn:] + [row for row in rows if row[1] < least]]


def same(found, expected):
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected[0] + expected[1], key=key)


def test_query(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    documents = [tuple(row) for row in read("documents").select("doc_id", "text").collect()]
    expected = by_hand(documents, [row["text"] for row in read("benchmark").collect()])
    found = op11_resampling(spark, sf_dir)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {kind for _, kind in found.dtypes} == {"bigint"}
    same(found, tuple([row[:1] + row[2:] for row in rows] for rows in expected))


@pytest.mark.parametrize("n", [1, 2, 4])
def test_runs_within_and_across_lines(documents, spark, n):
    rows = [(i, f"one two\nthree\n\nfour {i} five\nTHREE\nfour Ähren--{i % 3}_x") for i in range(30)] + [(50, "one two\nthree"), (51, "\n\n"), (52, "a")]
    target = spark.createDataFrame([("two three four",), ("five three\nfour",), (None,)], "text string")
    found = resampling.resample(documents(*rows), target, n=n, buckets=97, least=3, share=40)
    same(found, by_hand(rows, ["two three four", "five three\nfour", None], n, 97, 40, 3))


@given(st.text(alphabet="Ab0 \n-é\x85 ", max_size=40), st.integers(1, 4))
def test_lines_and_crossings_make_all_runs(text, n):
    lines = [run for line in text.encode().split(b"\n") for run in resampling.runs(resampling.words(line), n)]
    assert Counter(lines + resampling.crossing(text.encode(), n)) == Counter(f.encode() for f in features_by_hand(text, n))


def test_odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows and keys, clashing columns."""
    long = " ".join(f"Word{i % 1000}" for i in range(200_000))
    rows = [(None, "x " * 25), (None, "x " * 25), (1, None), (2, ""), (3, long), (4, "x " * 25), (4, "x " * 25), (5, "y\n" * 30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = frame.withColumns({c: F.lit("mine") for c in ("rank", "score", "weight", "line", "times", "body", "name", "_row", "_long")})
    target = spark.createDataFrame([("x y",)], "text string")
    found = resampling.resample(clashing, target, share=60)
    same(found, by_hand(rows, ["x y"], share=60))
    drawn = resampling.drawn(clashing, found)
    assert drawn.columns == clashing.columns
    keys = {row["doc_id"] for row in found.where("rank is not null").collect()}
    assert sorted(map(str, (row["doc_id"] for row in drawn.collect()))) == sorted(str(key) for key, _ in rows if key in keys)
    nothing = resampling.resample(frame.limit(0), target.limit(0))
    assert nothing.collect() == [] and nothing.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    same(resampling.resample(frame, target.limit(0), share=60), by_hand(rows, [], share=60))


def test_equal_rows_are_dealt_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(resampling, "RANKED", 100)
    rows = spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).alias("doc_id"), F.lit(5).cast("long").alias("score"), F.lit(True).alias("ok"))
    written = []
    monkeypatch.setattr(resampling, "written", lambda frame, name, write=resampling.written: written.append(write(frame, name)) or written[-1])
    found = resampling.ranked(rows, "ok", ["-score", "doc_id"])
    assert [row["rank"] for row in found.orderBy("rank").collect()] == list(range(1, 2001))
    sizes = [row["count"] for row in written[-1].groupBy(F.shiftright("_place", resampling.PLACE)).count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 400
