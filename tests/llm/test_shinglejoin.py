import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from askframe.llm import shinglejoin
from askframe.llm.queries import op4_shinglejoin


def shingles(text):
    found = (text or "").split()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def by_hand(docs):
    """(class, links, copies) by comparing all pairs of texts."""
    texts = sorted({t or "" for _, t in docs})
    sets, linked = [shingles(t) for t in texts], {t: [] for t in texts}
    for i, a in enumerate(texts):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
                linked[a].append(texts[j])
                linked[texts[j]].append(a)
    group = {}
    for start in texts:
        if start not in group:
            queue, members = [start], {start}
            while queue:
                for t in linked[queue.pop()]:
                    if t not in members:
                        members.add(t)
                        queue.append(t)
            least = min(d for d, t in docs if (t or "") in members)
            group |= dict.fromkeys(members, least)
    return {d: (group[t or ""], len(linked[t or ""]), sum((u or "") == (t or "") for _, u in docs)) for d, t in docs}


def result(frame):
    return {r.doc_id: (r.class_id, r.links, r.copies) for r in frame.collect()}


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert result(op4_shinglejoin(spark, sf_dir)) == by_hand(docs)


@pytest.mark.parametrize("large", [False, True])
def test_large_group_in_blocks(spark, documents, monkeypatch, large, request):
    """Near copies by the hundred: buckets are split, compared in blocks, no link counts twice."""
    if large:
        request.getfixturevalue("small_bounds_off")
    monkeypatch.setattr(shinglejoin, "SMALL", 20)
    monkeypatch.setattr(shinglejoin, "BLOCK", 32)
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    docs = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(200)] = f"x{rng.randrange(9999)}"
        docs.append((i, " ".join(text)))
    docs += [(1000 + i, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 80)))) for i in range(80)]
    found, expected = result(shinglejoin.joined(documents(*docs))), by_hand(docs)
    assert {d: found[d][::2] for d in found} == {d: expected[d][::2] for d in expected}
    lost = sum(expected[d][1] - found[d][1] for d in expected)
    assert 0 <= lost <= 0.003 * sum(e[1] for e in expected.values())
    assert all(found[d][1] <= expected[d][1] for d in expected)


def test_odd_rows(spark, documents):
    docs = documents((5, None), (6, ""), (7, " \n"), (3, "a b"), (4, "a b"), (4, "a b"), (None, "a b"), (8, "a b c"), (9, "only"))
    rows = sorted(((r.doc_id, r.class_id, r.links, r.copies) for r in shinglejoin.joined(docs).collect()), key=str)
    assert rows == sorted(
        [(5, 5, 0, 2), (6, 5, 0, 2), (7, 7, 0, 1), (3, 3, 0, 4), (4, 3, 0, 4), (4, 3, 0, 4), (None, 3, 0, 4), (8, 8, 0, 1), (9, 9, 0, 1)], key=str
    )
    kept = shinglejoin.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 7, 8, 9]
    assert shinglejoin.joined(docs.limit(0)).collect() == [] == shinglejoin.one_of_each(docs.limit(0)).collect()
    only_null = documents((None, "a"), (None, "a"))
    assert [r.text for r in shinglejoin.one_of_each(only_null).collect()] == ["a"]


def test_embedding_estimates_similarity():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 2**63, 300).astype(np.int64)
    other = words.copy()
    other[150:160] = rng.integers(0, 2**63, 10)
    hashes, starts = shinglejoin.shingle_hashes(np.concatenate([words, other]), np.array([0, 300, 600]))
    assert len(hashes) == 592 and len(set(hashes.tolist())) == 592 - 282
    a, b = shinglejoin.minima(hashes, starts)
    assert abs((a == b).mean() - 282 / 310) < 0.15


def test_similar_pairs_agree():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[k:], rng.integers(0, 2**63, k).astype(np.uint64)])) for k in range(0, 30)]
    expected = [[i != j and len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    expected = np.array(expected)
    for n in (30, 9):
        found = shinglejoin.similar_pairs(sets[:n], sets[:n], 0.8)
        np.fill_diagonal(found, False)
        assert (found == expected[:n, :n]).all()
        found = shinglejoin.similar_pairs(some := sets[:n], some, 0.8)
        np.fill_diagonal(found, False)
        assert (found == expected[:n, :n]).all()
    assert (shinglejoin.similar_pairs(sets[:13], sets[13:], 0.8) == expected[:13, 13:]).all()
    far = [np.arange(i * 100, i * 100 + 50, dtype=np.uint64) for i in range(20)]
    assert not shinglejoin.similar_pairs(far[:13], far[13:], 0.8).any()
    assert not np.triu(shinglejoin.similar_pairs(far, far, 0.8), 1).any()


@pytest.mark.parametrize("bytes_held", [1 << 20, 3000])
def test_blocks_by_bytes(spark, documents, monkeypatch, bytes_held):
    """One bucket of long texts is cut by what they hold; a star, and a chain of ever more changed copies."""
    monkeypatch.setattr(shinglejoin, "HELD", bytes_held)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    star = []
    for i in range(60):
        text = list(base)
        at = rng.randrange(0, 295)
        text[at : at + 5] = [f"s{i}_{j}" for j in range(5)]
        star.append((i, " ".join(text)))
    chain = [(100 + i, " ".join([f"c{j}" for j in range(i * 6, 120 + i * 6)])) for i in range(30)]
    docs = [(99, " ".join(base)), *star, *chain]
    assert result(shinglejoin.joined(documents(*docs))) == by_hand(docs)


@pytest.mark.parametrize("bounds", ["small", "salted"])
def test_columns_named_like_those_in_between(documents, bounds, request):
    if bounds == "salted":
        request.getfixturevalue("small_bounds_off")
    names = ["node", "_node", "first", "_first", "copies", "_copies", "salt", "hot", "path", "links", "root", "body"]
    docs = documents((1, "a b c d e f"), (2, "a b c d e f"), (3, "x")).withColumns({c: F.lit(f"my {c}") for c in names})
    found = shinglejoin.one_of_each(docs).collect()
    assert sorted(r.doc_id for r in found) == [1, 3] and all(r[c] == f"my {c}" for r in found for c in names)


def test_sets_of_a_large_group_meet_tables_once(spark, documents, monkeypatch):
    """Near copies share many large buckets; no step joins a set to its own data per bucket."""
    monkeypatch.setattr(shinglejoin, "SMALL", 20)
    rng = random.Random(8)
    docs = []
    for i in range(120):
        text = [f"w{j}" for j in range(200)]
        text[rng.randrange(200)] = f"x{i}"
        docs.append((i, " ".join(text)))
    joins, mapped, written = [], [], shinglejoin.written

    def counted(frame, name):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        joins.extend(line for line in plan.splitlines() if "Join Inner, (node#" in line and "Hint" not in line)
        found = written(frame, name)
        if name in ("split", "large") and "node" in found.columns:
            mapped.append((found.count(), found.select("node").distinct().count()))
        return found

    monkeypatch.setattr(shinglejoin, "written", counted)
    assert result(shinglejoin.joined(documents(*docs))) == by_hand(docs)
    assert mapped and all(rows == nodes for rows, nodes in mapped)
    assert 0 < len(joins) <= shinglejoin.DEPTH - shinglejoin.START  # one per level; the comparison has none
