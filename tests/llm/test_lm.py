import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from askframe.llm import gru, lm
from askframe.llm.queries import op2_lm


@pytest.fixture
def tiny(monkeypatch):
    monkeypatch.setattr(gru, "HIDDEN", 4)
    monkeypatch.setattr(gru, "CLASSES", 3)
    monkeypatch.setattr(gru, "MEMBERS", 5)
    monkeypatch.setattr(gru, "IDS", 15)
    shapes = {"inputs": (15, 12), "gates": (4, 8), "candidate": (4, 4), "to_class": (4, 3), "class_bias": (3,), "to_member": (3, 4, 5), "member_bias": (3, 5), "start": (4,)}
    monkeypatch.setattr(gru, "SHAPES", shapes)
    rng = np.random.default_rng(1)
    return {name: rng.standard_normal(shape).astype(np.float64) * 0.5 for name, shape in shapes.items()}


def one_by_one(weights, text):
    hidden, total = weights["start"][None, :], 0.0
    for token in text:
        total += gru.log_probabilities(weights, hidden, np.array([token]))[0]
        hidden = gru.step(weights, np.array([token]), hidden)[0]
    return total


def test_probabilities_sum_to_one(tiny):
    hidden = np.random.default_rng(0).standard_normal((1, 4))
    logs = gru.log_probabilities(tiny, np.repeat(hidden, 15, axis=0), np.arange(15))
    assert np.exp(logs).sum() == pytest.approx(1)


def test_state_is_carried_across_windows(tiny, monkeypatch):
    monkeypatch.setattr(gru, "WINDOW", 7)
    monkeypatch.setattr(gru, "READ", 3)
    monkeypatch.setattr(gru, "FLUSH", 20)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 15, n) for n in (1, 50, 7, 8, 14, 3, 23)]
    assert gru.log_likelihoods(tiny, texts) == pytest.approx([one_by_one(tiny, t) for t in texts])
    assert gru.log_likelihoods(tiny, []).tolist() == []


def test_gradients_within_a_window(tiny):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 15, n) for n in (6, 4)]
    moved = {}

    def record(weight, seen, grad, rate):
        moved[id(weight)] = grad.copy()

    original = gru._move
    gru._move = record
    try:
        copy = {name: value.copy() for name, value in tiny.items()}
        seen = {name: np.full(value.shape, 1e-2) for name, value in tiny.items()}
        gru._window(copy, seen, texts, np.tile(copy["start"], (2, 1)), 0.0, True)
    finally:
        gru._move = original
    size = math.sqrt(10)
    for name in ("gates", "candidate", "to_class", "class_bias", "to_member", "member_bias", "start"):
        grad = moved[id(copy[name])]
        for at in [tuple(rng.integers(0, n) for n in tiny[name].shape) for _ in range(4)]:
            up, down = ({k: v.copy() for k, v in tiny.items()} for _ in "ab")
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = sum(one_by_one(down, t) - one_by_one(up, t) for t in texts) / 2e-5
            assert grad[at] * size == pytest.approx(slope, rel=1e-3, abs=1e-5)


def test_training_learns_an_order(tiny, monkeypatch):
    weights = {name: value.astype(np.float32) for name, value in tiny.items()}
    texts = [np.tile([1, 7, 12], 20) for _ in range(40)]
    before = gru.log_likelihoods(weights, texts).mean()
    for _ in range(4):
        weights = gru.train(weights, texts, 0.1)
    assert gru.log_likelihoods(weights, texts).mean() > before / 4
    assert all((gru.shaped(gru.flat(weights))[name] == weights[name]).all() for name in weights)


def by_hand(docs):
    found = {d: [*(t or "").encode().lower().split(), b""] for d, t in docs}
    learn = {d for d, _ in docs if zlib.crc32(str(d).encode()) % 7 != 2}
    counts = Counter(w for d in learn for w in found[d])
    n, v = sum(counts.values()), len(counts)
    return {
        d: (d not in learn, len(ws), sum(w in counts for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for d, ws in found.items()
    }


@pytest.mark.parametrize("frequent", [150_000, 50])
def test_query_against_brute_force(spark, sf_dir, monkeypatch, frequent):
    """Counts are exact whether they come from the broadcast table or the join."""
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "PART", 20_000)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = by_hand(docs)
    found = op2_lm(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == expected.keys() and len(found) == len(docs)
    for r in found:
        held, n, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    if frequent > 50:
        held_out = [r for r in found if r.held_out]
        assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_rare_tokens_have_probabilities_that_sum_to_one(spark):
    """Within an ending: every counted token, and all unseen ones together."""
    counts = spark.createDataFrame([(w.encode(), n) for w, n in (("the", 50), ("xing", 2), ("ying", 1), ("", 9))], "token binary, n long")
    original = gru.IDS
    try:
        gru.IDS = lm.RARE + 2  # two words of their own
        vocabulary = lm.make_vocabulary(counts)
    finally:
        gru.IDS = original
    ending = lm.ending(b"xing")
    assert 10 ** vocabulary.rests[ending] == pytest.approx((2 + 1) + (1 + 1) + 1)
    ids, places, rare = lm.encoded(b"The xing zing", vocabulary)
    assert rare == [b"zing"] and (places >= 0).tolist() == [True, True, False, True]
    assert ids[1] == ids[2] == vocabulary.endings[ending]
    assert sorted(vocabulary.frequencies, reverse=True) == vocabulary.frequencies.tolist()


def test_odd_rows(spark, documents):
    long = " ".join(f"W{i % 900}" for i in range(20_000))
    docs = documents((1, None), (1, ""), (None, "a\tA\x0b\x0cb"), (2, long), (3, "ÄÖ a b"), (3, "ÄÖ a b"))
    learn = F.col("doc_id").isNotNull()
    found = lm.score(docs, learn).collect()
    assert sorted(r.n_tokens for r in found) == [1, 1, 3, 3, 4, 20_001]
    assert len({r.train_tokens for r in found}) == 1
    assert all(r.score <= 0 and math.isfinite(r.score) for r in found)
    nothing = lm.score(docs, F.lit(False)).collect()
    assert all((r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) for r in nothing)
    assert lm.score(docs.limit(0), learn).collect() == []


def test_model_learns_from_every_training_document(spark, documents, monkeypatch):
    """However large the corpus: what the parts of all rounds were trained on adds up to it."""
    monkeypatch.setattr(lm, "FLOOR", 10, raising=False)  # as it was named when it bounded a sample
    monkeypatch.setattr(lm, "FEW", 10, raising=False)
    monkeypatch.setattr(lm, "PART", 2_000)
    trained, written = [], lm.written
    monkeypatch.setattr(lm, "written", lambda frame, name: trained.append(written(frame, name)) or trained[-1] if name == "weights" else written(frame, name))
    docs = documents(*[(i, " ".join(f"w{i * j % 97}" for j in range(i % 40))) for i in range(400)])
    found = lm.score(docs, F.col("doc_id") % 7 != 2).collect()
    learnt = sum(row.tokens for frame in trained for row in frame.where("block = 0").collect())
    assert len(found) == 400 and {r.train_tokens for r in found} == {learnt}


def test_words_of_many_texts_at_once(spark):
    """Texts are taken apart as arrays, with the words of a plain split; null and sliced ones too."""
    rng = np.random.default_rng(8)
    some = [bytes(rng.choice(list(b" \t\n\r\x0b\x0c\x1c\x85\x00AbZz\xc3\xa4"), n).tolist()) for n in range(60)]
    texts = [None, b"", b" ", b"\n", *some]
    for bodies in (pa.array(texts, pa.binary()), pa.array(texts, pa.binary()).slice(3, 40), pa.array([], pa.binary())):
        expected = [(body or b"").lower().split() for body in bodies.to_pylist()]
        found, lengths = lm.split(bodies)
        assert found.to_pylist() == [word for words in expected for word in words]
        assert lengths.tolist() == [len(words) for words in expected]


def test_rare_token_leaves_a_text_once(spark, documents, monkeypatch):
    """With its number there, so that no shuffle has to count it."""
    monkeypatch.setattr(lm, "FREQUENT", 1)
    held, written = {}, lm.written
    monkeypatch.setattr(lm, "written", lambda frame, name: held.setdefault(name, written(frame, name)))
    found = lm.score(documents((1, "new new New old"), (2, "old " * 50), (3, "new")), F.col("doc_id") == 2).collect()
    first = held["encoded"].where("doc_id = 1").first()
    assert {bytes(x["token"]): x["times"] for x in first.rare} | {b"old": 1, b"": 1} == {b"new": 3, b"old": 1, b"": 1}
    assert sorted((r.doc_id, r.n_tokens, r.n_known) for r in found) == [(1, 5, 2), (2, 51, 51), (3, 2, 1)]


@pytest.mark.parametrize("part", [500, 2_000, 10**6])
def test_every_round_takes_every_training_document(spark, documents, monkeypatch, part):
    """In a large corpus, of many parts, as in a small one, of one part."""
    monkeypatch.setattr(lm, "FEW", 10, raising=False)  # tokens beyond which a document was once in one round alone
    monkeypatch.setattr(lm, "PART", part)
    learnt, parts, written = [], [], lm.written

    def counted(frame, name):
        found = written(frame, name)
        if "weights" in found.columns:
            rows = found.where("block = 0").collect()
            learnt.append(sum(row.tokens for row in rows))
            parts.append(len(rows))
        return found

    monkeypatch.setattr(lm, "written", counted)
    docs = documents(*[(i, " ".join(f"w{i * j % 97}" for j in range(i % 40))) for i in range(400)])
    total = {r.train_tokens for r in lm.score(docs, F.col("doc_id") % 7 != 2).collect()}
    assert len(total) == 1 and learnt == [*total] * lm.ROUNDS and lm.ROUNDS > 1
    assert all((n > 1) == (part < 10**6) for n in parts)
