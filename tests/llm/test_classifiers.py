import numpy as np
import pytest
from pyspark.sql import functions as F

from askframe.llm import quality, toxicity
from askframe.llm.learning import calibrated
from askframe.llm.queries import op1_toxicity, op9_quality


def subsequences(word):
    """Weights of triples within the span, by definition of the kernel."""
    codes = [toxicity.BEGIN, *map(toxicity.code, word), toxicity.END]
    found = {}
    for i in range(len(codes)):
        for j in range(i + 1, len(codes)):
            for k in range(j + 1, min(len(codes), i + toxicity.SPAN)):
                key = (codes[i], codes[j], codes[k])
                found.setdefault(key, []).append(toxicity.DECAY ** (k - i + 1))
    return found


def test_kernel_by_definition():
    names = ["idiot", "idi*ot", "thing", "a", "banana", "ä"]
    codes = toxicity.encode(names)
    got = toxicity.kernel(codes, codes)
    for i, a in enumerate(map(subsequences, names)):
        for j, b in enumerate(map(subsequences, names)):
            raw = sum(sum(a[key]) * sum(b[key]) for key in a.keys() & b.keys())
            scale = [np.sqrt(sum(w * w for ws in s.values() for w in ws)) for s in (a, b)]
            assert got[i, j] == pytest.approx(raw / scale[0] / scale[1])
    assert np.linalg.eigvalsh(got).min() > -1e-9
    # Gaps cost, but less than being another word.
    assert got[0, 0] > got[0, 1] > 0.4 > got[0, 2]


def test_machine_as_a_table_is_the_machine_on_features():
    rng = np.random.default_rng(0)
    letters = list("abcdefg")
    names = ["".join(rng.choice(letters, 6)) for _ in range(60)]
    codes, to_features = toxicity.nystroem(names[:20])
    weights = rng.standard_normal(to_features.shape[1])
    on_features = toxicity.kernel(toxicity.encode(names), codes) @ to_features @ weights
    table = sum(share * toxicity.profile(row) for share, row in zip(to_features @ weights, codes))
    assert toxicity.Machine(table, 0.25).margins(names) == pytest.approx(on_features + 0.25, abs=1e-3)


def test_words():
    assert toxicity.words_of("You i d i o t, id-iot! 'Quoted'") >= {"you", "idiot", "id-iot", "quoted"}
    pieces = toxicity.words_of("x" * 15 + "insult" + "y" * 30)
    assert any("insult" in p for p in pieces) and max(map(len, pieces)) <= toxicity.LONGEST
    assert toxicity.words_of(" \n ... ") == set()


def test_long_runs_are_read_to_their_end():
    for n in (1, 9, 10, 15, 500):
        apart = " ".join("x" * n + "zorkwit")
        dashed = "-".join(["ab"] * n + list("zorkwit"))
        for text in (apart, dashed, dashed + "-" + dashed):
            found = toxicity.words_of(text)
            assert any("zorkwit" in word for word in found)
    assert max(map(len, toxicity.words_of(" ".join("x" * 14_000)))) <= toxicity.LONGEST


def insulting(rng, i, toxic):
    words = ["".join(rng.choice(list("aeioulmnrst"), rng.integers(2, 8))) for _ in range(rng.integers(5, 60))]
    if toxic:
        for insult in rng.choice(["zorkwit", "blaghead", "drexel"], 2):
            at = rng.integers(1, len(insult))
            words.insert(int(rng.integers(len(words))), str(insult) if i % 3 else insult[:at] + "*" + insult[at:])
    return " ".join(words)


def test_toxicity_finds_gapped_insults_it_has_not_seen(spark, documents):
    rng = np.random.default_rng(5)
    rows = [(i, insulting(rng, i, i % 4 == 0)) for i in range(400)]
    docs = documents(*rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    probes = documents(*rows[300:], (1000, "nice zor.kwit here"), (1001, "you b l a g h e a d"), (1002, "nice weather here"), (1003, None), (1004, ""))
    score = {r.doc_id: r.score for r in toxicity.score(probes, model).collect()}
    assert all((score[i] >= 0.3) == (i % 4 == 0) for i in range(300, 400))
    assert score[1000] >= 0.3 and score[1001] >= 0.3
    assert score[1002] < 0.3 and score[1003] == score[1004] < 0.3


@pytest.mark.parametrize("operator, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows(spark, documents, operator, label):
    docs = documents((1, "a"), (1, "a"), (None, None), (2, ""), (3, "x " * 20_000)).withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7), (99, 1)], f"doc_id long, {label} int")
    model = operator.train(docs, labels, F.lit(True))
    # The two rows of document 1 have the lesser label, 0; that is too little to learn from.
    assert model == pytest.approx(1 / 4)
    found = operator.score(docs, model)
    assert found.columns == [*docs.columns[:-1], "score"]
    assert [r.score for r in found.collect()] == [0.25] * 5
    assert operator.score(docs.limit(0), model).collect() == []
    assert operator.train(docs.limit(0), labels, F.lit(True)) == 0.5


def test_toxicity_sends_a_text_to_its_tasks_once(spark, documents):
    # A second column of the text as bytes doubled the batches; a column of that name was lost.
    docs = documents((1, "a"), (2, None), (3, "\u00e9 \U0001f600")).withColumn("_body", F.lit("mine"))
    scored = toxicity.score(docs, toxicity.Machine(np.zeros(toxicity.CODES**3), -1.0))
    assert scored.columns == [*docs.columns, "score"]
    assert "cast(text" not in scored._jdf.queryExecution().analyzed().toString()
    found = sorted(scored.collect(), key=lambda r: r.doc_id)
    assert [r[:-1] for r in found] == [tuple(r) for r in docs.orderBy("doc_id").collect()]
    assert found[0].score == pytest.approx(1 / (1 + np.e)) and found[1].score == pytest.approx(1 / (1 + np.e**2))


def test_quality_of_made_texts(spark, documents):
    rng = np.random.default_rng(1)

    def text(good):
        words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(rng.integers(20, 200))]
        return " ".join(words).capitalize() + "." if good else "!! ".join([words[0].upper()] * len(words))

    rows = [(i, text(i % 5 > 0)) for i in range(500)]
    docs = documents(*rows, (900, None), (901, ""))
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(400)], "doc_id long, quality int")
    model = quality.train(docs, labels, F.lit(True))
    score = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert all((score[i] >= 0.3) == (i % 5 > 0) for i in range(400, 500))
    assert 0 <= score[900] == score[901] <= 1


def test_difference_is_that_of_the_densities():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.standard_normal((200, 3)), rng.standard_normal((100, 3)) * 2 + 1])
    y = np.array([1] * 200 + [0] * 100)
    model = quality.Discriminant(x, y, (1 / 3, 2 / 3), 0.0, 1e-12)
    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9)

    def log_density(label):
        g = z[y == label]
        d, c = z - g.mean(axis=0), np.cov(g, rowvar=False, bias=True)
        return -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) + np.linalg.slogdet(c)[1])

    assert model.difference(x) == pytest.approx(log_density(1) - log_density(0) + np.log(2), abs=1e-6)


def test_calibration_follows_the_labels():
    rng = np.random.default_rng(3)
    x = rng.standard_normal(4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(int)
    assert calibrated(x[:, None], y, np.ones(4000)) == pytest.approx([2, -1], abs=0.25)


@pytest.mark.parametrize("query, label, held, accuracy", [(op9_quality, "quality", "doc_id", 0.95), (op1_toxicity, "toxic", "doc_id", 0.93)])
def test_held_out_accuracy(spark, query, label, held, accuracy):
    sf_dir = "/root/testdata/sf0.01"
    found = query(spark, sf_dir)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.where("score < 0 or score > 1 or score is null or (score >= 0.3) != (predicted = 1)").count() == 0
    judged = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out")
    right = judged.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
    assert right >= accuracy
