import pytest

import __spark_entry__ as driver
import corpus_pipeline
from askframe.llm.common import written
from askframe.llm.oracles import ORACLES
from askframe.llm.queries import QUERIES


def test_all_are_registered():
    assert {**QUERIES, "pipeline": corpus_pipeline.run}.items() <= driver.queries().items()
    assert ORACLES.items() <= driver.oracle_sql().items()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages(spark, sf_dir):
    first = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), "stage")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != "packing":
            assert docs.schema == first.schema
    assert {"bucket", "batch", "slot"} <= set(docs.columns)
    by_slot = docs.groupBy("bucket", "batch", "slot").count().where("count > 1")
    assert docs.count() > 0 and by_slot.count() == 0


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5)]])
def test_odd_tables(spark, tables, tmp_path, rows):
    rows = [(*row, "big", 5, "n") for row in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, score int, _node string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = corpus_pipeline.run(spark, tables(documents=docs, labels=labels)).collect()
    assert all(r.n_tokens in (0, 3) for r in found) and len(found) <= 4
    first = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert sorted(map(tuple, first.collect()), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("known", [[(1, 5, 1), (2, 5, 0), (3, 5, 1)], [(99, 5, 1)]])
def test_all_stay_where_toxicity_cannot_be_learnt(spark, documents, tables, known):
    docs = documents((1, "a"), (2, None), (3, ""), (4, "b"))
    sf_dir = tables(labels=spark.createDataFrame(known, "doc_id long, quality int, toxic int"))
    assert sorted(r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, sf_dir).collect()) == [1, 2, 3, 4]


def test_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in ORACLES.items():
        result = QUERIES[name](spark, sf_dir)
        columns = sorted(result.columns)
        expected = connection.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, result.select(*columns).collect())) == sorted(expected)
