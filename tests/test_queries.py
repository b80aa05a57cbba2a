"""Every registered query against its SQL."""

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as driver
from askframe.plans.oracles import ORACLES
from askframe.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def same_type(spark_type, sql_type):
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "double": "DOUBLE"}
    return names[spark_type] == sql_type


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= driver.queries().items() and ORACLES.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, key):
    result = QUERIES[key](spark, str(SF_DIR))
    relation = oracle.sql(ORACLES[key])
    columns = sorted(result.columns)
    assert columns == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert all(same_type(kind, types[name]) for name, kind in result.dtypes)
    expected = oracle.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[key]})").fetchall()
    assert Counter(map(tuple, result.select(*columns).collect())) == Counter(expected)


def test_entry(spark):
    answers = driver.entry(spark)
    assert answers.columns == ["pattern", "found", "message"]
    assert answers.count() == 6
