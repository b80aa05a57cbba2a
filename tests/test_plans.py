"""What the plans must look like, whatever the size of the tables."""

import re

import pytest

from askframe.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_pairs_and_no_python_per_row(spark, key):
    text = plan(QUERIES[key](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


@pytest.mark.parametrize(
    "key",
    ["next_year_greeting", "greeting_bad_age", "newline_count", "path_parts", "dated_archive_name", "prefix_backup_first_run"],
)
def test_projections_do_not_shuffle(spark, key):
    assert "Exchange" not in plan(QUERIES[key](spark, SF_DIR))


@pytest.mark.parametrize(
    "key, columns",
    [
        ("newline_count", {"doc_id", "text"}),
        ("newline_total", {"text"}),
        ("newline_total_by_source", {"source", "text"}),
        ("newline_count_pages", {"page_id", "html"}),
        ("next_year_greeting", {"c_custkey", "c_name", "c_nationkey"}),
        ("dated_archive_name", {"o_orderkey", "o_orderdate"}),
        ("find_name_exists", {"url"}),
        ("present_directory", {"n_nationkey", "source"}),
        ("prefix_backup_second_run", {"s_name", "s_suppkey"}),
    ],
)
def test_only_needed_columns_are_read(spark, key, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[key](spark, SF_DIR)))
    assert {field.split(":")[0] for schema in schemas for field in schema.split(",")} == columns


@pytest.mark.parametrize("key, shuffles", [("newline_total_by_source", 1), ("newline_total", 1), ("backup_by_kind", 0)])
def test_shuffles(spark, key, shuffles):
    assert plan(QUERIES[key](spark, SF_DIR)).count("Exchange ") == shuffles


@pytest.mark.parametrize("key", ["newline_total_by_source", "directory_listing", "find_name_exists"])
def test_aggregation_starts_within_tasks(spark, key):
    before_shuffle = plan(QUERIES[key](spark, SF_DIR)).rsplit("Exchange ", 1)[1]
    assert "Aggregate" in before_shuffle.split("FileScan")[0]
