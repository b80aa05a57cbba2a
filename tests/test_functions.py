import posixpath

import pytest
from pyspark.sql import functions as F

from askframe.functions.lines import newline_count
from askframe.functions.messages import fill
from askframe.functions.paths import archive_name, base_name, clean_dir, dir_name
from askframe.operators.greeting import greet


@pytest.fixture(scope="module")
def greetings(spark):
    lines = {
        "plain": "Ann 25",
        "blanks": "\t Ann \t  25 \t",
        "one word": "Ann",
        "empty": "",
        "two-word name": "Ann Lee 25",
        "zero first": "Ann 010",
        "hex": "Ann 0x10",
        "fraction": "Ann 25.7",
        "largest": "Ann 9223372036854775807",
        "too large": "Ann 9223372036854775808",
        "negative": "Ann -1",
        "null": None,
    }
    table = spark.createDataFrame(list(lines.items()), "request_id string, line string")
    return {row.request_id: row for row in greet(table).collect()}


@pytest.mark.parametrize(
    "case, name, age_text, age, age_next",
    [
        ("plain", "Ann", "25", 25, 26),
        ("blanks", "Ann", "25", 25, 26),
        ("one word", "Ann", None, None, None),
        ("empty", "", None, None, None),
        ("two-word name", "Ann", "Lee 25", None, None),
        ("zero first", "Ann", "010", 10, 11),
        ("hex", "Ann", "0x10", None, None),
        ("fraction", "Ann", "25.7", None, None),
        ("largest", "Ann", "9223372036854775807", 2**63 - 1, None),
        ("too large", "Ann", "9223372036854775808", None, None),
        ("negative", "Ann", "-1", -1, 0),
        ("null", None, None, None, None),
    ],
)
def test_greeting(greetings, case, name, age_text, age, age_next):
    row = greetings[case]
    assert (row.name, row.age_text, row.age, row.age_next) == (name, age_text, age, age_next)
    if age_next is None:
        assert (row.status, row.message) == ("bad_age", None)
    else:
        assert row.status == "ok"
        assert row.message == f"Привет, {name}! Через год тебе будет {age_next} лет."


def test_greeting_template_is_an_argument(spark):
    table = spark.createDataFrame([("Ann 25",)], "line string")
    assert greet(table, template="{name}: {age_next}").first().message == "Ann: 26"


def test_fill_never_says_null(spark):
    row = spark.range(1).select(fill("<{a}>", a=F.lit(None)).alias("m"), fill("<{a}>", a=F.lit(7)).alias("n")).first()
    assert (row.m, row.n) == (None, "<7>")


def test_paths_are_posix(spark):
    paths = ["/a/b", "/a/b/", "a", "a/", "/", "", ".", "..", "a//b//", "/a", "a/b/c.txt", "a b/c d", "///"]
    path = F.col("p")
    table = spark.createDataFrame([(p,) for p in paths], "p string")
    for row in table.select("p", base_name(path).alias("base"), dir_name(path).alias("dir"), clean_dir(path).alias("clean")).collect():
        bare = row.p.rstrip("/") or row.p[:1]
        assert row.clean == bare
        assert row.base == ("/" if bare == "/" else posixpath.basename(bare))
        parent = posixpath.dirname(bare)
        assert row.dir == (parent or ".")


def test_paths_of_null(spark):
    path = F.lit(None).cast("string")
    assert tuple(spark.range(1).select(base_name(path), dir_name(path), clean_dir(path)).first()) == (None, None, None)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_archive_name_keeps_its_day_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = ["date '2018-11-04'", "timestamp_ntz '2018-11-04 00:00:00'", "timestamp '2018-11-04 23:59:59'"]
        for day in days:
            assert spark.range(1).select(archive_name(F.lit("x"), F.expr(day))).first()[0] == "x_2018-11-04.tar.gz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_newline_count(spark):
    texts = ["", "a", "a\n", "a\nb", "\n\n\n", "a\r\nb\r\n", "a\rb\n", "é\nü\n", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", newline_count(F.col("t")).alias("n")).collect()
    assert all(row.n == (None if row.t is None else row.t.count("\n")) for row in rows)
