import random

import pytest
from pyspark.sql import functions as F

from askframe.operators.backup import after_backup, answer_backups, run_backups

PREFIX = "backup_"


def one_run(directory, sources=None):
    """The loop, entry by entry: the list is fixed beforehand, contents are not."""
    after = dict(directory)
    for name in sorted(directory, key=str.encode):
        if not name.startswith(".") and (sources is None or name in sources):
            after[PREFIX + name] = after[name]
    return after


def test_first_run(spark):
    names = ["greet.sh", "search.sh", "notes.txt", "a b", "_private", "log"]
    entries = spark.createDataFrame([(n, n.upper()) for n in names], "name string, content string")
    after = {row.name: row.content for row in after_backup(entries).collect()}
    assert len(after) == 12
    assert all(after[PREFIX + n] == after[n] == n.upper() for n in names)


@pytest.mark.parametrize("seed", range(6))
def test_random_directories(spark, seed):
    rng = random.Random(seed)
    roots = ["x", "a", "Z", "backup", "bac", "b", "zz", ".hidden", "", "backup_", "ba ckup_", "é", "0"]
    directories = {}
    for place in "pqrs":
        names = {PREFIX * rng.choice([0, 0, 1, 2, 3, 5]) + rng.choice(roots) for _ in range(rng.randint(3, 25))} - {""}
        directories[place] = {name: rng.randint(0, 10**6) for name in names}
    rows = [(p, n, c) for p, entries in directories.items() for n, c in entries.items()]
    state = spark.createDataFrame(rows, "parent string, name string, content int")
    for _ in range(2):
        state = after_backup(state, within="parent")
        directories = {p: one_run(entries) for p, entries in directories.items()}
    got = [(r.parent, r.name, r.content) for r in state.collect()]
    assert sorted(got) == sorted((p, n, c) for p, entries in directories.items() for n, c in entries.items())


def test_null_content_is_content(spark):
    rows = [("a", None), (PREFIX + "a", 1), ("x", None), (PREFIX + "x", 2)]
    after = after_backup(spark.createDataFrame(rows, "name string, content int"))
    assert {r.name: r.content for r in after.collect()} == one_run(dict(rows))


def test_other_kinds_are_passed_over(spark):
    rows = [("x", "file", 1), ("d", "dir", 2), ("pipe", "other", 3), (".h", "file", 4)]
    after = after_backup(spark.createDataFrame(rows, "name string, kind string, content int")).collect()
    assert sorted(r.name for r in after) == sorted(["x", "d", "pipe", ".h", "backup_x", "backup_d"])


def test_other_kind_ends_a_chain(spark):
    rows = [("A", "file", 1), ("backup_A", "other", 2), ("backup_backup_A", "file", 3)]
    after = after_backup(spark.createDataFrame(rows, "name string, kind string, content int")).collect()
    assert {r.name: r.content for r in after} == {
        "A": 1,
        "backup_A": 1,
        "backup_backup_A": 3,
        "backup_backup_backup_A": 3,
    }


def test_first_run_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "entries")
    spark.range(100).select(F.concat(F.lit("n"), "id").alias("name"), "id").write.parquet(path)
    entries = spark.read.parquet(path)
    assert "Exchange" not in after_backup(entries)._jdf.queryExecution().toString()
    again = after_backup(entries, rerun=True)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1
    assert sorted(again.collect()) == sorted(after_backup(entries).collect())


def manifest_of(spark):
    rows = [("/", "/", "a", "dir"), ("/", "/", "b", "dir"), ("/a", "/a", "x", "file"), ("/a", "/a", "backup_x", "file"), ("/b", "/b", "y", "file")]
    rows = [(f"{p.rstrip('/')}/{n}", p, n, k) for p, _, n, k in rows]
    return spark.createDataFrame(rows, "path string, parent string, name string, kind string")


@pytest.mark.parametrize("bounded", [True, False])
def test_requests(spark, bounded, request):
    if not bounded:
        request.getfixturevalue("nothing_fits")
    requests = spark.createDataFrame([(1, "/a/"), (2, "/nope"), (3, "/a/x"), (4, None), (5, "")], "request_id int, dir string")
    answers = {r.request_id: (r.status, r.message) for r in answer_backups(requests, manifest_of(spark)).collect()}
    gone = ("not_found", "Директория не найдена!")
    assert answers == {1: ("ok", None), 2: gone, 3: gone, 4: ("no_request", None), 5: gone}
    after = run_backups(requests, manifest_of(spark)).collect()
    assert sorted((r.parent, r.name, r.path) for r in after) == [
        ("/a", "backup_backup_x", "/a/backup_x"),
        ("/a", "backup_x", "/a/x"),
        ("/a", "x", "/a/x"),
    ]
