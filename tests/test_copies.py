"""Backups of directories byte for byte, and what happens when a run breaks off."""

import os
import random

import pytest

from askframe.sources import copies, storage
from askframe.sources.copies import back_up_directory, copy_stream, finish_run, move_into_place
from askframe.sources.datasets import copy_dataset
from askframe.sources.text_files import count_by_lines
from test_trees import run_by_hand


def read(directory):
    """A directory as nested dicts, files as their bytes."""
    return {e.name: read(e.path) if e.is_dir() else open(e.path, "rb").read() for e in os.scandir(directory)}


def write(directory, tree):
    os.makedirs(directory, exist_ok=True)
    for name, entry in tree.items():
        path = os.path.join(directory, name)
        if isinstance(entry, dict):
            write(path, entry)
        else:
            with open(path, "wb") as file:
                file.write(entry)


TREE = {
    "note.txt": b"a\r\n\xff\x00no newline",
    "empty": b"",
    ".hidden": b"h",
    "_marker": b"",
    "data.parquet": {"_SUCCESS": b"", ".part.crc": b"crc", "part-0": b"PAR1" * 999, "day=1": {"p[0]{1}": b"x", "void": {}}},
    "b ä+%20?": {"c:d": b"colon"},
}


def answers(spark, directory):
    return {a["name"]: (a["status"], a["message"]) for a in back_up_directory(spark, str(directory)).collect()}


def test_three_runs(spark, tmp_path, monkeypatch):
    """Ranges of seven bytes, so that most files are put together from several."""
    monkeypatch.setattr(copies, "RANGE_BYTES", 7)
    home, tree = tmp_path / "home", TREE | {"zoo": {"x": b"1"}}
    write(home, tree)
    for _ in range(3):
        expected = run_by_hand(tree)
        assert answers(spark, home) == {name: ("ok", None) for name in tree if name[0] != "."}
        tree = read(home)
        assert tree == expected
    assert "backup_zoo" in tree["backup_backup_zoo"] and "zoo" in tree["backup_zoo"]


def test_names_that_are_no_text(spark, tmp_path):
    home = os.fsencode(tmp_path / "home")
    os.makedirs(home + b"/d\xff")
    for name in (b"f\xfe", b"d\xff/in\xfd"):
        with open(home + b"/" + name, "wb") as file:
            file.write(name)
    back_up_directory(spark, str(tmp_path / "home"))
    assert open(home + b"/backup_f\xfe", "rb").read() == b"f\xfe"
    assert open(home + b"/backup_d\xff/in\xfd", "rb").read() == b"d\xff/in\xfd"


def test_an_entry_that_cannot_be_copied(spark, tmp_path, monkeypatch):
    """The others are copied; its target, here of an earlier run, is as it was."""
    home = tmp_path / "home"
    write(home, {"bad": {"one": b"1", "two": b"22"}, "good": b"g", "backup_file": {}, "file": b"", "way": {"x": b""}, "backup_way": b"w"})
    listing = copies.list_tree

    def stale(*args):
        """One file is shorter than it was when it was listed."""
        found = listing(*args).collect()
        return spark.createDataFrame([r.asDict() | {"length": 9} if r["name"] == "two" else r.asDict() for r in found], copies_schema)

    from askframe.sources.manifest import SCHEMA as copies_schema

    monkeypatch.setattr(copies, "list_tree", stale)
    found = answers(spark, home)
    assert found.pop("bad") == ("failed", "OSError: the file changed while it was copied")
    assert found.pop("way") == ("failed", "an entry of another kind has the name")
    assert set(found.values()) == {("ok", None)}
    tree = read(home)
    assert "backup_bad" not in tree and tree["backup_good"] == b"g" and tree["backup_file"] == {"file": b""} and tree["backup_way"] == b"w"
    assert copies.STAGE not in tree


def test_a_directory_that_cannot_be_listed(spark, tmp_path, monkeypatch):
    home = tmp_path / "home"
    write(home, {"a": {"x": b"1", "shut": {"y": b"2"}}, "b": b"3"})
    listing = copies.list_tree

    def shut(*args):
        found = [r.asDict() for r in listing(*args).collect()]
        at = next(r for r in found if r["name"] == "shut")
        rows = [r for r in found if r["name"] != "y"] + [at | {"kind": "error", "error": "PermissionError: no"}]
        return spark.createDataFrame(rows, SCHEMA)

    from askframe.sources.manifest import SCHEMA

    monkeypatch.setattr(copies, "list_tree", shut)
    assert answers(spark, home) == {"a": ("failed", "PermissionError: no"), "b": ("ok", None)}
    assert "backup_a" not in read(home)


def test_missing_and_empty_directories(spark, tmp_path):
    assert [tuple(a) for a in back_up_directory(spark, str(tmp_path / "nope")).collect()] == [(None, None, "not_found", "Директория не найдена!")]
    (tmp_path / "void").mkdir()
    assert back_up_directory(spark, str(tmp_path / "void")).collect() == [] and read(tmp_path / "void") == {}


def test_a_run_that_ends_before_its_marker_has_changed_nothing(spark, tmp_path, monkeypatch):
    home = tmp_path / "home"
    write(home, TREE | {"backup_note.txt": b"old"})

    def fails(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(copies, "_commit", fails)
        with pytest.raises(KeyboardInterrupt):
            back_up_directory(spark, str(home))
    left = read(home)
    assert left.pop(copies.STAGE) and left == TREE | {"backup_note.txt": b"old"}
    finish_run(spark, str(home))
    assert read(home) == left
    back_up_directory(spark, str(home))
    assert read(home) == run_by_hand(left)


def test_a_run_that_ends_between_its_moves_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    """Some moves made, some not; what is in place twice over stays as it is."""
    home = tmp_path / "home"
    tree = TREE | {"backup_note.txt": b"old", "backup_data.parquet": {"more": b"m"}}
    write(home, tree)
    with monkeypatch.context() as broken:
        broken.setattr(copies, "finish_run", lambda spark, home, real=finish_run: None if os.path.exists(f"{home.removeprefix('file:')}/{copies.STAGE}") else real(spark, home))
        back_up_directory(spark, str(home))
    stage = home / copies.STAGE
    assert (stage / copies.MARKER).exists() and (home / "backup_note.txt").read_bytes() == b"old"
    move_into_place(f"file:{stage}/backup_empty", f"file:{home}/backup_empty")
    finish_run(spark, str(home))
    assert read(home) == run_by_hand(tree)


def test_streams_for_stores_without_random_writes(tmp_path):
    write(tmp_path, {"a": b"12345", "d": {"x": b"0"}})
    root = f"file://{tmp_path}"  # as any store that pyarrow opens by its scheme
    copy_stream(f"{root}/a", f"{root}/stage/deep/a", 5)
    assert (tmp_path / "stage/deep/a").read_bytes() == b"12345"
    with pytest.raises(OSError):
        copy_stream(f"{root}/a", f"{root}/stage/b", 6)


def test_many_files_in_one_directory(spark, tmp_path):
    rng = random.Random(1)
    tree = {"hot": {f"f{i}": rng.randbytes(i % 50) for i in range(2000)}} | {f"n{i}": rng.randbytes(3) for i in range(200)}
    write(tmp_path / "home", tree)
    assert set(answers(spark, tmp_path / "home").values()) == {("ok", None)}
    assert read(tmp_path / "home") == run_by_hand(tree)


# Datasets replaced as a whole


def test_a_failed_copy_leaves_the_old_one(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "data"), str(tmp_path / "copy")
    spark.range(5).write.parquet(source)
    copy_dataset(spark, source, target)
    spark.range(9).write.mode("overwrite").parquet(source)
    broken = next((tmp_path / "data").glob("*.parquet"))
    broken.write_bytes(b"PAR1 no more")
    (tmp_path / "data" / f".{broken.name}.crc").unlink()
    with pytest.raises(Exception):  # noqa: B017
        copy_dataset(spark, source, target)
    assert spark.read.parquet(target).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["copy", "data"]


@pytest.mark.parametrize("ended", ["while writing", "between the moves", "before cleaning up", "before the second move, without the new one"])
def test_a_replacement_that_was_cut_off(spark, tmp_path, ended):
    target = str(tmp_path / "t")
    new, old = storage._beside(target)
    rows = {"while writing": {target: 1, new: 2}, "between the moves": {old: 1, new: 2}, "before cleaning up": {old: 1, target: 2}}.get(ended, {old: 1})
    for path, n in rows.items():
        spark.range(n).write.parquet(path)
    storage.finish_replacing(spark, target)
    expected = 1 if ended in ("while writing", "before the second move, without the new one") else 2
    assert spark.read.parquet(target).count() == expected and [p.name for p in tmp_path.iterdir()] == ["t"]
    storage.replace_whole(spark, target, lambda path: spark.range(3).write.parquet(path))
    assert spark.read.parquet(target).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_paths_are_not_taken_apart_for_every_line(spark, tmp_path):
    """Regular expressions on a file's path run once per file, behind the aggregation."""
    (tmp_path / "a.txt").write_bytes(b"1\n2\n3")
    (tmp_path / "b:c.txt").write_bytes(b"1\n")
    counted = count_by_lines(spark, str(tmp_path))
    plan = counted._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = plan[next(i for i, line in enumerate(plan) if "Aggregate" in line) + 1 :]
    assert below and not any(word in line.lower() for line in below for word in ("regexp", "rlike"))
    assert [(r.path.rsplit("/", 1)[1], r.newline_count) for r in counted.collect()] == [("a.txt", 2)]


@pytest.mark.parametrize("kernel", [True, False])
def test_ranges_are_copied_with_and_without_the_kernel(tmp_path, monkeypatch, kernel):
    def refused(*_):
        raise OSError(95, "not supported")

    if not kernel:
        monkeypatch.setattr(os, "copy_file_range", refused)
    monkeypatch.setattr(copies, "RANGE_BYTES", 1000)
    body = bytes(range(256)) * 11
    (tmp_path / "one").write_bytes(body)
    assert (copies._copy_in_kernel(os.open(tmp_path / "one", os.O_RDONLY), os.open(tmp_path / "by", os.O_CREAT | os.O_WRONLY), 0, 5) == 5) == kernel
    for start in (2000, 0, 1000):
        copies.copy_range(f"file:{tmp_path}/one", f"file:{tmp_path}/two", start, len(body))
    assert (tmp_path / "two").read_bytes() == body
    with pytest.raises(OSError, match="changed"):
        copies.copy_range(f"file:{tmp_path}/one", f"file:{tmp_path}/two", 2000, len(body) - 1)
