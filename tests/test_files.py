import gzip
import os

import pytest
from pyspark.sql import functions as F

from askframe.operators.newlines import total_newlines
from askframe.sources import text_files
from askframe.sources.manifest import files, list_tree, manifest_from_paths, readable_files, visible_entries
from askframe.sources.storage import full_path, scratch_path
from askframe.sources.text_files import answer_line_counts, count_by_lines, count_by_ranges, count_files

BOM = b"\xef\xbb\xbf"
CONTENTS = {
    "empty": b"",
    "unterminated": b"a\nb",
    "terminated": b"a\nb\n",
    "crlf": b"a\r\nb\r\n",
    "lone cr": b"a\rb\n",
    "blank+lines": b"\n\n\n",
    "bom": BOM + b"a\nb\n",
    "bom unterminated": BOM + b"a\nb",
    "bom only": BOM,
    "bom line": BOM + b"\n",
    "not utf8": b"\xff\xfe\x00a\n\x80\n",
    "one line": b"x" * 300,
    "name%20é.txt": b"\n",
    ".hidden": b"1\n2\n",
    "_private": b"1\n2\n3\n",
    "part._COPYING_": b"1\n",
    "packed.gz": gzip.compress(b"\n" * 5000, mtime=0) + b"\n",
    "at 12:30.log": b"1\n2\n",
    "a[b]{c}*?.txt": b"1\n",
    "sub/.dir/deep": b"1\n",
    "sub/_dir/deep": b"1\n",
    "sub/k=v/deep": b"1\n2",
    "large": b"0123456\n" * 200_000 + b"end",
}


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree dir")
    for name, content in CONTENTS.items():
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
    (root / "sub" / "link").symlink_to(root / "large")
    return root


def expected(root):
    return {f"file:{root}/{name}": content.count(b"\n") for name, content in CONTENTS.items()}


def as_dict(counts):
    rows = counts.collect()
    assert len(rows) == len({r.path for r in rows})
    return {r.path: r.newline_count for r in rows}


def test_manifest(spark, tree):
    manifest = list_tree(spark, str(tree)).collect()
    kinds = {r.path: r.kind for r in manifest}
    assert len(kinds) == len(manifest)
    assert {p for p, k in kinds.items() if k == "file"} == expected(tree).keys()
    assert {p.rsplit("/", 1)[1] for p, k in kinds.items() if k == "dir"} == {"sub", ".dir", "_dir", "k=v"}
    assert [p for p, k in kinds.items() if k == "other"] == [f"file:{tree}/sub/link"]
    by_name = {r.name: r for r in manifest}
    assert by_name["large"].length == len(CONTENTS["large"])
    assert by_name["large"].parent == f"file:{tree}"
    assert abs(by_name["large"].modified.timestamp() - os.stat(tree / "large").st_mtime) < 1


def test_readable_files(spark, tree):
    found = readable_files(spark, str(tree))
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
    known = {r.path: r for r in files(list_tree(spark, str(tree))).collect()}
    rows = {r.path: r for r in found.collect()}
    rows.pop(f"file:{tree}/sub/link")
    assert {n: rows[n].length for n in rows} == {
        path: row.length
        for path, row in known.items()
        if row.length and "/." not in path and "/_" not in path and not path.endswith("._COPYING_")
    }
    assert all(rows[n].parent == known[n].parent and rows[n].name == known[n].name for n in rows)


def test_one_level(spark, tree):
    names = {r.name for r in list_tree(spark, str(tree), recursive=False).collect()}
    assert names == {n.split("/")[0] for n in CONTENTS}
    parent = full_path(spark, str(tree))
    visible = visible_entries(list_tree(spark, str(tree)), parent)
    assert {r.name for r in visible.collect()} == {n for n in names if not n.startswith(".")}


def test_empty_directory(spark, tmp_path):
    assert list_tree(spark, str(tmp_path)).collect() == []
    assert count_files(spark, str(tmp_path)).collect() == []


def test_count_files(spark, tree):
    assert as_dict(count_files(spark, str(tree))) == expected(tree)
    assert as_dict(count_files(spark, str(tree), raw=True)) == expected(tree)


def test_count_files_in_small_splits(spark, tree):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert as_dict(count_files(spark, str(tree))) == expected(tree)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_text_reader_alone(spark, tree):
    counts = as_dict(count_by_lines(spark, str(tree)))
    counts.pop(f"file:{tree}/sub/link")
    assert all(expected(tree)[path] == count for path, count in counts.items())
    assert f"file:{tree}/packed.gz" not in counts


def test_ranges(spark, tree, monkeypatch):
    manifest = files(list_tree(spark, str(tree)))
    assert as_dict(count_by_ranges(manifest)) == expected(tree)
    monkeypatch.setattr(text_files, "RANGE_BYTES", 1000)
    monkeypatch.setattr(text_files, "READ_BYTES", 300)
    assert as_dict(count_by_ranges(manifest)) == expected(tree)


@pytest.mark.parametrize("bounded", [True, False])
def test_requests(spark, tree, bounded, request, monkeypatch):
    if not bounded:
        monkeypatch.setattr(text_files, "fits_broadcast", request.getfixturevalue("nothing_fits"))
    home = f"file:{tree}"
    asked = [f"{home}/terminated"] * 2 + [f"{home}/.hidden", f"{home}/empty", f"{home}/nope", f"{home}/sub", None]
    requests = spark.createDataFrame(list(enumerate(asked)), "request_id int, path string")
    answers = answer_line_counts(requests, list_tree(spark, str(tree)))
    assert answers.columns == ["request_id", "path", "newline_count", "status"]
    assert [(r.newline_count, r.status) for r in sorted(answers.collect())] == [
        (2, "ok"),
        (2, "ok"),
        (2, "ok"),
        (0, "ok"),
        (None, "not_found"),
        (None, "not_found"),
        (None, "no_request"),
    ]


def test_names_that_are_not_utf8(spark, tmp_path):
    root = os.fsencode(tmp_path) + b"/tree"
    os.mkdir(root)
    os.mkdir(root + b"/d\xfe%")
    contents = {b"bad\xff": b"1\n2\n", b"bad%FF": b"1\n", b"_bad\xfe": b"\n", b"d\xfe%/x": b"\n\n\n", b"d\xfe%/y\xfd": b"\n" * 7}
    for name, content in contents.items():
        with open(root + b"/" + name, "wb") as file:
            file.write(content)
    found = as_dict(count_files(spark, os.fsdecode(root)))
    home = f"file:{os.fsdecode(root)}"
    assert found == {
        f"{home}//bad%FF": 2, f"{home}/bad%FF": 1, f"{home}//_bad%FE": 1, f"{home}//d%FE%25/x": 3, f"{home}//d%FE%25//y%FD": 7
    }


def test_listing_goes_on(spark, tmp_path):
    gone = list_tree(spark, str(tmp_path / "nope")).collect()
    assert [(r.kind, r.name) for r in gone] == [("error", "nope")] and "FileNotFoundError" in gone[0].error
    assert count_files(spark, str(tmp_path / "nope")).collect() == []
    (tmp_path / "there").write_bytes(b"\n")
    rows = spark.createDataFrame([(f"file:{tmp_path}/there", 1), (f"file:{tmp_path}/vanished", 5)], "path string, length long")
    manifest = manifest_from_paths(rows)
    answers = answer_line_counts(manifest.select("path"), manifest).collect()
    assert {(r.path.rsplit("/", 1)[1], r.newline_count, r.status) for r in answers} == {("there", 1, "ok"), ("vanished", None, "unreadable")}


def test_links_are_no_files(spark, tree):
    requests = spark.createDataFrame([(f"file:{tree}/sub/link",)], "path string")
    answers = answer_line_counts(requests, list_tree(spark, str(tree))).collect()
    assert [(r.newline_count, r.status) for r in answers] == [(None, "no_file")]


def test_tasks_follow_the_bytes(spark):
    one = spark.range(100).select(F.concat(F.lit("file:/x"), "id").alias("path"), F.lit(1000 * text_files.RANGE_BYTES).alias("length"))
    plan = count_by_ranges(one)._jdf.queryExecution().executedPlan().toString()
    assert f", {100_000 // text_files.RANGES_PER_TASK})" in plan


def test_totals(spark):
    contents = ["", "a\nb", "a\nb\n", "a\r\nb\r\n", "a\rb\n", "\n\n\n"]
    table = spark.createDataFrame([(c,) for c in contents], "text string")
    assert total_newlines(table).first().newline_count == sum(c.count("\n") for c in contents)
    assert total_newlines(table.limit(0)).first().newline_count == 0


def test_inventory(spark):
    paths = spark.createDataFrame([("/a/b/", 7), ("c", 8)], "path string, length int")
    rows = manifest_from_paths(paths).collect()
    assert [(r.path, r.parent, r.name, r.kind, r.length, r.modified) for r in rows] == [
        ("/a/b", "/a", "b", "file", 7, None),
        ("c", ".", "c", "file", 8, None),
    ]


def test_scratch_is_where_the_session_says(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir") + "/askframe-x-")
    assert path != scratch_path(spark, "x")
