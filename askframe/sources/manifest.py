"""Manifests: one row per entry of a directory tree."""

from __future__ import annotations

import os
import stat
from collections.abc import Iterator
from contextlib import closing
from datetime import datetime, timezone
from functools import reduce
from itertools import islice
from urllib.parse import quote_from_bytes, unquote_to_bytes

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askframe.functions.paths import base_name, clean_dir, dir_name, is_hidden
from askframe.sources.storage import full_path, literal_path, scratch_path, task_count

SCHEMA = "path string, parent string, name string, kind string, length bigint, modified timestamp, error string"
LISTED_ROWS = 10_000
DIRECTORIES_PER_TASK = 256


def files(manifest: DataFrame) -> DataFrame:
    """Regular files, hidden and empty ones too."""
    return manifest.where("kind = 'file'")


def visible_entries(manifest: DataFrame, parent: str | None = None) -> DataFrame:
    """The entries that ``*`` stands for, in one directory or in each of them."""
    if parent is not None:
        manifest = manifest.where(F.col("parent") == parent)
    return manifest.where(~is_hidden(F.col("name")))


def manifest_from_paths(paths: DataFrame, path: str = "path", kind: str | None = None) -> DataFrame:
    """A manifest out of a storage inventory: the way to go for very large trees.

    Columns of the inventory called ``length``, ``modified`` and ``error`` are taken over.
    """
    whole = F.col(path)

    def given(column: str, type_: str):
        value = F.col(column) if column in paths.columns else F.lit(None)
        return value.cast(type_).alias(column)

    return paths.select(
        clean_dir(whole).alias("path"),
        dir_name(whole).alias("parent"),
        base_name(whole).alias("name"),
        (F.col(kind) if kind else F.lit("file")).alias("kind"),
        given("length", "bigint"),
        given("modified", "timestamp"),
        given("error", "string"),
    )


def list_tree(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Everything below a directory, found level by level.

    Each level is one job in which every directory is listed on its own, so a
    deep or lopsided tree spreads over the cluster. Levels are written to the
    shared scratch folder: the next one and the result read them from there, and
    a lost executor costs no second listing. The executors need to reach the
    storage through pyarrow.

    A directory that is missing, vanishes or cannot be read does not end the run: it
    has a row of kind ``error`` with the reason in ``error``. A name that is not UTF-8
    is written in percent form behind two slashes, which no other path has, and
    opens as it is.
    """
    scratch = scratch_path(spark, "tree")
    start = full_path(spark, root)
    frontier = spark.range(1).select(F.lit(start).alias("path"))
    levels = []
    while True:
        level = f"{scratch}/level={len(levels)}"
        spread = frontier.repartition(task_count(spark, frontier.count(), DIRECTORIES_PER_TASK), "path") if levels else frontier
        spread.mapInPandas(_list_directories, SCHEMA).write.parquet(level)
        levels.append(spark.read.schema(SCHEMA).parquet(level))
        frontier = levels[-1].where("kind = 'dir'").select("path")
        if not recursive or frontier.isEmpty():
            return reduce(DataFrame.unionByName, levels)


def readable_files(spark: SparkSession, root: str) -> DataFrame:
    """The files below a directory that Spark's own readers would take.

    Listed in the JVM, contents unread. Left out are empty files and whatever has
    a name, or lies in a directory with a name, that starts with ``.`` or ``_``:
    where these matter, take ``list_tree``.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(literal_path(root))
    return manifest_from_paths(found.select("path", "length", F.col("modificationTime").alias("modified")))


def open_storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path as that system wants it."""
    return fs.FileSystem.from_uri(path)


def local_path(path: str) -> bytes:
    """A path of the local file system as the bytes it is known by there."""
    first, *odd = path.removeprefix("file:").split("//")
    parts = [os.fsencode(first)]
    for rest in odd:
        name, *inside = rest.split("/", 1)
        parts.append(b"/".join([unquote_to_bytes(name), *map(os.fsencode, inside)]))
    return b"/".join(parts)


def _shown(name: bytes) -> tuple[str, str]:
    """What stands between directory and name, and the name."""
    try:
        return "/", name.decode("utf-8")
    except UnicodeDecodeError:
        return "//", quote_from_bytes(name, safe=b" !#$&'()*+,:;=@[]")


def _list_directories(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [field.split()[0] for field in SCHEMA.split(", ")]
    found = (row for batch in batches for directory in batch["path"] for row in _list_or_tell(directory))
    while rows := list(islice(found, LISTED_ROWS)):
        yield pd.DataFrame(rows, columns=columns)


def _list_or_tell(directory: str) -> Iterator[tuple]:
    try:
        for row in _list_local(directory) if directory.startswith("file:") else _list_remote(directory):
            yield *row, None
    except OSError as reason:
        parent, _, name = directory.rpartition("/")
        yield directory, parent, name, "error", 0, None, f"{type(reason).__name__}: {reason.strerror or reason}"


def _list_local(directory: str) -> Iterator[tuple]:
    with closing(os.scandir(local_path(directory))) as entries:
        for entry in entries:
            # Links and special files are neither file nor directory here.
            try:
                info = entry.stat(follow_symlinks=False)
            except FileNotFoundError:  # gone since it was listed
                continue
            kind = "file" if stat.S_ISREG(info.st_mode) else "dir" if stat.S_ISDIR(info.st_mode) else "other"
            between, name = _shown(entry.name)
            modified = datetime.fromtimestamp(info.st_mtime, timezone.utc)
            yield f"{directory.rstrip('/')}{between}{name}", directory, name, kind, info.st_size if kind == "file" else 0, modified


def _list_remote(directory: str) -> Iterator[tuple]:
    storage, inner = open_storage(directory)
    kinds = {fs.FileType.File: "file", fs.FileType.Directory: "dir"}
    for info in storage.get_file_info(fs.FileSelector(inner)):
        kind = kinds.get(info.type, "other")
        yield f"{directory.rstrip('/')}/{info.base_name}", directory, info.base_name, kind, info.size or 0, info.mtime
