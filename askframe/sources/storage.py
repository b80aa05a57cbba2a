"""Paths on any Hadoop file system, and the shared scratch folder."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """The path with scheme and authority, and its file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(jvm_path), system


def full_path(spark: SparkSession, path: str) -> str:
    return hadoop_path(spark, path)[0].toString()


def literal_path(path: str) -> str:
    """The path as Spark's readers want it where it stands for itself: they take
    names with brackets, braces, stars and question marks for patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def path_exists(spark: SparkSession, path: str) -> bool:
    qualified, system = hadoop_path(spark, path)
    return system.exists(qualified)


def children(spark: SparkSession, path: str) -> Iterator[tuple[str, bool]]:
    """Names one level below and whether they are directories, one at a time."""
    qualified, system = hadoop_path(spark, path)
    found = system.listStatusIterator(qualified)
    while found.hasNext():
        child = found.next()
        yield child.getPath().getName(), child.isDirectory()


def refuse_overlap(spark: SparkSession, source: str, target: str) -> None:
    """Overwriting a target inside its source, or the other way round, destroys the source."""
    one, other = (full_path(spark, p).rstrip("/") + "/" for p in (source, target))
    if one.startswith(other) or other.startswith(one):
        raise ValueError(f"cannot write {target!r} from {source!r}: one contains the other")


def refuse_own_input(records: DataFrame, out: str) -> None:
    """A table that is read from ``out``, from below it, or from above it, must not be
    written there. Looks at the roots of what the table reads, not at its files."""
    spark = records.sparkSession
    target = _plain(full_path(spark, out)).rstrip("/") + "/"
    for root in read_roots(records):
        above = _plain(unquote(root)).rstrip("/") + "/"
        if above.startswith(target) or target.startswith(above):
            raise ValueError(f"cannot write to {out!r}: the records are read from {root!r}")


def read_roots(records: DataFrame) -> list[str]:
    """The paths that a table's file sources were loaded from."""
    leaves = records._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths()
            found += [roots.apply(j).toUri().getPath() if roots.apply(j).toUri().getScheme() is None else roots.apply(j).toString() for j in range(roots.size())]
    return found


def replace_whole(spark: SparkSession, target: str, write: Callable[[str], None]) -> None:
    """Has ``write`` fill a path beside the target, and only then puts it in its place.

    If writing fails the target is as it was; a run that ends in between is finished
    or undone by the next one. One run per target at a time.
    """
    finish_replacing(spark, target)
    new, old = _beside(target)
    try:
        write(new)
    except BaseException:
        _delete(spark, new)
        raise
    if path_exists(spark, target):
        move(spark, target, old)
    move(spark, new, target)
    _delete(spark, old)


def finish_replacing(spark: SparkSession, target: str) -> None:
    """Brings a target into a whole state again: the old copy only steps aside for a
    new one that is complete, so what is missing is made up from either."""
    new, old = _beside(target)
    if path_exists(spark, old) and not path_exists(spark, target):
        move(spark, new if path_exists(spark, new) else old, target)
    _delete(spark, old)
    _delete(spark, new)


def _beside(target: str) -> tuple[str, str]:
    parent, _, name = target.rstrip("/").rpartition("/")
    beside = f"{parent}/.{name}" if parent else f".{name}"
    return f"{beside}.askframe-new", f"{beside}.askframe-old"


def move(spark: SparkSession, source: str, target: str) -> None:
    one, system = hadoop_path(spark, source)
    if not system.rename(one, hadoop_path(spark, target)[0]):
        raise OSError(f"cannot move {source!r} to {target!r}")


def _delete(spark: SparkSession, path: str) -> None:
    qualified, system = hadoop_path(spark, path)
    system.delete(qualified, True)


def _plain(path: str) -> str:
    return re.sub("^file:/+", "file:/", path)


def task_count(spark: SparkSession, rows: int = 0, rows_per_task: int = 1) -> int:
    """For work whose rows are small but take long: a count keeps adaptive
    execution from joining such partitions by their few bytes. It grows with the
    rows where these are known."""
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(least, -(-rows // rows_per_task))


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session,
    else the folder its checkpoints were set to, else the warehouse's."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    set_by_hand = spark.sparkContext.getCheckpointDir()
    if set_by_hand:
        return set_by_hand.rstrip("/").rsplit("/", 1)[0]
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``scratch_root``, never a folder of one machine's own."""
    return f"{scratch_root(spark)}/askframe-{name}-{uuid4().hex}"


def stored(table: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the scratch folder: for what is read several times."""
    path = scratch_path(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def remove_read(table: DataFrame) -> None:
    """Deletes the tables in the scratch folder that ``table`` reads: for when nothing else does."""
    spark = table.sparkSession
    root, system = hadoop_path(spark, scratch_root(spark))
    for name in read_roots(table):
        path = hadoop_path(spark, name)[0]
        if path.getParent().equals(root) and path.getName().startswith("askframe-"):
            system.delete(path, True)


def remove_scratch(spark: SparkSession) -> None:
    """Deletes everything that ``scratch_path`` has named, of other sessions too.

    For the end of a session: results that still read such tables are lost.
    """
    root, system = hadoop_path(spark, scratch_root(spark))
    if not system.exists(root):
        return
    for name in [name for name, _ in children(spark, root.toString()) if name.startswith("askframe-")]:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(root, name), True)
