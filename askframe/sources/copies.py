"""Byte-exact backups of whole directories: any files, whatever they hold.

``operators.trees`` says what a directory holds after a run and which entry each copy
comes from; here the bytes follow. A run has three steps, and a reader never sees a
file half written:

1. *Stage.* Tasks copy files into a hidden folder of the same directory. A large file
   is cut into ranges, which are written in place, so that a repeated task writes the
   same bytes again; on stores without random writes a file is one stream.
2. *Commit.* Once all is staged, the moves to be made are written down, then a marker.
3. *Swap.* Tasks rename what was staged: a file over the one it replaces, a new
   directory as a whole.

A run that ended before its marker has changed nothing, and the next run sweeps its
folder away; one that ended later is finished by the next: moves that were made are
passed over. All copies are made of what the directory held before the run. Links and
special files are not copied. One run per directory at a time.
"""

from __future__ import annotations

import errno
import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askframe.functions.messages import BACKUP_DIR_MISSING
from askframe.functions.paths import backup_name, is_hidden
from askframe.operators.presence import lookup, mark_present
from askframe.operators.trees import after_tree_backup
from askframe.sources.manifest import list_tree, local_path, open_storage
from askframe.sources.storage import full_path, hadoop_path, path_exists, stored, task_count

STAGE = ".askframe-run"
PLAN, MARKER = "_plan", "_COMMITTED"
RANGE_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
COPIES_PER_TASK = 64
MOVES_PER_TASK = 1_000
ANSWERS = "name string, target string, status string, message string"


def back_up_directory(spark: SparkSession, directory: str) -> DataFrame:
    """Copies every visible file and directory to its prefixed name, and answers for each.

    ``ok``, or ``failed`` with the reason, in which case the entry's target is as it was.
    A missing directory has one row, ``not_found`` and without a name.
    """
    home = full_path(spark, directory).rstrip("/")
    if not path_exists(spark, home):
        return spark.createDataFrame([(None, None, "not_found", BACKUP_DIR_MISSING)], ANSWERS)
    finish_run(spark, home)
    stage = f"{home}/{STAGE}"
    before = stored(list_tree(spark, home), "listed")
    listed = before.where("kind != 'error'")
    changed = _changed(spark, home, listed)
    staged = stored(_staged(changed, home, stage), "staged")
    unread = before.where("kind = 'error'").groupBy(_top(home, "path").alias("from")).agg(F.min("error").alias("unread"))
    told = lookup(changed.join(staged, "path", "left").withColumn("from", _top(home, "origin")), unread, "from")
    wrong = F.when(F.col("unread").isNotNull(), F.col("unread")).otherwise(F.col("wrong"))
    targets = told.groupBy(_top(home, "path").alias("top")).agg(F.min(wrong).alias("wrong"))
    targets = stored(targets, "targets")
    _commit(spark, _moves(changed, listed, targets, home, stage), stage)
    finish_run(spark, home)
    entries = listed.where((F.col("parent") == home) & ~is_hidden(F.col("name")) & F.col("kind").isin("file", "dir"))
    entries = entries.select("name", backup_name(F.col("name")).alias("top"))
    answered = lookup(entries, targets.withColumn("made", F.lit(True)), "top")
    message = F.when(F.col("made").isNull(), F.lit("an entry of another kind has the name")).otherwise(F.col("wrong"))
    status = F.when(F.col("made") & F.col("wrong").isNull(), "ok").otherwise("failed")
    return answered.select("name", F.concat(F.lit(home + "/"), "top").alias("target"), status.alias("status"), message.alias("message"))


def _top(home: str, path: str) -> Column:
    """The name of the entry of ``home`` that a path is or lies in."""
    return F.regexp_extract(F.substr(path, F.lit(len(home) + 1)), "^/+([^/]*)", 1)


def _changed(spark: SparkSession, home: str, listed: DataFrame) -> DataFrame:
    """What the run makes or replaces."""
    after = after_tree_backup(spark.createDataFrame([(home,)], "dir string"), listed)
    made = after.where((F.col("origin") != F.col("path")) & F.col("kind").isin("file", "dir"))
    return stored(made.select("path", "parent", "kind", "length", "origin"), "changed")


def _staged(changed: DataFrame, home: str, stage: str) -> DataFrame:
    """``path`` and what went ``wrong`` with it, if anything."""
    size = F.greatest("length", F.lit(1))
    starts = F.sequence(F.lit(0).cast("long"), size - 1, F.lit(RANGE_BYTES).cast("long"))
    cut = starts if home.startswith("file:") else F.array(F.lit(0).cast("long"))
    at = F.when(F.col("kind") == "file", cut).otherwise(F.array(F.lit(0).cast("long")))
    staged = F.concat(F.lit(stage), F.substr("path", F.lit(len(home) + 1))).alias("staged")
    ranges = changed.select("path", staged, "origin", "kind", "length", F.explode(at).alias("start"))
    many = changed.agg(F.sum(F.ceil(size / RANGE_BYTES))).first()[0] or 0
    spread = ranges.repartition(task_count(changed.sparkSession, int(many), COPIES_PER_TASK), "path", "start")
    return spread.mapInPandas(_copy, "path string, wrong string").groupBy("path").agg(F.min("wrong").alias("wrong"))


def _moves(changed: DataFrame, listed: DataFrame, targets: DataFrame, home: str, stage: str) -> DataFrame:
    """Of targets that are whole: files that replace files, and what is new in a directory
    that was there. Whatever is new below goes along."""
    good = targets.where("wrong is null").select("top")
    whole = mark_present(changed.withColumn("top", _top(home, "path")), good, "top", "good").where("good")
    known = mark_present(whole, listed.select("path").distinct(), "path", "was")
    above = listed.where("kind = 'dir'").select(F.col("path").alias("parent")).distinct()
    placed = mark_present(known, above, "parent", "held")
    units = placed.where(F.col("was") | F.col("held") | (F.col("parent") == home))
    staged = F.concat(F.lit(stage), F.substr("path", F.lit(len(home) + 1)))
    return units.select(staged.alias("staged"), "path")


def _commit(spark: SparkSession, moves: DataFrame, stage: str) -> None:
    moves.write.mode("overwrite").parquet(f"{stage}/{PLAN}")
    marker, system = hadoop_path(spark, f"{stage}/{MARKER}")
    system.create(marker, True).close()


def finish_run(spark: SparkSession, directory: str) -> None:
    """Makes the moves of a run that was committed, and clears its folder away."""
    home = full_path(spark, directory).rstrip("/")
    stage, system = hadoop_path(spark, f"{home}/{STAGE}")
    if not system.exists(stage):
        return
    if path_exists(spark, f"{home}/{STAGE}/{MARKER}"):
        plan = spark.read.schema("staged string, path string").parquet(f"{home}/{STAGE}/{PLAN}")
        spread = plan.repartition(task_count(spark, plan.count(), MOVES_PER_TASK), "path")
        wrong = stored(spread.mapInPandas(_move, "path string, wrong string"), "moved").where("wrong is not null").limit(1).collect()
        if wrong:
            raise OSError(f"{wrong[0]['path']}: {wrong[0]['wrong']}; what is left to be moved is in {stage}")
    system.delete(stage, True)


def _copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        wrong = []
        for staged, origin, kind, length, start in zip(batch["staged"], batch["origin"], batch["kind"], batch["length"], batch["start"]):
            try:
                if kind == "dir":
                    make_directory(staged)
                elif staged.startswith("file:"):
                    copy_range(origin, staged, start, length)
                else:
                    copy_stream(origin, staged, length)
                wrong.append(None)
            except OSError as reason:
                wrong.append(f"{type(reason).__name__}: {reason.strerror or reason}")
        yield pd.DataFrame({"path": batch["path"], "wrong": pd.array(wrong, dtype="string")})


def make_directory(path: str) -> None:
    if path.startswith("file:"):
        os.makedirs(local_path(path), exist_ok=True)
    else:
        storage, inner = open_storage(path)
        storage.create_dir(inner, recursive=True)


def copy_range(origin: str, staged: str, start: int, length: int) -> None:
    """One range, at its place in the staged file: other tasks write the others."""
    source, target = local_path(origin), local_path(staged)
    os.makedirs(os.path.dirname(target), exist_ok=True)
    left = min(RANGE_BYTES, length - start)
    with open(source, "rb") as from_, os.fdopen(os.open(target, os.O_CREAT | os.O_WRONLY, 0o666), "wb") as to:
        done = _copy_in_kernel(from_.fileno(), to.fileno(), start, left)
        left -= done
        from_.seek(start + done)
        to.seek(start + done)
        while left and (chunk := from_.read(min(CHUNK_BYTES, left))):
            to.write(chunk)
            left -= len(chunk)
        if left or (start + RANGE_BYTES >= length and from_.read(1)):
            raise OSError(errno.EBUSY, "the file changed while it was copied")


def _copy_in_kernel(source: int, target: int, start: int, length: int) -> int:
    """Copies what it can without moving bytes through this process, and says how many.
    File systems that cannot do it leave all, or the rest, to the caller."""
    done = 0
    try:
        while done < length and (n := os.copy_file_range(source, target, length - done, start + done, start + done)):
            done += n
    except (AttributeError, OSError):
        pass
    return done


def copy_stream(origin: str, staged: str, length: int) -> None:
    """A whole file, for stores that only write from the start on."""
    storage, inner = open_storage(origin)
    target = open_storage(staged)[1]
    storage.create_dir(target.rpartition("/")[0], recursive=True)
    with storage.open_input_stream(inner) as from_, storage.open_output_stream(target) as to:
        shutil.copyfileobj(from_, to, CHUNK_BYTES)
    if storage.get_file_info(target).size != length:
        raise OSError(errno.EBUSY, "the file changed while it was copied")


def _move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        wrong = []
        for staged, path in zip(batch["staged"], batch["path"]):
            try:
                move_into_place(staged, path)
                wrong.append(None)
            except OSError as reason:
                wrong.append(f"{type(reason).__name__}: {reason.strerror or reason}")
        yield pd.DataFrame({"path": batch["path"], "wrong": pd.array(wrong, dtype="string")})


def move_into_place(staged: str, path: str) -> None:
    """What is no longer staged was moved by an earlier attempt."""
    if path.startswith("file:"):
        one, other = local_path(staged), local_path(path)
        if os.path.lexists(one):
            os.replace(one, other)
        elif not os.path.lexists(other):
            raise FileNotFoundError(errno.ENOENT, "neither staged nor in place")
        return
    storage, one = open_storage(staged)
    other = open_storage(path)[1]
    there = storage.get_file_info([one, other])
    if there[0].type != fs.FileType.NotFound:
        if there[1].type == fs.FileType.File:
            storage.delete_file(other)
        storage.move(one, other)
    elif there[1].type == fs.FileType.NotFound:
        raise FileNotFoundError(errno.ENOENT, "neither staged nor in place")
