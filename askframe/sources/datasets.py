"""Whole datasets as entries: dated snapshots and prefixed copies."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from askframe.functions.messages import BACKUP_DIR_MISSING, BACKUP_PREFIX
from askframe.functions.paths import clean_dir
from askframe.operators.presence import few_keys, lookup
from askframe.operators.snapshot import plan_snapshots, report_snapshots
from askframe.sources.storage import children, literal_path, path_exists, refuse_overlap, refuse_own_input, replace_whole

CODEC = "gzip"
WRITERS = 8


def write_snapshots(
    records: DataFrame, requests: DataFrame, out: str, key: str = "source", day: str = "day", clustered: bool = False
) -> None:
    """One dated, compressed snapshot per request for a known source, in a single job.

    ``records`` holds all sources, told apart by ``key``, and is read once: a
    request for anything else finds no records. Every requested (source, day)
    becomes ``out/<key>=.../snapshot_date=...``; only the snapshots in this
    run are replaced, the others under ``out`` stay. A source of any size is
    split over tasks: rebalancing divides large partitions and joins small ones.
    ``clustered`` states that the records of a source lie together already, which
    saves that shuffle. Records that lie below ``out`` are refused: replacing
    snapshots would destroy them.
    """
    refuse_own_input(records, out)
    asked = requests.select(clean_dir(F.col(key)).alias(key), F.col(day).cast("date").alias("snapshot_date"))
    asked = asked.where((F.col(key) != "") & F.col("snapshot_date").isNotNull())
    days = asked.groupBy(key).agg(F.collect_set("snapshot_date").alias("_days"))
    values = few_keys(days, key)
    if values is not None:
        records = records.where(F.col(key).isin(values))
    dated = lookup(records, days, key).where("_days is not null")
    dated = dated.withColumn("snapshot_date", F.explode("_days")).drop("_days")
    if not clustered:
        # Without it, every task would leave a small file for every source it met.
        dated = dated.hint("rebalance", F.col(key), F.col("snapshot_date"))
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(key, "snapshot_date")
        .parquet(out)
    )


def take_snapshots(
    records: DataFrame, requests: DataFrame, out: str, key: str = "source", day: str = "day"
) -> DataFrame:
    """Writes the snapshots and answers the requests, success only after the commit."""
    write_snapshots(records, requests, out, key, day)
    return report_snapshots(plan_snapshots(requests, records, key, day), key, written=True)


def read_snapshots(spark: SparkSession, out: str, records: DataFrame) -> DataFrame:
    """The snapshots under ``out``, with the types of the ``records`` they hold.

    Without the schema a source called ``007`` would come back as a number.
    """
    schema = records.limit(0).withColumn("snapshot_date", F.lit(None).cast("date")).schema
    return spark.read.schema(schema).parquet(out)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that ``name=value`` directories stand for; looks at one branch."""
    names = []
    while True:
        step = next((c for c, is_dir in children(spark, path) if is_dir and "=" in c and c[0] not in "._"), None)
        if step is None:
            return names
        names.append(step.split("=", 1)[0])
        path = f"{path}/{step}"


def copy_dataset(
    spark: SparkSession, source: str, target: str, format: str = "parquet", codec: str | None = None, **options: str
) -> None:
    """Replaces ``target`` by a copy of ``source``, directory layout included.

    No shuffle: every task writes what it reads. ``options`` go to the reader and
    to the writer. The old target stays until the copy is whole (see ``replace_whole``).
    """
    refuse_overlap(spark, source, target)
    if format == "text":
        options = {"lineSep": "\n"} | options  # or a carriage return would end a line
    parts = partition_columns(spark, source)
    path = literal_path(source)
    found = spark.read.format(format).options(**options).load(path).schema
    inside = spark.read.format(format).options(**options | {"recursiveFileLookup": "true"}).load(path).columns
    if not {c for c in found.names if c not in inside} <= set(parts) <= set(found.names):
        raise ValueError(f"the directories of {source!r} have more than one layout")
    # As text, directory names such as day=01 stay as they are.
    schema = StructType([StructField(f.name, StringType()) if f.name in parts else f for f in found])
    records = spark.read.format(format).options(**options).schema(schema).load(path)
    writer = records.write.format(format).options(**options).mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    replace_whole(spark, target, writer.option("partitionOverwriteMode", "static").partitionBy(*parts).save)


def snapshot_dataset(
    spark: SparkSession, source: str, out: str, day: date, format: str = "parquet", **options: str
) -> str | None:
    """Writes ``out/<name>_<day>`` and returns it; None if there is no such source.

    A second run on the same day replaces the first.
    """
    if not source or not path_exists(spark, source):
        return None
    name = source.rstrip("/").rsplit("/", 1)[-1]
    target = f"{out.rstrip('/')}/{name}_{day.isoformat()}"
    copy_dataset(spark, source, target, format, codec=CODEC, **options)
    return target


ANSWERS = "name string, target string, status string, message string"


def backup_datasets(
    spark: SparkSession, directory: str, format: str = "parquet", prefix: str = BACKUP_PREFIX, **options: str
) -> list[str] | None:
    """Copies every visible dataset in a directory to its prefixed name.

    Returns the targets written, or None if there is no such directory.
    ``answer_dataset_backups`` tells why the others were not.
    """
    answers = _run_backups(spark, directory, format, prefix, options)
    return None if answers is None else sorted(target for _, target, status, _ in answers if status == "ok")


def answer_dataset_backups(
    spark: SparkSession, directory: str, format: str = "parquet", prefix: str = BACKUP_PREFIX, **options: str
) -> DataFrame:
    """A run of ``backup_datasets`` and one row per entry: ``ok``, or ``failed`` with
    the reason. A missing directory has one row, ``not_found`` and without a name."""
    answers = _run_backups(spark, directory, format, prefix, options)
    if answers is None:
        answers = [(None, None, "not_found", BACKUP_DIR_MISSING)]
    return spark.createDataFrame(answers, ANSWERS)


def _run_backups(spark: SparkSession, directory: str, format: str, prefix: str, options: dict) -> list[tuple] | None:
    """The names are listed once, beforehand, and taken in binary order. Only copies of
    copies depend on each other, so unrelated datasets are written side by side. An
    entry that cannot be copied does not keep the others from it."""
    if not path_exists(spark, directory):
        return None
    home = directory.rstrip("/")
    families: dict[str, list[str]] = {}
    for name, is_dir in children(spark, directory):
        # A file may be a dataset too, but not a marker such as _SUCCESS.
        if name[0] != "." and (is_dir or name[0] != "_"):
            root = name
            while root.startswith(prefix):
                root = root.removeprefix(prefix)
            families.setdefault(root, []).append(name)

    def run(names: list[str]) -> list[tuple]:
        answers = []
        for name in sorted(names, key=str.encode):
            target = f"{home}/{prefix}{name}"
            try:
                copy_dataset(spark, f"{home}/{name}", target, format, **options)
                answers.append((name, target, "ok", None))
            except (PySparkException, Py4JJavaError, ValueError) as reason:
                answers.append((name, target, "failed", str(reason).splitlines()[0]))
        return answers

    with ThreadPoolExecutor(WRITERS) as pool:
        return sorted(sum(pool.map(run, families.values()), []))
