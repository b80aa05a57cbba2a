"""One query per operator; each reads whole tables below ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askframe.functions.globs import matches
from askframe.functions.paths import archive_name, base_name, dir_name
from askframe.operators.backup import after_backup, answer_backups, run_backups
from askframe.operators.greeting import greet, read_fields
from askframe.operators.newlines import count_newlines, total_newlines
from askframe.operators.presence import missing, present
from askframe.operators.search import found_patterns, search
from askframe.operators.snapshot import plan_snapshots, report_snapshots
from askframe.operators.trees import after_tree_backup, implied_directories
from askframe.sources.copies import back_up_directory
from askframe.sources.datasets import (
    answer_dataset_backups,
    backup_datasets,
    read_snapshots,
    snapshot_dataset,
    take_snapshots,
    write_snapshots,
)
from askframe.sources.manifest import files, list_tree, manifest_from_paths, visible_entries
from askframe.sources.requests import read_requests, write_messages
from askframe.sources.storage import literal_path, scratch_path, stored
from askframe.sources.text_files import answer_line_counts, count_files, plain_path
from askframe.streaming.answers import answer_stream

Query = Callable[[SparkSession, str], DataFrame]

DAY = date(2024, 2, 29)
PATTERNS = ["*.html", "1??", "[0-4]*", "[!0-4]*", "nope", ""]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as paths: without scheme, query and fragment."""
    path = F.regexp_replace("url", "^[a-z]+://|[?#].*$", "")
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"))


def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_from_paths(page_paths(spark, sf_dir))


# Greetings


def greeting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("  "), "c_name", F.lit(" \t "), "c_nationkey", F.lit("\t"))
    return table(spark, sf_dir, "customer").select("c_custkey", line.alias("line"))


def next_year_greeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = greet(greeting_lines(spark, sf_dir))
    return answers.select("c_custkey", "name", "age", "age_next", "message")


def greeting_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages that are numbers, words, and the last number there is."""
    last = F.when(F.col("p_size") > 40, F.lit(str(2**63 - 1))).when(F.col("p_size") > 20, F.lit("old"))
    line = F.concat_ws(" ", F.lit("x"), F.coalesce(last, F.col("p_size").cast("string"))).alias("line")
    answers = greet(table(spark, sf_dir, "part").select("p_partkey", line))
    return answers.select("p_partkey", "age", "status", "message")


def greeting_bad_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws(" ", "p_name", "p_size").alias("line")
    return read_fields(table(spark, sf_dir, "part").select("p_partkey", line))


def greeting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and answers as lines of files."""
    asked, said = scratch_path(spark, "asked"), scratch_path(spark, "said")
    greeting_lines(spark, sf_dir).select("line").write.text(asked)
    write_messages(greet(read_requests(spark, asked)), said)
    return spark.read.text(said).withColumnRenamed("value", "message")


def greeting_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greetings again, from a stream of requests."""
    customer = table(spark, sf_dir, "customer")
    arriving = (
        spark.readStream.schema(customer.schema)
        .option("pathGlobFilter", "customer.parquet")
        .parquet(sf_dir)
        .select("c_custkey", F.concat_ws(" ", "c_name", "c_nationkey").alias("line"))
    )
    out = scratch_path(spark, "answers")
    answer_stream(arriving, greet, out, scratch_path(spark, "checkpoint"), once=True).awaitTermination()
    return spark.read.parquet(out).select("c_custkey", "name", "age", "age_next", "message")


# Name search


def fixed_patterns(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p,) for p in PATTERNS], "pattern string")


def find_name_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = files(page_manifest(spark, sf_dir))
    return search(fixed_patterns(spark), names).select("pattern", "found", "message")


def find_one_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pattern, ending at the first match."""
    pattern = PATTERNS[0]
    first = files(page_manifest(spark, sf_dir)).where(matches(F.col("name"), pattern)).limit(1)
    return first.agg(F.lit(pattern).alias("pattern"), (F.count("*") > 0).alias("found"))


def find_name_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_patterns(fixed_patterns(spark), files(page_manifest(spark, sf_dir)))


def find_many_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four patterns per part: a plain name, two with literal text, one without."""
    size = F.col("p_size").cast("string")
    patterns = F.array(
        F.concat("p_partkey", F.lit(".html")),
        F.concat(size, F.lit("*.html")),
        F.concat(F.lit("?*"), size),
        F.concat(F.lit("["), F.substr(size, F.lit(1), F.lit(1)), F.lit("]??*")),
    )
    requests = table(spark, sf_dir, "part").select("p_partkey", F.explode(patterns).alias("pattern"))
    return search(requests, files(page_manifest(spark, sf_dir))).select("p_partkey", "pattern", "found", "message")


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files(page_manifest(spark, sf_dir)).select("path", "parent", "name", "kind")


def tree_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directories found in a tree that Spark has written."""
    return list_tree(spark, write_text_files(spark, sf_dir)).where("kind = 'dir'").select("name")


def directory_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth page is hidden."""
    hidden = F.when(F.col("page_id") % 10 == 0, F.regexp_replace("path", "([^/]*)/*$", ".$1")).otherwise(F.col("path"))
    manifest = manifest_from_paths(page_paths(spark, sf_dir).select(hidden.alias("path")))
    return visible_entries(manifest).select("parent", "name").distinct()


# Presence and snapshots


def source_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("src"), "n_nationkey").alias("dir")
    return table(spark, sf_dir, "nation").select(name, F.lit(DAY).alias("day"))


def document_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("dir"))


def missing_directory_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = missing(source_requests(spark, sf_dir), document_sources(spark, sf_dir), "dir")
    planned = rejected.withColumns({"status": F.lit("not_found"), "archive_name": F.lit(None).cast("string")})
    return report_snapshots(planned).select("dir", "message")


def present_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(source_requests(spark, sf_dir), document_sources(spark, sf_dir), "dir").select("dir")


def snapshot_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan_snapshots(source_requests(spark, sf_dir), document_sources(spark, sf_dir))
    return report_snapshots(planned).select("dir", "archive_name", "status", "message")


def taken_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: known and unknown sources, what was written counted beside the answers."""
    documents, out = table(spark, sf_dir, "documents"), scratch_path(spark, "taken")
    requests = source_requests(spark, sf_dir).withColumnRenamed("dir", "source")
    answers = take_snapshots(documents, requests, out)
    counts = read_snapshots(spark, out, documents).groupBy("source").agg(F.count("*").alias("records"))
    return answers.join(counts, "source", "left").select("source", "archive_name", "status", "message", "records")


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    return page_paths(spark, sf_dir).select("page_id", base_name(path).alias("base"), dir_name(path).alias("dir"))


def dated_archive_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("o_orderkey").cast("string")
    name = archive_name(base, F.col("o_orderdate")).alias("archive_name")
    return table(spark, sf_dir, "orders").select("o_orderkey", name)


def dated_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources written, one of them again on the same day, all read back."""
    documents = table(spark, sf_dir, "documents")
    requests = documents.select("source", F.lit(DAY).alias("day")).distinct()
    out = scratch_path(spark, "snapshots")
    write_snapshots(documents, requests, out)
    again = requests.agg(F.min("source").alias("source"), F.min("day").alias("day"))
    write_snapshots(documents, again, out)
    return read_snapshots(spark, out, documents).select("doc_id", "source", "snapshot_date")


def dated_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole datasets as dated snapshots; one name would match the other as a pattern."""
    home, out = scratch_path(spark, "home"), scratch_path(spark, "datasets")
    customer = table(spark, sf_dir, "customer")
    customer.where("c_custkey % 2 = 0").write.parquet(f"{home}/a")
    customer.where("c_custkey % 2 = 1").write.parquet(f"{home}/[ab]")
    targets = [snapshot_dataset(spark, f"{home}/{name}", out, DAY) for name in ("a", "[ab]")]
    read = [spark.read.parquet(literal_path(t)).withColumn("archive", F.lit(t.rsplit("/", 1)[1])) for t in targets]
    return read[0].unionByName(read[1])


# Newline counts


def newline_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_newlines(table(spark, sf_dir, "documents"), "doc_id")


def newline_count_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_newlines(table(spark, sf_dir, "conversations"), "conv_id", "turn")


def newline_count_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_newlines(table(spark, sf_dir, "pages"), "page_id", text="html")


def newline_total_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_newlines(table(spark, sf_dir, "documents"), "source")


def newline_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_newlines(table(spark, sf_dir, "documents"))


def write_text_files(spark: SparkSession, sf_dir: str) -> str:
    """Documents as text files, one directory per language, a newline after each."""
    out = scratch_path(spark, "texts")
    table(spark, sf_dir, "documents").select("lang", "text").write.partitionBy("lang").text(out, lineSep="\n")
    return out


def by_language(counts: DataFrame) -> DataFrame:
    language = F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang")
    return counts.where("path like '%.txt'").groupBy(language).agg(F.sum("newline_count").alias("newline_count"))


def file_newline_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_language(count_files(spark, write_text_files(spark, sf_dir)))


def file_newline_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files as requests, counted in byte ranges."""
    manifest = list_tree(spark, write_text_files(spark, sf_dir))
    return by_language(answer_line_counts(manifest.select("path"), manifest).where("status = 'ok'"))


def file_newline_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: its files, a name that no file has, and a request without a name."""
    out = scratch_path(spark, "texts")
    table(spark, sf_dir, "documents").select("source", "text").write.partitionBy("source").text(out, lineSep="\n")
    listed = list_tree(spark, out)
    directory = F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source")
    known = files(listed).where("name like 'part-%'").select(directory, "path")
    unknown = known.select("source", F.concat("path", F.lit(".gone")).alias("path"))
    nameless = known.select("source", F.lit(None).cast("string").alias("path"))
    answers = answer_line_counts(known.unionByName(unknown).unionByName(nameless), listed)
    return answers.groupBy("source", "status").agg(F.sum("newline_count").alias("newline_count"))


# Backups


def supplier_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("content"))


def prefix_backup_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return after_backup(supplier_entries(spark, sf_dir))


def backup_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and directories are copied, entries of any other kind are not."""
    kind = F.when(F.col("p_type") == "SMALL", "dir").when(F.col("p_type") == "ECONOMY", "other").otherwise("file")
    name = F.concat_ws("-", "p_name", "p_partkey").alias("name")
    return after_backup(table(spark, sf_dir, "part").select(name, kind.alias("kind"), "p_size"))


def second_run(entries: DataFrame) -> DataFrame:
    """A run over entries, their copies with old content, and a hidden entry."""
    old_name, old_content = F.concat(F.lit("backup_"), "name"), F.col("content") + 1000000
    old = entries.select(old_name.alias("name"), old_content.alias("content"))
    hidden = entries.agg(F.lit(".index").alias("name"), F.max("content").alias("content"))
    return after_backup(entries.unionByName(old).unionByName(hidden))


def prefix_backup_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return second_run(supplier_entries(spark, sf_dir))


def prefix_backup_second_run_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = supplier_entries(spark, sf_dir)
    return second_run(entries.withColumn("name", F.lower("name")))


def requested_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run in every page directory of the first request per host."""
    manifest = page_manifest(spark, sf_dir).distinct()
    requests = manifest.groupBy(dir_name(F.col("parent")).alias("host")).agg(F.min("parent").alias("dir"))
    return run_backups(requests, manifest).select("parent", "name", "path")


def backup_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.concat(F.lit("src"), "n_nationkey", F.lit("/")).alias("dir")
    requests = table(spark, sf_dir, "nation").select(names)
    directories = manifest_from_paths(
        table(spark, sf_dir, "documents").select(F.col("source").alias("path"), F.lit("dir").alias("kind")),
        kind="kind",
    )
    return answer_backups(requests, directories)


def implied_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directories that page addresses lead through; the pages themselves are files."""
    known = implied_directories(page_manifest(spark, sf_dir))
    return known.where("kind = 'dir'").select("path", "parent", "name")


def site_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per host: directories and files directly below it, whose names sort before and behind the prefix."""
    path, odd = F.col("path"), F.col("page_id") % 2 == 1
    host, name, above = F.substring_index(path, "/", 1), base_name(path), base_name(dir_name(path))
    flat = F.when(odd, name).otherwise(F.concat(F.lit("x"), name))
    deep = F.concat_ws("/", F.when(odd, F.upper(above)).otherwise(above), name)
    placed = F.concat_ws("/", host, F.when(F.col("page_id") % 3 == 0, flat).otherwise(deep))
    paths = stored(page_paths(spark, sf_dir).select(placed.alias("path")).distinct(), "paths")
    return stored(implied_directories(manifest_from_paths(paths)), "sites")


def tree_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run in every host's directory, with all that lies below the copied entries."""
    manifest = site_manifest(spark, sf_dir)
    after = after_tree_backup(manifest.where("parent = '.' and name != '.'").select(F.col("path").alias("dir")), manifest)
    return after.select("path", "kind", "origin")


def tree_backup_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Again: copies of copies, and directories that land inside those of the first run."""
    manifest = site_manifest(spark, sf_dir)
    requests = manifest.where("parent = '.' and name != '.'").select(F.col("path").alias("dir"))
    before = stored(after_tree_backup(requests, manifest).drop("origin"), "first-run")
    return after_tree_backup(requests, before).select("path", "kind", "origin")


def file_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of text files, hidden ones inside it, backed up twice byte for byte: lines
    and a checksum of them for every language in every place, newlines of the hidden files."""
    home = scratch_path(spark, "home")
    documents = table(spark, sf_dir, "documents")
    documents.select("lang", "text").write.partitionBy("lang").text(f"{home}/notes", lineSep="\n")
    documents.select("text").write.text(f"{home}/notes/.hidden", lineSep="\n")
    for _ in range(2):
        back_up_directory(spark, home)
    place = F.regexp_extract("path", "/askframe-home-[0-9a-f]+/(.*)/[^/]*/[^/]*$", 1).alias("place")
    lines = spark.read.option("recursiveFileLookup", "true").text(home, lineSep="\n")
    lines = lines.select("_metadata.file_path", F.conv(F.left(F.md5("value"), F.lit(8)), 16, 10).cast("long").alias("mark"))
    # Paths are taken apart once per file, not per line.
    by_file = lines.groupBy("file_path").agg(F.count("*").alias("lines"), F.sum("mark").alias("checksum"))
    shown = by_file.select(plain_path(F.col("file_path")).alias("path"), "lines", "checksum")
    shown = shown.groupBy(place, F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("part")).agg(F.sum("lines").alias("lines"), F.sum("checksum").alias("checksum"))
    hidden = count_files(spark, home).where("path like '%/.hidden/part-%'")
    hidden = hidden.groupBy(place, F.lit(".hidden").alias("part")).agg(F.sum("newline_count").alias("lines"), F.lit(None).cast("long").alias("checksum"))
    return shown.unionByName(hidden)


def dataset_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three datasets after two runs: one is partitioned, one is called like a pattern."""
    home = scratch_path(spark, "home")
    supplier = table(spark, sf_dir, "supplier")
    supplier.write.parquet(f"{home}/Supplier")
    supplier.write.partitionBy("s_nationkey").parquet(f"{home}/supplier")
    supplier.where("s_suppkey % 2 = 0").write.partitionBy("s_nationkey").parquet(f"{home}/[Ss]upplier")
    backup_datasets(spark, home)
    backup_datasets(spark, home)
    names = [prefix + name for prefix in ("", "backup_", "backup_backup_") for name in ("Supplier", "supplier", "[Ss]upplier")]
    columns = "s_suppkey", F.col("s_nationkey").cast("int")
    copies = [spark.read.parquet(literal_path(f"{home}/{name}")).select(F.lit(name).alias("dataset"), *columns) for name in names]
    return reduce(DataFrame.unionByName, copies)


def dataset_backup_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over two datasets and a directory of text: an answer each, and the copied rows."""
    home = scratch_path(spark, "home")
    supplier = table(spark, sf_dir, "supplier")
    supplier.write.parquet(f"{home}/first")
    supplier.select("s_name").write.text(f"{home}/note")
    supplier.select("s_suppkey").write.parquet(f"{home}/second")
    answers = answer_dataset_backups(spark, home)
    copies = [spark.read.parquet(f"{home}/backup_{n}").agg(F.lit(n).alias("name"), F.count("*").alias("records")) for n in ("first", "second")]
    return answers.join(copies[0].unionByName(copies[1]), "name", "left").select("name", "status", "records")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        next_year_greeting,
        greeting_bad_age,
        greeting_statuses,
        greeting_files,
        greeting_stream,
        find_name_exists,
        find_one_name,
        find_name_matches,
        find_many_names,
        file_manifest,
        directory_listing,
        tree_directories,
        missing_directory_reject,
        present_directory,
        snapshot_answers,
        taken_snapshots,
        path_parts,
        dated_archive_name,
        dated_snapshot,
        dated_dataset,
        newline_count,
        newline_count_conversations,
        newline_count_pages,
        newline_total_by_source,
        newline_total,
        file_newline_count,
        file_newline_answers,
        file_newline_requests,
        prefix_backup_first_run,
        backup_by_kind,
        prefix_backup_second_run,
        prefix_backup_second_run_lower,
        requested_backup,
        backup_answers,
        implied_tree,
        tree_backup,
        tree_backup_second_run,
        file_backup,
        dataset_backup,
        dataset_backup_answers,
    )
}
