"""Entries of a directory plus their ``backup_`` copies.

A run visits the entries in (binary) name order and copies each to its prefixed
name, and the copies of an earlier run are entries too. Take ``depth`` as the
number of prefixes of a name and ``root`` as the rest. Entries of one root at
consecutive depths form a chain in which every entry is the target of the one
before:

* if ``root`` sorts before its own prefixed name, an entry is copied after it was
  replaced itself, so the content of the chain's first entry reaches all of it;
* otherwise it is copied before, so every target gets the old content.

Names are unique within a directory. A chain of n entries needs names of about
3.5 * n * n bytes altogether, so that no chain can be a large share of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askframe.functions.messages import BACKUP_DIR_MISSING, BACKUP_PREFIX, fill
from askframe.functions.paths import backup_name, clean_dir, is_hidden
from askframe.operators.presence import check_presence, distinct_keys, keep_wanted, status_of


def is_source(name: Column, kind: Column | None = None) -> Column:
    """Visible files and directories are copied, anything else is passed over."""
    visible = ~is_hidden(name)
    return visible if kind is None else visible & kind.isin("file", "dir")


def after_backup(entries: DataFrame, within: str | None = None, rerun: bool | None = None) -> DataFrame:
    """The entries after a run, with the columns of ``entries``.

    ``name`` identifies an entry, within the directory column ``within`` if there
    are several directories. All other columns are its content and travel with
    it. ``rerun=False`` states that no name has the prefix yet; by default that
    is looked up, a scan of the names only.
    """
    if rerun is None:
        rerun = not entries.where(F.col("name").startswith(BACKUP_PREFIX)).isEmpty()
    place = [within] if within else []
    payload = [c for c in entries.columns if c not in ("name", *place)]
    body = F.struct(*payload) if payload else F.struct(F.lit(True).alias("_"))
    kind = F.col("kind") if "kind" in entries.columns else None
    state = entries.select(*place, "name", is_source(F.col("name"), kind).alias("source"), body.alias("body"))
    if rerun:
        state = _run_over_chains(state, place)
    else:
        state = state.withColumns({"after": F.col("body"), "copy": F.col("source"), "copied": F.col("body")})
    kept = F.struct("name", F.col("after").alias("body"))
    added = F.struct(backup_name(F.col("name")).alias("name"), F.col("copied").alias("body"))
    both = F.array_compact(F.array(kept, F.when(F.col("copy"), added)))
    rows = state.select(*place, F.explode(both).alias("entry"))
    columns = {c: F.col(f"entry.body.{c}") for c in payload} | {"name": F.col("entry.name")}
    return rows.select(*[columns.get(c, F.col(c)).alias(c) for c in entries.columns])


def _run_over_chains(state: DataFrame, place: list[str]) -> DataFrame:
    """Adds what an entry holds after the run, whether its copy is a new name,
    and what that copy holds. One shuffle and one sort serve all the windows."""
    root = F.regexp_replace("name", f"^({BACKUP_PREFIX})+", "")
    depth = (F.length("name") - F.length("root")) / len(BACKUP_PREFIX)
    state = state.withColumn("root", root).withColumn("depth", depth.cast("int"))
    chain = Window.partitionBy(*place, "root").orderBy("depth")
    so_far = chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = state.withColumns(
        {
            "before": F.lag(F.struct("depth", "source", "body")).over(chain),
            "follower": F.lead("depth").over(chain),
            "cascades": F.col("root") < backup_name(F.col("root")),
        }
    )
    is_target = F.coalesce((F.col("before.depth") == F.col("depth") - 1) & F.col("before.source"), F.lit(False))
    state = state.withColumn("is_target", is_target)
    first = F.last(F.when(~F.col("is_target"), F.col("body")), ignorenulls=True).over(so_far)
    after = (
        F.when(~F.col("is_target"), F.col("body"))
        .when(F.col("cascades"), F.col("first_body"))
        .otherwise(F.col("before.body"))
    )
    has_target = F.coalesce(F.col("follower") == F.col("depth") + 1, F.lit(False))
    return (
        state.withColumn("first_body", first)
        .withColumn("after", after)
        .withColumn("copy", F.col("source") & ~has_target)
        .withColumn("copied", F.when(F.col("cascades"), F.col("after")).otherwise(F.col("body")))
    )


def answer_backups(
    requests: DataFrame, manifest: DataFrame, dir: str = "dir", missing_text: str = BACKUP_DIR_MISSING
) -> DataFrame:
    """Every request plus ``status`` and ``message``; a run that works says nothing."""
    asked = requests.withColumn("path", clean_dir(F.col(dir)))
    checked = check_presence(asked, manifest.where("kind = 'dir'"), "path")
    status = status_of(dir)
    return checked.select(
        *requests.columns,
        status.alias("status"),
        F.when(status == "not_found", fill(missing_text, dir=F.col(dir))).alias("message"),
    )


def run_backups(requests: DataFrame, manifest: DataFrame, dir: str = "dir", rerun: bool | None = None) -> DataFrame:
    """The entries of all requested directories after one run each.

    The manifest's columns, where ``path`` says which file or directory holds the
    content: copies point at the entry they were made from.
    """
    wanted = distinct_keys(requests.select(clean_dir(F.col(dir)).alias("parent")), "parent")
    return after_backup(keep_wanted(manifest, wanted, "parent"), within="parent", rerun=rerun)
