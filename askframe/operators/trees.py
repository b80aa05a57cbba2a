"""Directories with all that lies below them.

``implied_directories`` gives an inventory of files the directories that its paths lead
through. ``after_tree_backup`` is a backup run over whole trees. Every visible file or
directory in a requested directory is copied, subtree included, to its prefixed name:

* if there is no such name yet, the copy gets it;
* a file takes the place of a file;
* where a directory has the name, the copy lands inside it under its own name, and what
  lies there already is merged with it, entry by entry: files are replaced;
* a directory cannot take the place of a file, nor a file that of a directory, inside
  too; such an entry stays, with what lies below it, and the rest of the copy is made.

Entries are visited in binary name order, so on a re-run copies of copies chain: if a
name sorts before its prefixed name, what lands in a target travels on with the
target's own copy; otherwise targets are copied before they receive.

Names are unique within a directory. Chains are a few names long, as in
``operators.backup``; how the entries of one flow is worked out once per chain, from
top-level entries alone. A first run is a projection; a re-run joins subtrees to their
flows (hot ones dealt out, see ``lookup``) and shuffles by path, to merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askframe.functions.messages import BACKUP_PREFIX
from askframe.functions.paths import ancestors, base_name, clean_dir, dir_name, is_hidden
from askframe.operators.presence import distinct_keys, lookup
from askframe.sources.storage import stored

FLOWS = "home string, name string, land string, distance int"


def implied_directories(manifest: DataFrame) -> DataFrame:
    """The manifest plus a row of kind ``dir`` for every directory that its paths lead
    through and that has no row: down to ``/``, or ``.`` for relative paths.

    Parents are made distinct in the tasks that read them, and only theirs are taken
    apart, so that a directory of a billion files crosses the shuffle once per task.
    """
    parents = distinct_keys(manifest, "parent").select(F.explode(F.concat(ancestors(F.col("parent")), F.array("parent"))).alias("path"))
    implied = parents.distinct().join(manifest.where("path is not null").select("path"), "path", "left_anti")
    path = F.col("path")
    known = {"path": path, "parent": dir_name(path), "name": base_name(path), "kind": F.lit("dir")}
    columns = [known.get(f.name, F.lit(0 if f.name == "length" else None)).cast(f.dataType).alias(f.name) for f in manifest.schema]
    return manifest.unionByName(implied.select(*columns))


def after_tree_backup(requests: DataFrame, manifest: DataFrame, dir: str = "dir", rerun: bool | None = None) -> DataFrame:
    """What lies below the requested directories after a run in each, at any depth.

    The manifest's columns, plus ``origin``, the path of the entry before the run that
    a row's content comes from. A request inside another requested directory is part
    of that one's run. A directory needs a row of its own to be copied (see
    ``implied_directories``). ``rerun=False`` states that no entry has the prefix yet;
    by default that is looked up.
    """
    below = _below(requests, manifest, dir)
    if rerun is None or rerun:
        below = stored(below, "below")
    if rerun is None:
        rerun = not below.where(F.col("_name").startswith(BACKUP_PREFIX)).isEmpty()
    flown = _flown(below) if rerun else _first_flows(below)
    path = F.when(F.col("_flow.distance") == 0, F.col("path")).otherwise(F.concat("_home", "_slashes", "_flow.land", "_rest"))
    body = F.struct(*[F.col(c) for c in manifest.columns if c not in ("path", "parent", "name")], F.col("path").alias("origin"))
    landed = flown.select(path.alias("path"), F.col("_flow.distance").alias("distance"), "kind", body.alias("body"))
    merged = _merged(stored(landed, "landed")) if rerun else landed
    columns = {"path": F.col("path"), "parent": dir_name(F.col("path")), "name": base_name(F.col("path"))}
    return merged.select(*[columns.get(c, F.col(f"body.{c}")).alias(c) for c in [*manifest.columns, "origin"]])


def _below(requests: DataFrame, manifest: DataFrame, dir: str) -> DataFrame:
    """Rows below the outermost requested directory over them, ``_home``, with the slashes
    and the name of the entry of it that they are or lie in, and the rest of their path."""
    asked = requests.select(clean_dir(F.col(dir)).alias("above")).where("above is not null").distinct()
    parents = distinct_keys(manifest, "parent")
    above = parents.select("parent", F.explode(F.concat(ancestors(F.col("parent")), F.array("parent"))).alias("above"))
    homes = above.join(asked, "above", "left_semi").groupBy("parent").agg(F.min_by("above", F.length("above")).alias("_home"))
    rows = lookup(manifest, homes, "parent").where("_home is not null")
    behind = F.when(F.col("_home") == ".", F.concat(F.lit("/"), "path")).otherwise(F.substr("path", F.length(F.rtrim("_home", F.lit("/"))) + 1))
    rows = rows.withColumn("_behind", behind).withColumn("_top", F.regexp_extract("_behind", "^/+[^/]*", 0))
    name = F.ltrim("_top", F.lit("/"))
    slashes = F.left("_top", F.length("_top") - F.length(name))
    home = F.when(F.col("_home") == ".", F.lit("")).otherwise(F.rtrim("_home", F.lit("/")))
    relative = F.when(F.col("_home") == ".", F.ltrim(slashes, F.lit("/"))).otherwise(slashes)
    rest = F.substr("_behind", F.length("_top") + 1)
    return rows.withColumns({"_name": name, "_slashes": relative, "_rest": rest, "_home": home}).drop("_behind", "_top")


def _is_source() -> Column:
    """Whether a row is, or lies in, what a run copies: below a top-level entry lies a directory's content."""
    return ~is_hidden(F.col("_name")) & ((F.col("_rest") != "") | F.col("kind").isin("file", "dir"))


def _first_flows(below: DataFrame) -> DataFrame:
    stay = F.struct(F.col("_name").alias("land"), F.lit(0).alias("distance"))
    go = F.struct(F.concat(F.lit(BACKUP_PREFIX), "_name").alias("land"), F.lit(1).alias("distance"))
    return below.withColumn("_flow", F.explode(F.array_compact(F.array(stay, F.when(_is_source(), go)))))


def _flown(below: DataFrame) -> DataFrame:
    """Every row once per place where its content is after the run, its own first."""
    tops = below.where("_rest = ''").select(F.col("_home").alias("home"), F.col("_name").alias("name"), "kind")
    root = F.regexp_replace("name", f"^({BACKUP_PREFIX})+", "")
    chains = tops.groupBy("home", root.alias("root")).agg(F.collect_list(F.struct("name", "kind")).alias("entries"))
    flows = chains.mapInPandas(_chain_flows, FLOWS)
    flows = flows.groupBy(F.concat_ws("/", "home", "name").alias("_entry")).agg(F.collect_list(F.struct("land", "distance")).alias("_flows"))
    keyed = below.withColumn("_entry", F.concat_ws("/", "_home", "_name"))
    stay = F.array(F.struct(F.col("_name").alias("land"), F.lit(0).alias("distance")))
    found = lookup(keyed, flows, "_entry")
    return found.withColumn("_flow", F.explode(F.concat(stay, F.coalesce("_flows", F.array().cast("array<struct<land:string,distance:int>>")))))


def _chain_flows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for home, root, entries in zip(batch["home"], batch["root"], batch["entries"]):
            rows += [(home, *flow) for flow in chain_flows(root, {entry["name"]: entry["kind"] for entry in entries})]
        yield pd.DataFrame(rows, columns=["home", "name", "land", "distance"])


def chain_flows(root: str, kinds: dict[str, str]) -> list[tuple[str, str, int]]:
    """(entry, where its content lands, over how many copies) for the entries of one
    chain, names being prefixes in front of ``root``."""
    cascades = root < BACKUP_PREFIX + root
    found = []
    for entry in kinds:
        name, land, kind, distance = entry, entry, kinds[entry], 0
        while kind in ("file", "dir") and not name.startswith("."):
            target = BACKUP_PREFIX + name
            there = kinds.get(target)
            if there == "dir":  # into it
                land = f"{target}/{land}"
            elif there is None or there == kind == "file":
                land = target + land[len(name) :]
            else:
                break
            distance += 1
            found.append((entry, land, distance))
            if not cascades or there is None:
                break
            name, kind = target, there
    return found


def _merged(landed: DataFrame) -> DataFrame:
    """One row per path. Copies come to a path in order of their distance, each merged
    with what is there: a file's content replaced, a directory kept, other kinds kept."""
    apart = F.when(F.col("kind") != "dir", F.col("distance"))
    in_the_way = landed.groupBy("path").agg(F.min(apart).alias("beyond"), F.max(F.when(F.col("kind") == "dir", F.col("distance"))).alias("last"))
    in_the_way = in_the_way.where("beyond < last").select(F.col("path").alias("above"), "beyond")
    if not in_the_way.isEmpty():
        # What was to lie below directories that could not be made there.
        above = landed.select("path", "distance", F.explode(ancestors(F.col("path"))).alias("above"))
        lost = above.join(in_the_way, "above").where("distance > beyond").select("path", "distance").distinct()
        landed = landed.join(lost, ["path", "distance"], "left_anti")
    came = F.sort_array(F.collect_list(F.struct("distance", "kind", "body")), asc=False)
    paths = landed.groupBy("path").agg(came.alias("came"))
    both_files = lambda one, other: (one["kind"] == "file") & (other["kind"] == "file")
    # From the farthest, which is merged into the next one's path before that is copied on.
    kept = F.aggregate(F.slice("came", 2, F.size("came")), F.element_at("came", 1), lambda far, near: F.when(both_files(far, near), far).otherwise(near))
    return paths.select("path", kept["body"].alias("body"))
