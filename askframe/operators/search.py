"""Does any file name match this pattern? Answers for a table of patterns.

Up to ``ONE_SCAN`` distinct patterns are compiled into one aggregation over the
names: one scan and one row per task to merge. More of them are joined:

* patterns with some literal text by that text (their anchor), then verified, so
  that a name meets only the patterns it shares an anchor with: all of a plain
  name, a start or an end, or else a few characters anywhere;
* patterns that begin or end with a small set, such as ``[0-4]??*``, by each of the
  set's characters in the same way;
* patterns of ``?`` and ``*`` alone by the lengths of names;
* what remains, patterns with no text and no small set at an end, all at once by an
  automaton that each name runs through (see ``operators.many_globs``).

The plan has one size, but for one more table per ``PATTERNS_AT_ONCE`` of the last kind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askframe.functions.globs import END, START, is_pushable, matches, translate
from askframe.functions.messages import FILE_FOUND, FILE_MISSING, fill
from askframe.operators.many_globs import found_of_many
from askframe.operators.presence import distinct_keys, fits_broadcast, lookup, mark_present, status_of
from askframe.sources.storage import scratch_path, task_count

ONE_SCAN = 64
KINDS = ("start", "end", "inner")
PATTERNS_PER_TASK = 20_000


def any_match(names: DataFrame, pattern: str, name: str = "name") -> bool:
    """One pattern, stopping at the first name that matches."""
    return not names.where(matches(F.col(name), pattern)).isEmpty()


def found_patterns(requests: DataFrame, names: DataFrame, pattern: str = "pattern", name: str = "name") -> DataFrame:
    """The distinct patterns that match at least one name, as column ``pattern``."""
    return _found_patterns(requests, names, pattern, name)[0]


def search(
    requests: DataFrame,
    names: DataFrame,
    pattern: str = "pattern",
    name: str = "name",
    found_text: str = FILE_FOUND,
    missing_text: str = FILE_MISSING,
) -> DataFrame:
    """Every request plus ``found``, ``status`` and ``message``."""
    hits, small = _found_patterns(requests, names, pattern, name)
    answers = mark_present(requests, hits.withColumnRenamed("pattern", pattern), pattern, "found", small)
    return answers.withColumns(
        {
            "status": status_of(pattern, "found"),
            "message": F.when(F.col("found"), fill(found_text, pattern=F.col(pattern))).otherwise(
                fill(missing_text, pattern=F.col(pattern))
            ),
        }
    )


def _found_patterns(requests: DataFrame, names: DataFrame, pattern: str, name: str) -> tuple[DataFrame, bool]:
    """The found patterns, and whether they are sure to fit a broadcast."""
    wanted = distinct_keys(requests, pattern).withColumnRenamed(pattern, "pattern")
    names = names.select(F.col(name).alias("name"))
    head = [row.pattern for row in wanted.limit(ONE_SCAN + 1).collect()]
    if len(head) <= ONE_SCAN:
        return _match_in_one_scan(names, sorted(head)), True
    return _match_by_join(names, wanted)


def _match_in_one_scan(names: DataFrame, patterns: list[str]) -> DataFrame:
    if not patterns:
        return names.select(F.col("name").alias("pattern")).where(F.lit(False))
    tests = {p: matches(F.col("name"), p) for p in patterns}
    if all(map(is_pushable, patterns)):
        names = names.where(reduce(Column.__or__, tests.values()))
    hits = names.agg(*[F.bool_or(test).alias(f"hit_{i}") for i, test in enumerate(tests.values())])
    found = [F.when(F.col(f"hit_{i}"), F.lit(p)) for i, p in enumerate(tests)]
    return hits.select(F.explode(F.array_compact(F.array(*found))).alias("pattern"))


DESCRIBED = (
    "pattern string, regex string, whole boolean, start string, end string, anchors array<string>, "
    "either array<string>, least int, has_star boolean, only_length boolean, items array<array<string>>"
)


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The translator on a table: one call per distinct pattern, none per name."""
    for batch in batches:
        globs = [glob for glob in map(translate, batch["pattern"]) if glob.runs is not None]
        if not globs:
            continue
        yield pd.DataFrame(
            {
                "pattern": [glob.pattern for glob in globs],
                "regex": [glob.regex for glob in globs],
                "whole": [glob.literal is not None for glob in globs],
                "start": [glob.stretches[0] for glob in globs],
                "end": [glob.stretches[1] for glob in globs],
                "anchors": [glob.anchors for glob in globs],
                "either": [glob.either for glob in globs],
                "least": [glob.least for glob in globs],
                "has_star": [glob.has_star for glob in globs],
                "only_length": [glob.only_length for glob in globs],
                "items": [[[regex for regex, _, _ in run] for run in glob.runs] if not glob.anchors else None for glob in globs],
            }
        )


def _written(table: DataFrame, name: str) -> DataFrame:
    """For what is read several times below: made once."""
    scratch = scratch_path(table.sparkSession, name)
    table.write.parquet(scratch)
    return table.sparkSession.read.schema(table.schema).parquet(scratch)


def _match_by_join(names: DataFrame, wanted: DataFrame) -> tuple[DataFrame, bool]:
    spark = wanted.sparkSession
    spread = wanted.repartition(task_count(spark, wanted.count(), PATTERNS_PER_TASK))
    described = _written(spread.mapInPandas(_describe, DESCRIBED), "patterns")
    keyed = _written(_rarest_anchor(described).unionByName(_each_of_a_set(described)), "anchors")
    small = fits_broadcast(keyed)
    shapes = keyed.where("kind != 'whole'").select("kind", F.length("anchor").alias("size")).distinct().collect()
    sizes = {kind: sorted(row["size"] for row in shapes if row.kind == kind) for kind in KINDS}
    found = [_verified(names, keyed.where("kind != 'inner'"), small, partial(_cut_ends, sizes=sizes))]
    if sizes["inner"]:
        found.append(_verified(names, keyed.where("kind = 'inner'"), small, partial(_cut_inside, sizes=sizes["inner"])))
    loose = described.where("size(anchors) = 0 and size(either) = 0").select("pattern", "items", "least", "has_star", "only_length")
    if not loose.isEmpty():
        found += _match_without_text(names, loose)
    return reduce(DataFrame.unionByName, found), fits_broadcast(described.select("pattern"))


def _match_without_text(names: DataFrame, loose: DataFrame) -> list[DataFrame]:
    """Patterns without text: by the lengths of names, which are few and collected, or all at once."""
    lengths = sorted(row["size"] for row in names.where("name is not null").select(F.length("name").alias("size")).distinct().collect())
    known = F.array(*map(F.lit, lengths)).cast("array<int>")
    fitting = F.exists(known, lambda size: F.when(F.col("has_star"), size >= F.col("least")).otherwise(size == F.col("least")))
    fitted = loose.where(fitting)
    return [fitted.where("only_length").select("pattern"), *found_of_many(fitted.where("not only_length").select("pattern", "items"), names)]


def _marked() -> Column:
    return F.concat(F.lit(START), F.col("name"), F.lit(END))


def _cut_ends(names: DataFrame, sizes: dict[str, list[int]]) -> DataFrame:
    """Every name with hashes of all of it, and of its starts and ends of the given sizes."""
    starts = [F.left(_marked(), F.lit(size)) for size in sizes["start"]]
    ends = [F.right(_marked(), F.lit(size)) for size in sizes["end"]]
    return names.select("name", F.explode(F.array(*map(F.xxhash64, [_marked(), *starts, *ends]))).alias("key"))


def _cut_inside(names: DataFrame, sizes: list[int]) -> DataFrame:
    """Every name with hashes of the texts of the given sizes at all its places."""
    sized = names.select("name", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    last = F.length("name") - F.col("size") + 1
    placed = sized.where(last >= 1).select("name", "size", F.explode(F.sequence(F.lit(1), last)).alias("at"))
    return placed.select("name", F.xxhash64(F.substr("name", "at", "size")).alias("key"))


def _verified(names: DataFrame, keyed: DataFrame, small: bool, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The patterns that match a name they share an anchor with.

    Joined by the hash of the anchor, as a join on numbers is several times faster
    than one on texts. Whatever meets by chance is sorted out like the rest.
    """
    keyed = keyed.withColumn("key", F.xxhash64("anchor"))
    if small:
        candidates = cut(names).join(F.broadcast(keyed), "key")
    else:
        # Names have to be shuffled: let repeated ones travel once.
        candidates = cut(names.distinct()).join(keyed, "key")
    is_match = F.expr("startswith(name, start) and endswith(name, end) and name rlike regex")
    is_verified = F.when(F.col("kind") == "whole", _marked() == F.col("anchor")).otherwise(is_match)
    return candidates.where(is_verified).select("pattern").distinct()


def _rarest_anchor(described: DataFrame) -> DataFrame:
    """One anchor per pattern: the one that the fewest other patterns share.

    With ``a*.html`` and ``b*.html`` that is the start, not the common ending.
    Among equals the ends of a name come first: there is one of each, where inner
    texts are looked for at every place.
    """
    glob = F.struct("regex", "start", "end").alias("glob")
    each = described.select("pattern", "whole", glob, F.explode("anchors").alias("anchor")).withColumn("kind", _kind())
    shared = each.groupBy("anchor").agg(F.count("*").alias("users"))
    ranking = F.struct("users", F.col("kind") == "inner", -F.length("anchor"), "anchor")
    return (
        lookup(each, shared, "anchor")
        .groupBy("pattern")
        .agg(F.min_by(F.struct("anchor", "kind", "glob"), ranking).alias("best"))
        .select("pattern", "best.anchor", "best.kind", "best.glob.*")
    )


def _each_of_a_set(described: DataFrame) -> DataFrame:
    """Patterns that begin or end with a small set, once per character of the set."""
    each = described.select("pattern", "whole", "regex", "start", "end", F.explode("either").alias("anchor"))
    return each.select("pattern", "anchor", _kind().alias("kind"), "regex", "start", "end")


def _kind() -> Column:
    return (
        F.when(F.col("whole"), "whole")
        .when(F.col("anchor").startswith(START), "start")
        .when(F.col("anchor").endswith(END), "end")
        .otherwise("inner")
    )
