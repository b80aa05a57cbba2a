"""Many patterns without text against many names: one automaton, run once per name.

Patterns of sets, ``?`` and stars alone have nothing to be looked up by. In each task
they are one automaton whose states are bits: a step over a character moves all patterns
at once, whatever their number, and no name is compared with a pattern. Names come
sorted by length and text, so that a step is only made where a name differs from the one
before it. As a pattern is answered by its first match, patterns that were found leave,
and the automaton shrinks as it runs.

Which characters are in a set is asked of the regular expressions of the translator, once
per set and character that occurs in a name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askframe.sources.storage import scratch_path, task_count

PATTERNS_AT_ONCE = 200_000  # of which all are in each task's automaton
NAMES_PER_TASK = 100_000


def found_of_many(patterns: DataFrame, names: DataFrame) -> list[DataFrame]:
    """The patterns that match a name, in tables with the column ``pattern``.

    ``patterns`` has ``pattern`` and, of every stretch between stars, its ``items`` as
    regular expressions of one character. More than ``PATTERNS_AT_ONCE`` are run in parts.
    """
    spark = names.sparkSession
    distinct = names.where("name is not null").distinct().withColumn("size", F.length("name"))
    path = scratch_path(spark, "names")
    tasks = task_count(spark, distinct.count(), NAMES_PER_TASK)
    distinct.repartition(tasks, "name").sortWithinPartitions("size", "name").write.parquet(path)
    distinct = spark.read.schema(distinct.schema).parquet(path)
    each = F.explode(F.transform(F.sequence(F.lit(1), F.greatest("size", F.lit(1))), lambda i: F.substr("name", i, F.lit(1))))
    characters = sorted(row[0] for row in distinct.select(each.alias("c")).distinct().collect())  # those of an alphabet
    sets = patterns.select(F.explode(F.flatten("items")).alias("item")).distinct()
    known = F.array(*map(F.lit, characters)).cast("array<string>")
    members = sets.select("item", known.alias("known")).selectExpr("item", r"filter(known, c -> c rlike concat('(?s)\\A', item, '\\z')) AS members")
    parts = -(-patterns.count() // PATTERNS_AT_ONCE)
    part = F.pmod(F.xxhash64("pattern"), F.lit(max(parts, 1)))
    return [_found(patterns.where(part == i), members, characters, distinct, tasks) for i in range(parts)]


def _found(patterns: DataFrame, members: DataFrame, characters: list[str], names: DataFrame, tasks: int) -> DataFrame:
    rows = patterns.select("pattern", "items").collect()
    own = patterns.select(F.explode(F.flatten("items")).alias("item")).distinct()
    sets = [(row["item"], "".join(row["members"])) for row in members.join(own, "item", "left_semi").collect()]
    shared = names.sparkSession.sparkContext.broadcast(([(row["pattern"], row["items"]) for row in rows], sets, "".join(characters)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        globs = Globs(*shared.value)
        for batch in batches:
            for name in batch["name"]:
                globs.read(name)
            yield pd.DataFrame({"pattern": globs.take_found()}, dtype="object")

    # As written: a file's names are in order, and a task keeps to its files.
    return names.select("name").mapInPandas(run, "pattern string").distinct()


class Globs:
    """An automaton of many patterns; a state of one is reached when its items so far matched.

    A state follows from the one before it by a character that its item takes, or stays
    by any character if a star comes behind it.
    """

    def __init__(self, patterns: list[tuple[str, list[list[str]]]], sets: list[tuple[str, str]], characters: str):
        place = {item: i for i, (item, _) in enumerate(sets)}
        self.column = {c: i for i, c in enumerate(characters)}
        self.takes = np.zeros((len(sets) + 1, len(characters)), bool)  # last: the first state of a pattern, never entered
        for i, (_, members) in enumerate(sets):
            self.takes[i, [self.column[c] for c in members]] = True
        self.patterns = [pattern for pattern, _ in patterns]
        self.least = np.array([sum(map(len, runs)) for _, runs in patterns], np.int64)
        self.star = np.array([len(runs) > 1 for _, runs in patterns], bool)
        item, loop = [], []
        for _, runs in patterns:
            item.append(len(sets))
            loop.append(len(runs) > 1 and not runs[0])
            for at, run in enumerate(runs):
                item += [place[one] for one in run]
                loop += [False] * (len(run) - 1) + [at < len(runs) - 1] if run else []
        self.item, self.loop = np.array(item, np.int64), np.array(loop, bool)
        self.of = np.repeat(np.arange(len(patterns)), self.least + 1)
        self.open = np.ones(len(patterns), bool)
        self.found: list[str] = []
        self.size, self.lost = -1, 0

    def _restrict(self, size: int) -> None:
        """The automaton of the patterns not found yet that a name of this size can match."""
        fits = self.open & np.where(self.star, self.least <= size, self.least == size)
        states = np.nonzero(fits[self.of])[0]
        self.size, self.lost, self.alive = size, 0, int(fits.sum())
        self.owner, self.entered = self.of[states], self.item[states]
        first = np.diff(self.owner, prepend=-1) != 0
        self.start, self.stay = _bits(first), _bits(self.loop[states])
        self.end = _bits(np.append(first[1:], True)) if len(states) else 0
        self.moves: dict[str, int] = {}
        self.name, self.path = "", [self.start]

    def read(self, name: str) -> None:
        if len(name) != self.size or 2 * self.lost > self.alive:
            self._restrict(len(name))
        shared = 0
        for a, b in zip(name, self.name):
            if a != b:
                break
            shared += 1
        self.name, path = name, self.path
        del path[shared + 1 :]
        state = path[-1]
        for c in name[shared:]:
            move = self.moves.get(c)
            if move is None:
                move = self.moves[c] = _bits(self.takes[self.entered, self.column[c]])
            state = ((state << 1) & move) | (state & self.stay)
            path.append(state)
        hit = state & self.end
        if hit:
            self.end &= ~hit
            bits = np.unpackbits(np.frombuffer(hit.to_bytes(len(self.owner) // 8 + 1, "little"), np.uint8), bitorder="little")
            matched = self.owner[np.nonzero(bits)[0]]
            self.open[matched] = False
            self.lost += len(matched)
            self.found += [self.patterns[i] for i in matched]

    def take_found(self) -> list[str]:
        found, self.found = self.found, []
        return found


def _bits(flags: np.ndarray) -> int:
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")
