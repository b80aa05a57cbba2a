"""N-gram Jaccard join by chosen paths (operator 4).

Texts are sets of hashed shingles of five words. Each set is embedded as 64 minimum
hashes, one per coordinate, whose agreement is its Jaccard similarity. A run is a tree:
at every node a few coordinates are sampled, and a set goes on to one child per sampled
coordinate, named after its minimum there. So similar sets are likely to share a path
and others part. A node with no more sets than ``SMALL`` is a bucket; larger ones are
split again, up to ``DEPTH`` levels. Runs repeat until a pair whose coordinates agree as
often as the least similarity says is missed with a probability below ``MISS``; over the
spread of 64 coordinates, which all runs share, that is 0.0016 for a pair at 0.8.

Buckets with the same members are compared once, all others completely and exactly;
large ones in blocks of so many sets and bytes, so that no task holds more than two. A pair counts
in the first bucket that its sets share. A comparison returns the links of each set
and a forest of them, never the pairs, and union-find makes classes of the forests.

Defined results: equal texts are one set and one class; a text of one to four words is
one shingle; texts without words, null ones among them, are equal texts and similar to
no others. Rows of a repeated doc_id are rows of their own. No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askframe.llm.common import slices, words, written
from askframe.llm.components import components
from askframe.operators.presence import lookup, unused

SIMILAR = 0.8
SHINGLE = 5
COORDINATES = 64
START, DEPTH = 2, 4  # levels before buckets are measured for the first time, and at most
SMALL = 64
BLOCK = 2048  # sets, and
HELD = 16 << 20  # bytes of their shingles, that a block has about; a task holds two blocks
COLUMNS = 2048  # shingles whose sets are told by a table at once
MISS = 1e-3
CHUNK = 1 << 17  # words whose shingles are held at once
ROWS = 512  # texts that are handed on at once
SLICE = 4 << 20  # bytes of shingles that are taken out of a batch at once

NODE = np.random.default_rng(11).integers(1, 2**63, COORDINATES, dtype=np.uint64)
TIMES = np.random.default_rng(12).integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = np.random.default_rng(13).integers(1, 2**63, COORDINATES, dtype=np.uint64)
POWERS = np.random.default_rng(14).integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def runs_needed(similar: float = SIMILAR, miss: float = MISS, depth: int = DEPTH) -> int:
    """Sampled coordinates are Poisson with mean 1/similar; a shared child has the chance ``similar``."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(miss) / math.log(1 - alive))


def shingle_hashes(hashed: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of texts given as hashes of their words, and where each text's begin."""
    counts = np.diff(offsets)
    many = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(many)])
    padded = np.concatenate([hashed.astype(np.uint64), np.zeros(SHINGLE, np.uint64)])
    at = np.repeat(offsets[:-1] - starts[:-1], many) + np.arange(starts[-1])
    left = np.repeat(offsets[1:], many) - at  # words up to the text's end
    total = np.zeros(len(at), np.uint64)
    for i in range(SHINGLE):
        total += np.where(left > i, padded[at + i] * POWERS[i], np.uint64(i))
    return mixed(total), starts


def in_chunks(hashed: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The shingles of some texts at a time, so that their arrays stay small."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1)
        yield shingle_hashes(hashed[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def minima(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The embedding of every set; sets have one shingle at least."""
    found = np.empty((len(starts) - 1, COORDINATES), np.uint32)
    for i in range(COORDINATES):
        found[:, i] = np.minimum.reduceat(shingles * TIMES[i] + PLUS[i], starts[:-1]) >> np.uint64(32)
    return found


def children(paths: np.ndarray, embedded: np.ndarray, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """The rows that go on and the paths they take, one per coordinate sampled at their node."""
    limit = np.uint64(int(min(1.0, 1 / (similar * COORDINATES)) * (2**64 - 1)))
    drawn = mixed(paths[:, None] ^ NODE[None, :])
    row, coordinate = np.nonzero(drawn < limit)
    return row, mixed(mixed(drawn[row, coordinate]) + embedded[row, coordinate].astype(np.uint64))


def _parts(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column in one array, and where each row's begin."""
    lists = batch.column(column)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (whole.slice(first, ROWS) for whole in batches for first in range(0, whole.num_rows, ROWS)):
        found = [row.tobytes() for part in in_chunks(*_parts(batch, "hashed")) for row in minima(*part)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "embedded"])


def _embedded(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("embedded").to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _paths_of(nodes: np.ndarray, paths: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(paths.view(np.int64), pa.int64())], ["node", "path"])


def _set_out(similar: float, runs: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, embedded = batch.column("node").to_numpy(), _embedded(batch)
            for run in range(runs):
                row, paths = np.arange(len(nodes)), np.full(len(nodes), mixed(np.array([run + 1], np.uint64))[0])
                for _ in range(START):
                    on, paths = children(paths, embedded[row], similar)
                    row = row[on]
                yield _paths_of(nodes[row], paths)

    return walk


def _go_on(similar: float):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(first, ROWS) for whole in batches for first in range(0, whole.num_rows, ROWS)):
            paths, starts = _parts(batch, "paths")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            row, paths = children(paths.view(np.uint64), _embedded(batch)[owner], similar)
            yield _paths_of(batch.column("node").to_numpy()[owner[row]], paths)

    return walk


def _buckets(embedded: DataFrame, similar: float) -> DataFrame:
    """``path`` and ``node`` of all buckets with two sets or more."""
    paths = written(embedded.mapInArrow(_set_out(similar, runs_needed(similar)), "node long, path long"), "paths")
    found = []
    for depth in range(START, DEPTH + 1):
        sizes = paths.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        sizes = written(sizes, "sizes")
        rows = lookup(paths, sizes, "path").where("n is not null")
        if depth == DEPTH:
            found.append(rows.drop("n"))
            break
        found.append(rows.where(F.col("n") <= SMALL).drop("n"))
        # A set meets its embedding once, on however many paths it goes on.
        split = rows.where(F.col("n") > SMALL).groupBy("node").agg(F.collect_list("path").alias("paths"))
        split = written(split, "split")
        if split.isEmpty():
            break
        paths = written(split.join(embedded, "node").mapInArrow(_go_on(similar), "node long, path long").distinct(), "paths")
    buckets = found[0]
    for more in found[1:]:
        buckets = buckets.unionByName(more)
    buckets = written(buckets.select("path", "node"), "buckets")
    members = buckets.groupBy("path").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    kept = written(members.groupBy("n", "x", "y").agg(F.min("path").alias("path")).select("path", "n"), "kept")
    return written(lookup(buckets, kept, "path").where("n is not null"), "buckets")


def _hashed(texts: DataFrame) -> DataFrame:
    """The hashes of every text's words, of those that have words."""
    # A test of the words themselves would be made before a join, and the words twice.
    with_words = texts.where(F.col("body").rlike(r"[^\x20\x09-\x0D]"))
    return with_words.withColumn("hashed", F.transform(words(F.col("body")), lambda w: F.xxhash64(w))).drop("body")


def _wanted_sets(texts: DataFrame, buckets: DataFrame) -> DataFrame:
    """The shingles of the sets in buckets, sorted, and the buckets of each."""
    of = buckets.groupBy("node").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    of = written(of, "wanted")
    rows = _hashed(lookup(texts, of, "node").where("paths is not null")).dropDuplicates(["node"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(first, ROWS) for whole in batches for first in range(0, whole.num_rows, ROWS)):
            parts = in_chunks(*_parts(batch, "hashed"))
            sets = [np.unique(part[a:b]).tobytes() for part, starts in parts for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary()), batch.column("paths")], ["node", "shingles", "paths"])

    return written(rows.select("node", "hashed", "paths").mapInArrow(shingled, "node long, shingles binary, paths array<long>"), "sets")


def similar_pairs(ones: list[np.ndarray], others: list[np.ndarray], similar: float) -> np.ndarray:
    """Which of ``ones`` and ``others``, sets of distinct values, have a Jaccard similarity of ``similar`` or more."""
    sizes = [np.array([len(s) for s in sets]) for sets in (ones, others)]
    shared = np.zeros((len(ones), len(others)), np.float32)
    if len(ones) * len(others) <= 144:
        for i, one in enumerate(ones):
            for j, other in enumerate(others):
                if min(len(one), len(other)) >= similar * max(len(one), len(other)):
                    both = np.concatenate([one, other])
                    both.sort()
                    shared[i, j] = np.count_nonzero(both[1:] == both[:-1])
    else:
        values = [np.concatenate(sets) for sets in ((ones,) if ones is others else (ones, others))]
        if ones is others:
            known, times = np.unique(values[0], return_counts=True)
            common, values = known[times > 1], values * 2
        else:
            common = np.intersect1d(np.unique(values[0]), np.unique(values[1]), assume_unique=True)
        at = [np.minimum(np.searchsorted(common, v), max(len(common) - 1, 0)) for v in values]
        held = [common[place] == v if len(common) else np.zeros(len(v), bool) for place, v in zip(at, values)]
        owner = [np.repeat(np.arange(len(n)), n)[hold] for n, hold in zip(sizes, held)]
        column = [place[hold] for place, hold in zip(at, held)]
        order = [np.argsort(c, kind="stable") for c in column]
        owner, column = [o[i] for o, i in zip(owner, order)], [c[i] for c, i in zip(column, order)]
        for first in range(0, len(common), COLUMNS):
            tables = []
            for n, who, what in zip((len(ones), len(others)), owner, column):
                a, b = np.searchsorted(what, [first, first + COLUMNS])
                has = np.zeros((n, COLUMNS), np.float32)
                has[who[a:b], what[a:b] - first] = 1
                tables.append(has)
            shared += tables[0] @ tables[1].T
    return shared >= similar * (sizes[0][:, None] + sizes[1][None, :] - shared) - 1e-9


def _compare(path: int, one: int, other: int, rows: list[tuple], similar: float) -> tuple[list, list, list]:
    """A forest of the links that first occur here, and how many each set has.

    Within a block all pairs are compared, between two blocks those that cross.
    """
    ones = [row for row in rows if row[1] == one]
    others = ones if one == other else [row for row in rows if row[1] == other]
    if not ones or not others:
        return [], [], []
    sets = [np.frombuffer(row[2], np.uint64) for row in ones]
    alike = similar_pairs(sets, sets if one == other else [np.frombuffer(row[2], np.uint64) for row in others], similar)
    if one == other:
        np.fill_diagonal(alike, False)
    if not alike.any():
        return [], [], []
    earlier = {p: i for i, p in enumerate(sorted({p for row in rows for p in row[3] if p < path}))}
    if earlier:
        before = []
        for side in (ones, others):
            has = np.zeros((len(side), len(earlier)), np.float32)
            for i, row in enumerate(side):
                has[i, [earlier[p] for p in row[3] if p < path]] = 1
            before.append(has)
        alike &= (before[0] @ before[1].T) == 0
    # Within a block both sides are the same sets, so what one side has reached is reached.
    apart = one != other
    seen = np.zeros(len(ones), bool), np.zeros(len(others), bool)
    us, vs, ns = [], [], []
    for start in np.nonzero(alike.any(axis=1))[0]:
        if seen[0][start]:
            continue
        root, queue = ones[start][0], [(0, start)]
        seen[0][start] = True
        if not apart:
            seen[1][start] = True
        while queue:
            side, at = queue.pop()
            reached = np.nonzero((alike[at] if side == 0 else alike[:, at]) & ~seen[1 - side])[0]
            seen[1 - side][reached] = True
            if not apart:
                seen[side][reached] = True
            queue += [(1 - side if apart else 0, i) for i in reached]
            nodes = (others, ones)[side] if apart else ones
            us += [root] * len(reached)
            vs += [nodes[i][0] for i in reached]
            ns += [0] * len(reached)
    for side, links in ((ones, alike.sum(axis=1)), (others, alike.sum(axis=0)))[: 2 if apart else 1]:
        counted = np.nonzero(links)[0]
        us += [side[i][0] for i in counted]
        vs += [None] * len(counted)
        ns += [int(links[i]) for i in counted]
    return us, vs, ns


def _cells(similar: float):
    """Rows sorted by cell: each cell is compared when its last row has come."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        out: tuple[list, list, list] = ([], [], [])

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in out], ["u", "v", "links"])

        for batch in (part for whole in batches for part in slices(whole, "shingles", SLICE)):
            names = ("path", "one", "other", "node", "block", "shingles", "paths")
            for row in zip(*[batch.column(name).to_pylist() for name in names]):
                if row[:3] != now:
                    if now:
                        for column, more in zip(out, _compare(*now, rows, similar)):
                            column += more
                    now, rows = row[:3], []
                    if len(out[0]) > 10_000:
                        yield flush()
                        out = ([], [], [])
                rows.append(row[3:])
        if now:
            for column, more in zip(out, _compare(*now, rows, similar)):
                column += more
        yield flush()

    return walk


def _links(sets: DataFrame, similar: float) -> DataFrame:
    """The sets bring their buckets along, so none is joined to them: only the few buckets
    of several blocks are looked up."""
    held = sets.select(F.explode("paths").alias("path"), F.length("shingles").alias("size")).groupBy("path").agg(F.count("*").alias("n"), F.sum("size").alias("held"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("held") / HELD)).cast("int")
    large = written(held.select("path", blocks.alias("blocks")).where("blocks > 1"), "large")
    placed = lookup(sets.select("node", "shingles", "paths", F.explode("paths").alias("path")), large, "path")
    placed = placed.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node", "path"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = dealt.select("path", F.least("block", "meets").alias("one"), F.greatest("block", "meets").alias("other"), "node", "block", "shingles", "paths")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartition(tasks, "path", "one", "other").sortWithinPartitions("path", "one", "other")
    return ordered.mapInArrow(_cells(similar), "u long, v long, links long")


def node_of(text: Column) -> Column:
    """The identity of a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``node``, its ``copies``, its ``links`` to other texts, the least key of its own
    texts (``first_key``), and of its class the least key (``class_key``) and the node that has it."""
    texts = docs.select(node_of(F.col(text)).alias("node"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    embedded = _hashed(texts).mapInArrow(_embed, "node long, embedded binary")
    embedded = written(embedded.groupBy("node").agg(F.first("embedded").alias("embedded")), "embedded")
    buckets = _buckets(embedded, similar)
    links = written(_links(_wanted_sets(texts, buckets), similar), "links")
    roots = components(links.where("v is not null").select("u", "v"))
    counts = links.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    copies = docs.groupBy(node_of(F.col(text)).alias("node")).agg(F.count("*").alias("copies"), F.min(key).alias("first_key"))
    known = copies.join(roots, "node", "left").join(counts, "node", "left")
    known = written(known.select("node", "copies", "first_key", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")), "known")
    firsts = known.groupBy("root").agg(F.min(F.struct(F.col("first_key").isNull(), F.col("first_key").alias("key"), "node")).alias("first"), F.count("*").alias("texts"))
    firsts = firsts.select("root", F.col("first.key").alias("class_key"), F.col("first.node").alias("class_node"), "texts")
    return lookup(known, written(firsts, "firsts"), "root").drop("root")


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """Key, ``class_id``, ``links`` and ``copies`` of every row."""
    known = written(classes(docs, key, text, similar), "classes")
    rows = docs.select(F.col(key), node_of(F.col(text)).alias("node"))
    found = lookup(rows, known, "node")
    return found.select(key, F.col("class_key").alias("class_id"), F.col("links").cast("long").alias("links"), F.col("copies").cast("long").alias("copies"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """One row of each class: the least key's (null last), of equal ones any that is equal in all columns but these."""
    node, first, copies = (unused(name, docs) for name in ("node", "first", "copies"))
    known = written(classes(docs, key, text, similar), "classes")
    kept = known.where(F.col("node") == F.col("class_node")).select(F.col("node").alias(node), F.col("first_key").alias(first), F.col("copies").alias(copies))
    found = lookup(docs.withColumn(node, node_of(F.col(text))), kept, node).where(F.col(copies).isNotNull() & F.col(key).eqNullSafe(F.col(first)))
    single, repeated = found.where(F.col(copies) == 1), found.where(F.col(copies) > 1).dropDuplicates([node])
    return single.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
