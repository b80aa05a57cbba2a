"""Best-fit packing planned on the length histogram (operator 12).

Texts become token ids once, in slices, without a shuffle; only documents longer than a
sequence are cut. The lengths of all pieces are counted, at most as many different ones as
a sequence has tokens, and best fit, longest first, runs over these counts on the driver:
a step places all pieces of a length that go to sequences with the same room, so the plan
has a bounded number of entries whatever the corpus. Then pieces are numbered within
their length, the plan is spread out to one slot per piece, and both are joined on length
and rank: keys that are unique on both sides, so that no length, however frequent, is
one task's.

Texts are split as the tokenizer splits them, and each run is encoded once per task. Runs
of ASCII and Latin-1 letters go straight to the tokenizer's model, as its normalisation only
lowers their case; whatever holds other characters, or a special token, is left to it
in whole parts between blanks.

Defined results: a null text is an empty one; every document ends with the id ``end``, so
an empty one is a piece of one token; repeated rows are rows of their own; no rows give no
rows. Only the key and the text are read, whatever other columns there are.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from askframe.llm.common import numbered, slices, written
from askframe.sources.storage import task_count

LIMIT = 4096
END = 1
SLICE = 2 << 20  # bytes of text that are encoded at once
KNOWN = 400_000  # runs whose ids a task remembers, twice
DEALT = 100_000  # slots that are spread out of one row
ROWS_PER_TASK = 200_000
LITTLE = sys.byteorder == "little"
PART = re.compile(r"[^ \t-\r]+")  # the tokenizer parts texts at these blanks, whatever stands around them
#: Texts of other characters than ASCII and the letters of Latin-1 are left to the tokenizer.
OTHER = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]")
#: The tokenizer's own pattern for the rest, lower-cased: contractions, words, digits, signs.
RUN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ \t-\r]+")
WORD = re.compile(r"[a-zß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: itself if it can be seen,
    else the next of those from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Ids(dict):
    """The ids of runs, as bytes of four each, the lowest first.

    Each run, or each part that is left to the tokenizer, is encoded once, until there are
    too many; then those are forgotten that were not asked for since the last time.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.older: dict[str, bytes] = {}

    def __missing__(self, run: str) -> bytes:
        self[run] = found = self.older.get(run) or self._encoded(run)
        return found

    def of(self, text: str) -> bytes:
        """All ids of a text."""
        if len(self) > KNOWN:
            self.older = dict(self)
            self.clear()
        if self._plain(text):
            runs = RUN.findall(text.lower())
        else:
            runs = [run for part in PART.findall(text) for run in (RUN.findall(part.lower()) if self._plain(part) else [part])]
        return b"".join([self[run] for run in runs])

    def _plain(self, text: str) -> bool:
        """Whether nothing but lower case and splitting comes before the tokenizer's model."""
        return not OTHER.search(text) and not any(token in text for token in self.special)

    def _encoded(self, run: str) -> bytes:
        if WORD.fullmatch(run):
            letters = run if run.isascii() else "".join([self.letters[b] for b in run.encode()])
            ids = [token.id for token in self.tokenizer.model.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(run, add_special_tokens=False).ids
        return array("I", ids).tobytes() if LITTLE else b"".join([i.to_bytes(4, "little") for i in ids])


def tokenized(
    documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = END, with_ids: bool = False
) -> DataFrame:
    """Key, ``row`` (of the document), ``piece``, ``start``, ``length`` and ``ids_crc32`` of every
    piece, and ``ids`` as little-endian bytes if asked for. ``tokenizer`` is its file."""
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    shared = documents.sparkSession.sparkContext.broadcast(definition)  # one file of a few MB
    named = documents.select(F.col(key).alias("key"))
    schema = named.schema
    for name, kind in (("row", "long"), ("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")):
        schema = schema.add(name, kind)
    if with_ids:
        schema = schema.add("ids", "binary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, last = Ids(shared.value), end.to_bytes(4, "little")
        for batch in (part for whole in batches for part in slices(whole, "body", SLICE)):
            texts = [body.decode("utf-8", "replace") for body in batch.column("body").to_pylist()]
            at, numbers, contents = [], [], []
            for i, (row, text) in enumerate(zip(batch.column("row").to_pylist(), texts)):
                found = ids.of(text) + last
                for piece, first in enumerate(range(0, len(found), 4 * limit)):
                    some = found[first : first + 4 * limit]
                    at.append(i)
                    numbers.append((row, piece, first // 4, len(some) // 4, zlib.crc32(some)))
                    if with_ids:
                        contents.append(some)
            columns = [pa.array(column, kind) for column, kind in zip(zip(*numbers), (pa.int64(), pa.int32(), *[pa.int64()] * 3))]
            columns = [batch.column("key").take(pa.array(at)), *columns] + ([pa.array(contents, pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    rows = documents.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), body)
    return rows.mapInArrow(encode, schema)


def best_fit(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over ``counts`` of lengths.

    Entries are (length, first rank, pieces, pieces per sequence, first sequence, offset):
    pieces of the length take places beside each other in that many sequences in turn.
    A piece goes where the least room is left that holds it. Once it lies there, that
    sequence has the least room again, so it takes as many as fit before the next one
    does; sequences of equal room are one run of numbers and are filled together.
    """
    plan, sequences = [], 0
    rooms: list[int] = []  # sorted
    open_: dict[int, list[tuple[int, int]]] = {}  # runs (first sequence, how many) by room

    def leave(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in open_:
                insort(rooms, room)
                open_[room] = []
            open_[room].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                first, many, room = sequences, -(-left // (limit // length)), limit
                sequences += many
            else:
                room = rooms[at]
                first, many = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            fit = room // length
            full = min(many, left // fit)
            if full:
                plan.append((length, rank, full * fit, fit, first, limit - room))
                leave(room - fit * length, first, full)
            rank, left = rank + full * fit, left - full * fit
            rest = 0
            if left and full < many:
                plan.append((length, rank, left, left, first + full, limit - room))
                leave(room - left * length, first + full, 1)
                rest, left = 1, 0
            leave(room, first + full + rest, many - full - rest)
    return plan


def _slots(pieces: DataFrame, plan: list[tuple], pieces_in_all: int) -> DataFrame:
    """One row per place of the plan: ``length``, ``rank``, ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    dealt = []
    for length, rank, many, each, first, offset in plan:
        step = max(1, DEALT // each) * each
        dealt += [(length, rank + i, min(step, many - i), each, first + i // each, offset) for i in range(0, many, step)]
    entries = spark.createDataFrame(dealt, "length long, first long, many long, each long, sequence long, begin long")
    spread = entries.repartition(task_count(spark, pieces_in_all, ROWS_PER_TASK), "length", "first")
    each = spread.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("many") - 1)).alias("i"))
    return each.select(
        "length",
        (F.col("first") + F.col("i")).alias("rank"),
        (F.col("sequence") + F.floor(F.col("i") / F.col("each"))).alias("sequence_id"),
        (F.col("begin") + F.col("i") % F.col("each") * F.col("length")).alias("offset"),
    )


def pack(pieces: DataFrame, length: Column, order: list[str], limit: int = LIMIT) -> DataFrame:
    """Every row plus ``sequence_id`` and ``offset``; ``length`` is from 1 to ``limit``.

    The columns ``order`` tell all rows apart. ``pieces`` is read twice, so it is best
    a written table. Columns of the input named like the new ones are replaced.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("given"), length.cast("long").alias("length"), *[F.col(c).alias(f"by{i}") for i, c in enumerate(order)])
    counts = {row["length"]: row["count"] for row in rows.groupBy("length").count().collect()}  # ``limit`` rows at most
    if any(not 0 < n <= limit for n in counts):
        raise ValueError(f"lengths are from 1 to {limit}: {sorted(counts)[0]} to {sorted(counts)[-1]}")
    slots = _slots(rows, best_fit(counts, limit), sum(counts.values()))
    ranks = numbered(rows, "length", max(counts.values(), default=0), [f"by{i}" for i in range(len(order))], "rank")
    return ranks.join(slots, ["length", "rank"]).select("given.*", "sequence_id", "offset")


def packed(documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT, end: int = END, with_ids: bool = False) -> DataFrame:
    """Key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every
    piece, and its ``ids`` if asked for."""
    pieces = written(tokenized(documents, tokenizer, key, text, limit, end, with_ids), "pieces")
    placed = pack(pieces, F.col("length"), ["row", "piece"], limit)
    ids = ["ids"] if with_ids else []
    return placed.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *ids)
