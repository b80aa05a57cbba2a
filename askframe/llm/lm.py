"""Language-model scoring of whole documents (operator 2).

Tokens are counted over all training documents. The most frequent are ids of the
recurrent model (``gru``); every other token belongs to one of ``RARE`` ids by its
ending, and within such an id its probability follows from its count, with one count
more for each and for all unseen ones together. So the score is the logarithm of a
true probability of the text, whatever words it has.

The model starts from the counted frequencies. It is trained on all training
documents in every round, however many they are. In a round parts of
about ``PART`` tokens are trained side by side from the same weights, the results are
averaged by tokens, in groups of ``FAN`` again and again, and that is the start of the
next round. Documents are encoded once, for training and for scoring.

Counts of the most frequent tokens, at most ``FREQUENT``, are broadcast; the
rarer tokens of a document leave the scoring pass as rows and meet their counts in a
join, so that every count is exact whatever the vocabulary's size.

Defined results: null texts are empty and have one token, the end; a null doc_id
counts as empty text where its remainder decides; repeated rows are rows of their
own. Without training documents all counts are 0 and ids equally likely. No rows
give no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from askframe.llm import gru
from askframe.llm.common import cell, drop, slices, written

RARE = 64
FREQUENT = 150_000
PART = 1_000_000
FAN = 32
ROUNDS = 2
DISTINCT = 300_000  # tokens counted in a task before they are passed on
SLICE = 16 << 20  # bytes of text that a task encodes, and
IDS_SLICE = 4 << 20  # of ids that it scores, side by side
BLOCK = 1 << 14  # weights in a row
END = b""


def split(bodies: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of binary texts, A to Z in lower case, and how many each text has; null texts have none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(bodies, b"").view(pa.string())))
    found = lists.flatten().view(pa.binary())
    kept = pc.greater(pc.binary_length(found), 0)  # blanks at the ends of a text leave empty ones
    before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return found.filter(kept), np.diff(before[ends])


def ending(token: bytes) -> int:
    return zlib.crc32(token[-2:]) % RARE


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns(["token", "n"])

    for batch in (part for whole in batches for part in slices(whole, "body", SLICE)):
        counted = pc.value_counts(split(batch.column("body"))[0])
        held.append(pa.table({"token": counted.field("values"), "n": counted.field("counts")}))
        held.append(pa.table({"token": pa.array([END], pa.binary()), "n": pa.array([batch.num_rows], pa.int64())}))
        if sum(table.num_rows for table in held) > DISTINCT:
            held = [summed()]
            if held[0].num_rows > DISTINCT // 2:
                yield from held.pop().to_batches()
    if held:
        yield from summed().to_batches()


class Vocabulary(NamedTuple):
    words: pa.Array  # the frequent tokens, by place
    logs: np.ndarray  # log10(c + 1) by place
    ids: np.ndarray  # the model's id by place
    is_rare: np.ndarray  # by place: whether that id is an ending's
    endings: np.ndarray  # the model's id by ending
    rests: np.ndarray  # log10 of all counts of an ending, by ending
    frequencies: np.ndarray  # by id


def count_tokens(documents: DataFrame, text: str = "text") -> DataFrame:
    """``token`` and ``n`` over all documents."""
    bodies = documents.select(F.col(text).cast("binary").alias("body"))
    return written(bodies.mapInArrow(_count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")), "counts")


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """Tokens and counts from the highest on, at most so many: those whose counts lie
    in the upper cells of a histogram that together hold no more."""
    by_cell = counts.groupBy(cell(F.col("n")).alias("cell")).agg(F.count("*").alias("kinds")).collect()
    held, least = 0, None
    for row in sorted(by_cell, key=lambda row: -row["cell"]):
        held += row["kinds"]
        if held > most:
            break
        least = row["cell"]
    found = [] if least is None else counts.where(cell(F.col("n")) >= least).collect()
    return sorted(((bytes(row["token"]), row["n"]) for row in found), key=lambda item: (-item[1], item[0]))


def make_vocabulary(counts: DataFrame) -> Vocabulary:
    words = most_frequent(counts, FREQUENT)
    by_ending = F.pmod(F.crc32(F.substring("token", -2, 2)), F.lit(RARE)).cast("int").alias("ending")
    sums, kinds = np.zeros(RARE), np.zeros(RARE)
    for row in counts.groupBy(by_ending).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        sums[row["ending"]], kinds[row["ending"]] = row["n"], row["kinds"]
    own = words[: gru.IDS - RARE]
    for word, n in own:
        sums[ending(word)] -= n
        kinds[ending(word)] -= 1
    # Ids by falling frequency: classes are of like frequency.
    units = [(-n, 0, i) for i, (_, n) in enumerate(own)] + [(-sums[e], 1, e) for e in range(RARE)]
    units += [(0.0, 2, i) for i in range(gru.IDS - len(units))]
    units.sort()
    ids, endings = np.zeros(len(words), np.int16), np.zeros(RARE, np.int16)
    for at, (_, kind, i) in enumerate(units):
        if kind < 2:
            (ids if kind == 0 else endings)[i] = at
    for i in range(len(own), len(words)):
        ids[i] = endings[ending(words[i][0])]
    return Vocabulary(
        pa.array([word for word, _ in words], pa.binary()),
        np.log10(np.array([n for _, n in words], dtype=float) + 1),
        ids,
        np.arange(len(words)) >= len(own),
        endings,
        np.log10(sums + kinds + 1),
        np.array([-n for n, _, _ in units], dtype=float),
    )


def encoded(body: bytes | None, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of one text: the model's ids, the places of frequent tokens (-1: none), and the tokens without."""
    ids, places, _, rare = encode(pa.array([body], pa.binary()), vocabulary)
    return ids, places, rare.to_pylist()


def encode(bodies: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of all texts in turn, each up to its end: the model's ids, the places of frequent tokens (-1: none);
    where each text begins, and the tokens without a place."""
    found, lengths = split(bodies)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    is_word = np.ones(starts[-1], bool)
    is_word[starts[1:] - 1] = False
    places = np.empty(len(is_word), np.int32)
    lookup = lambda words: pc.fill_null(pc.index_in(words, vocabulary.words), -1).to_numpy(zero_copy_only=False)
    places[is_word] = lookup(found)
    places[~is_word] = lookup(pa.array([END], pa.binary()))
    ids = vocabulary.ids[places] if len(vocabulary.ids) else np.zeros(len(places), np.int16)
    missing = np.flatnonzero(places < 0)
    at = np.where(is_word, np.cumsum(is_word) - 1, len(found))[missing]
    rare = pa.concat_arrays([found, pa.array([END], pa.binary())]).take(pa.array(at))
    if len(rare):
        ids[missing] = vocabulary.endings[np.fromiter(map(ending, rare.to_pylist()), np.int64, len(rare))]
    return ids, places, starts, rare


def train(training: DataFrame, vocabulary: Vocabulary, n_tokens: int) -> np.ndarray:
    """The weights after all rounds; ``training`` has the ``mark`` and ``ids`` of every training document."""
    spark = training.sparkSession
    parts = max(1, math.ceil(n_tokens / PART))
    dealt = training.select("mark", "ids", F.pmod(F.xxhash64("mark"), F.lit(parts)).cast("int").alias("part"))
    weights = gru.flat(gru.untrained(vocabulary.frequencies))
    schema = "part int, block int, tokens long, weights array<float>"

    for turn in range(ROUNDS):
        trained = _trainer(spark.sparkContext.broadcast(weights), gru.RATE / (turn + 1))
        last = turn == ROUNDS - 1
        parted = written(dealt.groupBy("part").applyInPandas(trained, schema), "weights" if last else "start")
        found, left = parted, parts
        while left > 1:
            found = found.groupBy("block", F.floor(F.col("part") / FAN)).applyInPandas(_averaged, schema)
            left = -(-left // FAN)
        rows = sorted((row["block"], row["weights"]) for row in found.select("block", "weights").collect())
        if rows:
            weights = np.concatenate([np.asarray(values, dtype=np.float32) for _, values in rows])
        if not last:
            drop(parted)
    return weights


def _trainer(start, rate: float):
    """Trains on one part, from broadcast weights."""

    def trained(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("mark", kind="stable")
        texts = [np.frombuffer(ids, np.int16) for ids in rows["ids"]]
        found = gru.flat(gru.train(gru.shaped(start.value), texts, rate))
        blocks = [found[i : i + BLOCK] for i in range(0, len(found), BLOCK)]
        return pd.DataFrame({"part": rows["part"].iloc[0], "block": range(len(blocks)), "tokens": sum(map(len, texts)), "weights": blocks})

    return trained


def _averaged(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part", kind="stable")
    shares = rows["tokens"].to_numpy() / rows["tokens"].sum()
    mean = sum(share * np.asarray(part, dtype=np.float64) for share, part in zip(shares, rows["weights"]))
    first = rows.iloc[0]
    return pd.DataFrame({"part": [first["part"] // FAN], "block": [first["block"]], "tokens": [rows["tokens"].sum()], "weights": [mean.astype(np.float32)]})


def score(documents: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``learn`` says which documents are for training.
    """
    spark = documents.sparkSession
    counts = count_tokens(documents.where(learn).select(text), text)
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    vocabulary = make_vocabulary(counts)
    body = F.col(text).cast("binary").alias("body")
    texts = documents.select(key, F.xxhash64(key, text).alias("mark"), F.coalesce(learn, F.lit(False)).alias("learn"), body)
    schema = texts.drop("body").schema.add("ids", "binary").add("n_tokens", "long").add("n_known", "long").add("logs", "double").add("inside", "double").add("rare", ArrayType(StructType().add("token", "binary").add("times", "long")))
    rows = texts.mapInArrow(_encoder(spark.sparkContext.broadcast(vocabulary), schema.fieldNames()), schema)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "encoded")
    weights = train(rows.where("learn").select("mark", "ids"), vocabulary, n)
    likely = _scorer(spark.sparkContext.broadcast(weights))
    likely = rows.select(key, "row", "ids", "n_tokens", "n_known", "logs", "inside").mapInArrow(
        likely, rows.select(key, "row", "n_tokens", "n_known", "logs").schema.add("likely", "double")
    )
    likely = written(likely, "scored")
    each = rows.select("row", F.explode("rare").alias("rare")).select("row", "rare.*")
    counted = each.join(counts, "token", "left")
    logs = F.when(F.col("n").isNotNull(), F.col("times") * F.log10(F.col("n") + 1)).otherwise(0.0)
    more = counted.groupBy("row").agg(F.sum(logs).alias("more"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"))
    found = likely.join(more, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return found.select(
        key,
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        (F.col("likely") + more).alias("score"),
    )


def _encoder(words, names: list[str]):
    """Ids of whole texts, and what follows from the broadcast vocabulary alone."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = words.value
        rests = np.zeros(gru.IDS)
        rests[vocabulary.endings] = vocabulary.rests
        for batch in (part for whole in batches for part in slices(whole, "body", SLICE)):
            if not batch.num_rows:
                continue
            ids, places, starts, rare = encode(batch.column("body"), vocabulary)
            first, known = starts[:-1], places >= 0
            logs = np.where(known, vocabulary.logs[places], 0.0) if len(vocabulary.logs) else np.zeros(len(places))
            # Within an ending: the token's count over all of the ending's.
            inside = -rests[ids]
            if len(vocabulary.is_rare):
                inside += np.where(vocabulary.is_rare[places], logs, 0.0)
            # The tokens without a place, once a text.
            owner = np.repeat(np.arange(batch.num_rows), np.add.reduceat(~known, first, dtype=np.int64))
            rare = pa.table({"owner": owner, "token": rare}).group_by(["owner", "token"], use_threads=False).aggregate([([], "count_all")]).sort_by("owner")
            upto = np.searchsorted(rare["owner"].to_numpy(), np.arange(batch.num_rows + 1))
            rare = pa.StructArray.from_arrays([rare[name].combine_chunks() for name in ("token", "count_all")], ["token", "times"])
            columns = [
                *batch.columns[:3],
                pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((2 * starts).astype(np.int32)), pa.py_buffer(ids.astype(np.int16))]),
                pa.array(np.diff(starts), pa.int64()),
                pa.array(np.add.reduceat(known, first, dtype=np.int64)),
                pa.array(np.add.reduceat(logs, first)),
                pa.array(np.add.reduceat(inside, first)),
                pa.ListArray.from_arrays(pa.array(upto, pa.int32()), rare),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return walk


def _scorer(weights):
    """The log10 likelihood of every document's ids, by broadcast weights."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = gru.shaped(weights.value)
        for batch in (part for whole in batches for part in slices(whole, "ids", IDS_SLICE)):
            texts = [np.frombuffer(ids.as_py(), np.int16) for ids in batch.column("ids")]
            likely = gru.log_likelihoods(model, texts) / math.log(10) + batch.column("inside").to_numpy()
            kept = batch.drop_columns(["ids", "inside"])
            yield kept.append_column("likely", pa.array(likely, pa.float64()))

    return walk
