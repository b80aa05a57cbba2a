"""Toxicity by a subsequence string-kernel support vector machine (operator 1).

The kernel compares words by the subsequences of three characters that they share,
each weighed down with the span it covers, up to six characters: letters in between
cost similarity but do not undo it. Words carry marks at both ends; letters that
stand apart one by one are read as one word, and longer words in overlapping pieces.

Training sentences: in a clean document no word is an insult, in a toxic one some are,
unknown which. Witnesses are found by covering: the word that lies in most toxic
documents not yet explained, and hardly in clean ones, explains these, and so on. The
machine is trained on witnesses, as they are and with a character put in, against
words of clean sentences, in the feature space that Nyström's method spans from a
bounded number of landmark words; clean words that come too near are added, toxic
documents that lack a witness give their best word if it lies beyond the machine's margin, and it is trained again. As features are linear in the kernel, the trained machine is at
last one weight per triple of characters, a table of fixed size: a word costs a few
look-ups, whatever the number of landmarks.

A document's score is a logistic curve through its two highest word margins and its
number of different words; all of its text is read.

The labels are learnt from a bounded sample, ``SAMPLE`` documents per label. Defined
results: null texts score as empty ones, words without letters or digits count for
nothing; if a label has fewer than ``FEWEST`` documents every score is the smoothed
share of toxic ones. No rows give no rows.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askframe.llm.common import slices
from askframe.llm.learning import calibrated, labelled_sample

SAMPLE = 2_000
FEWEST = 8
LANDMARKS = 192
DECAY = 0.6
SPAN = 6
LONGEST, STEP = 20, 10  # characters of a piece of a long word, and from piece to piece
WITNESSES = 400
NEGATIVES = 8_000
ROUNDS = 4
SURE = 1.0  # margin of a word that stands in for a witness: labels may be wrong
CACHE = 120_000  # margins of words that a task remembers
SLICE = 1 << 20  # bytes of text whose words it holds at once
CODES = 64
BEGIN, END = 27, 28
TRIPLES = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
APART = re.compile(r"(?<!\S)\w(?:\W?\s\W?\w)+(?!\S)")
INNER = re.compile(r"[\W_]")
EDGES = re.compile(r"^\W+|\W+$")


def code(character: str) -> int:
    """1 to 26 for a to z, a class of 29 to 63 for all others; 0 is padding."""
    at = ord(character) - 96
    return at if 1 <= at <= 26 else 29 + ord(character) % 35


def words_of(text: str) -> set[str]:
    """The different words of a text, without punctuation at their ends; of words with
    punctuation inside also what they are without it. Of all long ones there are pieces."""
    found = set()
    low = text.lower()
    for run in APART.findall(low):
        found.update(pieces(re.sub(r"\W", "", run)))
    for word in set(low.split()):
        if not word.isalnum():
            word = EDGES.sub("", word)
            if not word.isalnum():
                found.update(pieces(INNER.sub("", word)))
        found.update(pieces(word))
    found.discard("")
    return found


def pieces(word: str) -> list[str]:
    """The word, or if it is long its overlapping pieces, the last of which is its end."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST + STEP, STEP)]


def encode(words: list[str]) -> np.ndarray:
    """Codes with marks, padded to one width and by a span more."""
    width = max(map(len, words), default=0) + 2
    out = np.zeros((len(words), width + SPAN), dtype=np.int32)
    known: dict[str, int] = {}
    for i, word in enumerate(words):
        codes = [known[c] if c in known else known.setdefault(c, code(c)) for c in word]
        out[i, : len(word) + 2] = [BEGIN, *codes, END]
    return out


def triples(codes: np.ndarray, i: int, j: int) -> np.ndarray:
    """Index of (character, i-th next, j-th next) at every place; negative where padded."""
    width = codes.shape[1] - SPAN
    last = codes[:, j : j + width]
    at = (codes[:, :width] * CODES + codes[:, i : i + width]) * CODES + last
    return np.where(last > 0, at, 0)


def lengths(codes: np.ndarray) -> np.ndarray:
    """The scale of every word: the kernel of a word with itself, were its triples all different."""
    n = (codes > 0).sum(axis=1)
    total = sum(np.maximum(n - j, 0) * DECAY ** (2 * (j + 1)) for _, j in TRIPLES)
    return np.sqrt(np.maximum(total, 1e-12))


def weigh(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The scaled inner product of every word's triples with a table of weights."""
    total = np.zeros(len(codes))
    for i, j in TRIPLES:
        total += DECAY ** (j + 1) * table[triples(codes, i, j)].sum(axis=1)
    return total / lengths(codes)


def profile(codes: np.ndarray) -> np.ndarray:
    """The scaled triples of one word (a row) as a table."""
    table = np.zeros(CODES**3)
    for i, j in TRIPLES:
        np.add.at(table, triples(codes[None, :], i, j)[0], DECAY ** (j + 1))
    table[0] = 0
    return table / lengths(codes[None, :])[0]


def kernel(codes: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    return np.stack([weigh(codes, profile(row)) for row in landmarks], axis=1)


def hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """A linear machine with squared hinge loss by Newton steps; the last weight is the constant."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, pull = np.zeros(x.shape[1]), np.ones(x.shape[1])
    pull[-1] = 1e-3
    active = None
    for _ in range(50):
        inside = y * (x @ w) < 1
        if active is not None and (inside == active).all():
            break
        active = inside
        a = x[active] * (cost * weight[active])[:, None]
        target = np.linalg.solve(a.T @ x[active] + np.diag(pull), a.T @ y[active])
        w = w + 0.7 * (target - w) if _ > 20 else target
    return w


class Machine:
    """The trained word machine as a table, and the curve from margins to scores."""

    def __init__(self, table: np.ndarray, constant: float):
        self.table, self.constant = table.astype(np.float32), constant
        self.curve = np.array([1.0, 0.0, 0.0, 0.0])

    def margins(self, words: list[str]) -> np.ndarray:
        found = np.empty(len(words))
        by_length = sorted(range(len(words)), key=lambda i: len(words[i]))  # little padding
        for first in range(0, len(words), 4096):
            some = by_length[first : first + 4096]
            found[some] = weigh(encode([words[i] for i in some]), self.table) + self.constant
        return found

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[:-1] + self.curve[-1], -500, 500)))


def features(margins: np.ndarray) -> list[float]:
    """The highest margins of a document and its number of words."""
    if not len(margins):
        return [-2.0, -2.0, 0.0]
    top = np.partition(margins, -2)[-2:] if len(margins) > 1 else np.array([-2.0, margins[0]])
    return [float(np.clip(top[1], -2, 2)), float(np.clip(top[0], -2, 2)), float(np.log1p(len(margins)))]


def witnesses(toxic: list[set[str]], clean: Counter, n_clean: int) -> Counter:
    """Words that explain the toxic documents, with how many they lie in."""
    lies_in: dict[str, list[int]] = {}
    for i, words in enumerate(toxic):
        for word in words:
            lies_in.setdefault(word, []).append(i)
    open_ = np.ones(len(toxic))
    penalty = 4 * len(toxic) / max(n_clean, 1)

    def gain(word: str) -> float:
        return float(open_[lies_in[word]].sum()) - penalty * clean[word]

    heap = [(-(len(docs) - penalty * clean[word]), word) for word, docs in lies_in.items() if len(docs) > 2]
    heapq.heapify(heap)
    found: Counter = Counter()
    while heap and len(found) < WITNESSES:
        _, word = heapq.heappop(heap)
        now = gain(word)
        if now < 1:
            continue
        if heap and now < -heap[0][0]:
            heapq.heappush(heap, (-now, word))
            continue
        found[word] = len(lies_in[word])
        open_[lies_in[word]] /= 2
    return found


def disguised(words: list[str], rng: np.random.Generator) -> list[str]:
    """Each word of some length with a character doubled, and with another one put in between."""
    found = []
    for word in words:
        if len(word) >= 4:
            for put in (None, "abcdefghijklmnopqrstuvwxyz*"[rng.integers(27)]):
                at = int(rng.integers(1, len(word)))
                found.append(word[:at] + (put or word[at]) + word[at:])
    return found


def nystroem(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the landmarks and the map from kernel values with them to features."""
    codes = encode(landmarks)
    values, vectors = np.linalg.eigh(kernel(codes, codes))
    keep = values > 1e-6 * values.max()
    return codes, vectors[:, keep] / np.sqrt(values[keep])


def fit(toxic: list[set[str]], clean: list[set[str]], totals: tuple[int, int]) -> Machine | float:
    """``totals`` are all clean and toxic documents, of which the lists are a sample."""
    if min(len(toxic), len(clean)) < FEWEST:
        return (totals[1] + 1) / (sum(totals) + 2)
    seen = Counter(word for words in clean for word in words)
    positive = witnesses(toxic, seen, len(clean))
    if not positive:
        return (totals[1] + 1) / (sum(totals) + 2)
    rng = np.random.default_rng(7)
    pool = sorted(word for word in seen if word not in positive)
    often = sorted(pool, key=lambda word: (-seen[word], word))[: NEGATIVES // 4]
    some = [pool[i] for i in rng.choice(len(pool), min(len(pool), NEGATIVES // 4), replace=False)] if pool else []
    negative = dict.fromkeys(often + some)
    machine = None
    for _ in range(ROUNDS):
        hard = []
        if machine is not None and pool:
            margins = machine.margins(pool)
            hard = [pool[i] for i in np.argsort(-margins, kind="stable")[: NEGATIVES // 8] if margins[i] > -0.7]
            negative.update(dict.fromkeys(hard))
            for words in toxic:
                if not any(word in positive for word in words):
                    own = sorted(word for word in words if word not in seen)
                    found = machine.margins(own)
                    if len(own) and found.max() > SURE:
                        positive[own[int(found.argmax())]] += 1
        ranked = [word for word, _ in positive.most_common(LANDMARKS // 2)]
        others = hard[: LANDMARKS // 4] + [often[i] for i in range(min(len(often), LANDMARKS // 2))]
        landmarks = list(dict.fromkeys(ranked + others))[:LANDMARKS]
        codes, to_features = nystroem(landmarks)
        changed = [word for word in disguised(list(positive), rng) if word not in seen]
        words = [*positive, *changed, *negative]
        x = kernel(encode(words), codes) @ to_features
        y = np.array([1.0] * (len(words) - len(negative)) + [-1.0] * len(negative))
        weight = np.array([0.5 / len(positive)] * len(positive) + [0.2 / max(len(changed), 1)] * len(changed) + [0.5 / max(len(negative), 1)] * len(negative))
        weight *= len(y)
        w = hinge(x, y, weight)
        shares = to_features @ w[:-1]
        table = sum(share * profile(row) for share, row in zip(shares, codes))
        machine = Machine(table, float(w[-1]))
    known = sorted({word for words in [*toxic, *clean] for word in words})
    margin = dict(zip(known, machine.margins(known)))
    x = np.array([features(np.array([margin[word] for word in words])) for words in [*toxic, *clean]])
    y = np.array([1] * len(toxic) + [0] * len(clean))
    weight = np.where(y == 1, totals[1] / len(toxic), totals[0] / len(clean))
    machine.curve = calibrated(x, y, weight / weight.mean(), keep=0.1)
    return machine


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, "body", SLICE)):
        found = [sorted(words_of((body.as_py() or b"").decode("utf-8", "replace"))) for body in batch.column("body")]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.string()))], ["label", "words"])


def train(documents: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", key: str = "doc_id", text: str = "text"):
    rows, totals = labelled_sample(documents, labels, label, learn, SAMPLE, key, text)
    same: dict[str, str] = {}  # every word is held once
    rows = rows.mapInArrow(_words, "label int, words array<string>").toLocalIterator()
    found = sorted((row["label"], [same.setdefault(word, word) for word in row["words"]]) for row in rows)
    toxic, clean = ([set(words) for value, words in found if value == i] for i in (1, 0))
    del found, same
    return fit(toxic, clean, totals)


def score(documents: DataFrame, model: Machine | float, text: str = "text", name: str = "score") -> DataFrame:
    """Every row plus the probability that it is toxic; a column of that name is replaced."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    columns = [F.col(f"`{c}`") for c in documents.columns if c != name]
    schema = documents.select(*columns).schema.add(name, "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, margin = shared.value, {}
        for batch in (part for whole in batches for part in slices(whole, text, SLICE)):
            if isinstance(model, float):
                values = np.full(batch.num_rows, model)
            else:
                # The text itself, seen as bytes: a second column of them would double the batches outside the heap.
                bodies = batch.column(text).cast(pa.binary())
                found = [words_of((body.as_py() or b"").decode("utf-8", "replace")) for body in bodies]
                new = list(set().union(*found) - margin.keys())
                margin.update(zip(new, model.margins(new)))
                values = model.score(np.array([features(np.array([margin[word] for word in words])) for words in found]))
                if len(margin) > CACHE:
                    margin.clear()
            yield batch.append_column(name, pa.array(values, pa.float64()))

    return documents.select(*columns).mapInArrow(scored, schema)
