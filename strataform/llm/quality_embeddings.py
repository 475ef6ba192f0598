"""Quality of texts by supervised subword embeddings.

Each word, each character n-gram of the word between ``<`` and ``>``, and each pair
of neighbouring words is hashed into a table of learned vectors; all pairs of a
word with itself share one vector.  A document is the average of the vectors of
all its words, n-grams and pairs; a linear layer and a softmax give the
probability of label 1.  Table and layer are trained by stochastic gradient descent in numpy:
documents are dealt to a fixed number of workers, every round starts each worker
from the average of the last one's results.

A step on the average is spread over the document's rows in proportion to their
counts so that the average itself moves by the learning rate, whatever the length
of the text.

The table is fitted on a bounded sample of labelled documents (at most ``SAMPLE``
ids, those with the smallest hashes); scores cover every whole text.  As the layer
is linear, a score needs one number a table row: the vectors' difference between
the two classes.

Defined results: null and empty texts, and texts without words, have the layer's
own probability (the average of no vectors is zero); labels that are null, or of
unknown documents, are ignored; a document labelled more than once counts with its
smallest label, and one id with several texts gives its smallest text; without
labels every score is 0.5; very long texts are scored in memory in proportion to
their length; equal texts have equal scores; repeated rows and null ids give one
row each; ids may be of any type; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_table, texts_of, with_field

SAMPLE = 8192
BUCKETS = 1 << 15  # for words, as many for n-grams and for pairs of words
TABLE = 3 * BUCKETS + 1
WIDTH = 16
GRAMS = (3, 4, 5)
WORKERS = 4
ROUNDS = 3
EPOCHS = 2
#: A worker with few documents goes over them more often, to about this many steps
#: a round.
STEPS = 1000
RATE = 0.3
GOOD_FROM = 0.7
#: Words whose features a task keeps; bounds memory, changes nothing.
KNOWN_WORDS = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)


def pair_features(codes: np.ndarray) -> np.ndarray:
    """Table rows of the pairs of neighbours, from the words' hashes."""
    with np.errstate(over="ignore"):
        hashed = (codes[:-1] * _ODD + codes[1:]) * _ODD
    rows = (hashed >> np.uint64(17)).astype(np.int64) % BUCKETS + 2 * BUCKETS
    return np.where(codes[:-1] == codes[1:], TABLE - 1, rows)


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words], np.uint64)


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of each word and its n-grams, one word after the other, and the
    words' bounds."""
    marked = [f"<{w.decode(errors='replace')}>" for w in words]
    sizes = np.array([len(m) for m in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - starts[owner]
    rows = [word_codes(words).astype(np.int64) % BUCKETS]
    owners = [np.arange(len(words))]
    with np.errstate(over="ignore"):
        for n in GRAMS:
            whole = np.flatnonzero(place + n <= sizes[owner])
            hashed = np.full(len(whole), n, np.uint64)
            for i in range(n):
                hashed = (hashed + codes[whole + i] + np.uint64(1)) * _ODD
                hashed ^= hashed >> np.uint64(29)
            rows.append((hashed >> np.uint64(17)).astype(np.int64) % BUCKETS + BUCKETS)
            owners.append(owner[whole])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    bounds = np.searchsorted(owners[order], np.arange(len(words) + 1))
    return np.concatenate(rows)[order], bounds


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Table rows that occur in the text, and how often."""
    found = text.encode(errors="replace").split()
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    words: dict[bytes, int] = {}
    at = np.fromiter((words.setdefault(w, len(words)) for w in found), np.int64, len(found))
    rows, bounds = word_features(list(words))
    pairs = pair_features(word_codes(list(words))[at])
    times = np.concatenate([np.repeat(np.bincount(at), np.diff(bounds)), np.ones(len(pairs), np.int64)])
    rows, place = np.unique(np.concatenate([rows, pairs]), return_inverse=True)
    return rows, np.bincount(place, weights=times).astype(np.int64)


@dataclass
class Model:
    """Vectors of the table rows, and the layer: two columns and two offsets."""

    table: np.ndarray
    layer: np.ndarray
    offset: np.ndarray
    room: np.ndarray | None = None

    @classmethod
    def fresh(cls) -> "Model":
        table = np.random.default_rng(7).uniform(-1 / WIDTH, 1 / WIDTH, (TABLE, WIDTH))
        return cls(table.astype(np.float32), np.zeros((WIDTH, 2), np.float32),
                   np.zeros(2, np.float32))

    def packed(self) -> bytes:
        return np.concatenate([self.table.ravel(), self.layer.ravel(), self.offset]).tobytes()

    @classmethod
    def unpacked(cls, flat: np.ndarray) -> "Model":
        n = TABLE * WIDTH
        return cls(flat[:n].reshape(-1, WIDTH).copy(), flat[n:n + 2 * WIDTH].reshape(WIDTH, 2).copy(),
                   flat[n + 2 * WIDTH:].copy())

    def step(self, rows: np.ndarray, counts: np.ndarray, label: int, rate: float) -> None:
        """One step of gradient descent on one document."""
        share = (counts / max(1, counts.sum())).astype(np.float32)
        if self.room is None or self.room.shape[1] < len(rows):
            self.room = np.empty((2, 2 * len(rows), WIDTH), np.float32)  # used by every step
        found, move = self.room[:, :len(rows)]
        np.take(self.table, rows, axis=0, out=found, mode="clip")
        average = share @ found
        z = average @ self.layer + self.offset
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        p *= np.float32(rate)
        slope = self.layer @ p
        self.layer -= np.outer(average, p)
        self.offset -= p
        if len(rows):
            found -= np.outer(share / (share @ share), slope, out=move)
            self.table[rows] = found

    def differences(self) -> tuple[np.ndarray, float]:
        """What each table row and the offset add in favour of label 1."""
        lean = self.layer[:, 1].astype(np.float64) - self.layer[:, 0]
        return self.table @ lean, float(self.offset[1] - self.offset[0])


def _sample(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, size: int,
            id_col: str, text_col: str) -> DataFrame:
    """(place, label, rows, counts) of at most ``size`` labelled documents."""
    known = (labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull())
             .groupBy(F.col(f"`{id_col}`").alias("id"))
             .agg(F.min(F.col(f"`{label_col}`").cast("int")).alias("label")).where(learn))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # Only ids that have a text may take a place in the sample.
    known = known.join(texts.select("id"), "id", "left_semi").select(
        "id", "label", F.xxhash64("id").alias("place"))
    chosen = known.orderBy("place", "id").limit(size)
    # The sample has at most ``size`` rows.
    picked = texts.join(F.broadcast(chosen), "id").groupBy("id", "label", "place").agg(
        F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 64):
                found = [text_features(t) for t in texts_of(batch.column(2).slice(i, 64))]
                bounds = pa.array(np.cumsum([0, *(len(r) for r, _ in found)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 64), batch.column(1).slice(i, 64),
                     pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(
                         [r for r, _ in found]), pa.int32())),
                     pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(
                         [c for _, c in found]), pa.int32()))],
                    names=["place", "label", "rows", "counts"])

    return scratch_table(picked.select("place", "label", "text").mapInArrow(
        run, "place bigint, label int, rows array<int>, counts array<int>"), "quality-sample")


def _worker(sent, r: int, worker: int):
    """The steps of one worker in round ``r``, from the model that was sent."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, items = Model.unpacked(np.frombuffer(sent.value, np.float32)), []
        for batch in batches:
            for place, label, rows, counts in zip(*batch.columns[:4], strict=True):
                items.append((place.as_py(), rows.values.to_numpy(), counts.values.to_numpy(),
                              min(max(label.as_py(), 0), 1)))
        if not items:
            return
        items.sort(key=lambda item: item[0])
        mixed = np.random.default_rng([r, worker])
        epochs = max(EPOCHS, -(-STEPS // len(items)))
        steps, done = epochs * len(items), 0
        for _ in range(epochs):
            for i in mixed.permutation(len(items)):
                # The rate falls in a line over all rounds.
                own.step(*items[i][1:], RATE * (1 - (r + done / steps) / ROUNDS))
                done += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(items)], pa.int64()), pa.array([own.packed()], pa.binary())],
            names=["n", "model"])
    return work


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality",
          size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of the labels (0 or 1) of the documents for whose ``id`` ``learn`` holds."""
    spark = docs.sparkSession
    sample = _sample(docs, labels, label_col, learn, size, id_col, text_col)
    dealt = sample.withColumn("worker", F.pmod(F.xxhash64("place"), F.lit(WORKERS)))
    model = Model.fresh()
    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model.packed())
        # Each worker reads its share of the sample, which is bounded, in one task;
        # one row a worker comes back.
        shares = [dealt.where(F.col("worker") == w).coalesce(1).mapInArrow(
            _worker(sent, r, w), "n bigint, model binary") for w in range(WORKERS)]
        results = reduce(DataFrame.unionByName, shares).collect()
        sent.destroy()
        total = sum(row.n for row in results)
        if not total:
            break
        flat = sum(np.frombuffer(bytes(row.model), np.float32).astype(np.float64) * (row.n / total)
                   for row in sorted(results, key=lambda row: bytes(row.model)))
        model = Model.unpacked(flat.astype(np.float32))
    return model


class Scorer:
    """What each word adds, looked up once a task."""

    def __init__(self, lean: np.ndarray, offset: float):
        self.lean, self.offset = lean, offset
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.sums, self.sizes, self.codes = np.empty(0), np.empty(0), np.empty(0, np.uint64)

    def scores(self, texts: list[str]) -> np.ndarray:
        words = [t.encode(errors="replace").split() for t in texts]
        new = list(dict.fromkeys(w for found in words for w in found if w not in self.known))
        if new and len(self.known) + len(new) > KNOWN_WORDS and self.known:
            self._forget()
            new = list(dict.fromkeys(w for found in words for w in found))
        sums, sizes = [self.sums], [self.sizes]
        for i in range(0, len(new), 4096):
            rows, bounds = word_features(new[i:i + 4096])
            sums.append(np.add.reduceat(self.lean[rows], bounds[:-1]))
            sizes.append(np.diff(bounds).astype(np.float64))
        self.known.update((w, i) for i, w in enumerate(new, len(self.known)))
        self.sums, self.sizes = np.concatenate(sums), np.concatenate(sizes)
        self.codes = np.concatenate([self.codes, word_codes(new)])
        z = np.full(len(texts), self.offset)
        for i, found in enumerate(words):
            if found:
                at = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
                pairs = self.lean[pair_features(self.codes[at])].sum()
                z[i] += (self.sums[at].sum() + pairs) / (self.sizes[at].sum() + len(found) - 1)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of every whole text behind the
    other columns."""
    lean, offset = model.differences()
    schema = with_field(docs.schema, (name, T.DoubleType()))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(lean, offset)
        for batch in batches:
            texts = texts_of(batch.column(at).cast(pa.large_string()))
            scores, first, chars = [np.empty(0)], 0, 0
            for i, t in enumerate(texts):
                chars += len(t)
                if chars > 1 << 20 or i + 1 == len(texts):
                    scores.append(scorer.scores(texts[first:i + 1]))
                    first, chars = i + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores))],
                                             names=schema.names)

    return docs.mapInArrow(run, schema)
