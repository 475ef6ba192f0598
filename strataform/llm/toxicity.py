"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models; each later
model also sees the probabilities of the categories before it.  While learning,
those probabilities are out-of-fold predictions, so that a later model meets the
kind of estimates it will meet on new texts.

Features are counts of whole words and of word beginnings.  They are chosen by
chi-square on the learning rows, then looked up in every word of a text; counts
are not divided by the length, so a few toxic words weigh the same in a long
text.  The models are fitted on a bounded sample of labelled rows (at most about
``SAMPLE_PER_CLASS`` for each value of the last category, drawn by a hash of the
id); predictions cover every whole text.

Defined results: null text, and text without words, has probability 0 in every
category; labels that are null, or of unknown documents, are ignored; a document
labelled more than once counts with its largest label; without labels of both
kinds a category's probability is its share (0 without any); repeated rows and
null ids give one row each; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_table, texts_of, with_field

SAMPLE_PER_CLASS = 4000
FEATURES = 512
FOLDS = 5
PREFIXES = range(3, 7)
RIDGE = 0.1
TOXIC_FROM = 0.5

# Words that mark the two narrower categories of a toxic text.
INSULT_WORDS = ("clown", "fool", "idiot", "loser", "moron", "stupid")
CONTEMPT_WORDS = ("disgusting", "garbage", "pathetic", "scum", "trash", "worthless")

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """The whole word, and its beginnings marked by a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 12
                 ) -> np.ndarray:
    """Weights and, last, the intercept, by Newton steps with an L2 penalty."""
    share = y.mean() if len(y) else 0.0
    w = np.zeros(x.shape[1] + 1)
    if share in (0.0, 1.0):
        w[-1] = 30.0 if share else -30.0
        return w
    one = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = _sigmoid(one @ w)
        slope = one.T @ (p - y) + penalty * w
        curve = (one * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ one + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


@dataclass
class Chain:
    categories: list[str]
    features: dict[str, int]
    weights: list[np.ndarray]
    memo: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def row(self, text: str) -> dict[int, int]:
        """Feature counts of one text."""
        if len(self.memo) > 300_000:  # bounds memory, changes nothing
            self.memo.clear()
        found: dict[int, int] = {}
        for word, n in Counter(_WORD.findall(text.lower())).items():
            ids = self.memo.get(word)
            if ids is None:
                ids = tuple(self.features[f] for f in word_features(word) if f in self.features)
                self.memo[word] = ids
            for i in ids:
                found[i] = found.get(i, 0) + n
        return found

    def matrix(self, rows: list[dict[int, int]]) -> np.ndarray:
        x = np.zeros((len(rows), len(self.features)))
        for r, found in enumerate(rows):
            for i, n in found.items():
                x[r, i] = n
        return np.log1p(x)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (rows, categories) along the chain."""
        done = np.zeros((len(x), 0))
        for w in self.weights:
            p = _sigmoid(np.hstack([x, done]) @ w[:-1] + w[-1])
            done = np.hstack([done, p[:, None]])
        return done


def _sample(docs: DataFrame, labels: DataFrame, categories: list[str], learn: Column,
            per_class: int, id_col: str, text_col: str) -> DataFrame:
    """Labelled texts: id, text and the categories as 0 or 1."""
    last = categories[-1]
    known = (labels.where(F.col(id_col).isNotNull() & F.col(last).isNotNull())
             .groupBy(F.col(id_col).alias("id"))
             .agg(*[F.max(F.coalesce(F.col(c), F.lit(0)).cast("int")).alias(c)
                    for c in categories]))
    known = known.where(learn)
    sizes = {r[0]: r[1] for r in known.groupBy(last).count().collect()}
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.coalesce(*[F.when(F.col(last) == v, F.lit(min(1.0, per_class / n)))
                         for v, n in sizes.items()], F.lit(0.0))
    # At most about per_class rows for each of the two values.
    chosen = F.broadcast(known.where(place < share))
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(chosen, "id")


def choose_features(sample: DataFrame, categories: list[str], n: int) -> dict[str, int]:
    """The features of the largest chi-square with some category."""
    k = len(categories)
    names = [f"n{i}" for i in range(k + 1)]
    schema = "feature string, " + ", ".join(f"{c} bigint" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter] = [Counter() for _ in names]
        for batch in batches:
            marks = [batch.column(i + 1).to_pylist() for i in range(k)]
            for r, text in enumerate(texts_of(batch.column(0))):
                found = {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}
                held[k].update(found)
                for i in range(k):
                    if marks[i][r]:
                        held[i].update(found)
        keys = list(held[k])
        for at in range(0, len(keys), 50_000):
            some = keys[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string()),
                 *(pa.array([h[f] for f in some], pa.int64()) for h in held)],
                names=["feature", *names])

    counts = scratch_table(
        sample.select("text", *categories).mapInArrow(run, schema).groupBy("feature").agg(
            *[F.sum(c).alias(c) for c in names]).where(F.col(names[k]) >= 3), "feature-counts")
    totals = sample.agg(F.count(F.lit(1)), *[F.sum(c) for c in categories]).first()
    chosen: list[str] = []
    for i in range(k):
        rows, hits = float(totals[0] or 0), float(totals[i + 1] or 0)
        if not 0 < hits < rows:
            continue
        a, seen = F.col(names[i]).cast("double"), F.col(names[k]).cast("double")
        expected = seen * (hits / rows)
        chi = (a - expected) ** 2 / (expected * (1 - hits / rows)
                                     * (F.lit(1.0) - seen / (rows + 1)))
        chosen += [r[0] for r in counts.select("feature", chi.alias("chi")).orderBy(
            F.desc("chi"), "feature").limit(n // k).collect()]
    return {f: i for i, f in enumerate(dict.fromkeys(chosen))}


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], learn: Column | None = None,
        per_class: int = SAMPLE_PER_CLASS, features: int = FEATURES, folds: int = FOLDS,
        id_col: str = "doc_id", text_col: str = "text",
        derive: dict[str, Column] | None = None) -> Chain:
    """Learn the chain in the order of ``categories``, the decisive one last.

    ``labels`` has the id and 0/1 columns; ``derive`` gives categories that are
    conditions on the columns text and the labelled ones.  ``learn`` restricts
    the learning rows by a condition on the column id.
    """
    derive = derive or {}
    given = [c for c in categories if c not in derive]
    sample = _sample(docs, labels, given, F.lit(True) if learn is None else learn, per_class,
                     id_col, text_col)
    sample = scratch_table(sample.select("id", "text", *[
        F.coalesce(derive[c].cast("int"), F.lit(0)).alias(c) if c in derive else F.col(c)
        for c in categories]), "toxicity-sample")
    chain = Chain(categories, choose_features(sample, categories, features), [])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [chain.row(t) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([list(r) for r in rows], pa.list_(pa.int32())),
                 pa.array([list(r.values()) for r in rows], pa.list_(pa.int32())),
                 *batch.columns[2:]], names=["id", "at", "n", *categories])

    schema = "id string, at array<int>, n array<int>, " + ", ".join(f"`{c}` int" for c in categories)
    # The bounded sample, as feature counts.
    rows = sample.select(F.col("id").cast("string"), "text", *categories).mapInArrow(
        counted, schema).toPandas().sort_values("id", kind="stable")
    x = chain.matrix([dict(zip(a, n, strict=True)) for a, n in
                      zip(rows["at"], rows["n"], strict=True)])
    fold = (pd.util.hash_array(rows["id"].astype(str).to_numpy(object)) % folds).astype(int) \
        if len(rows) else np.zeros(0, int)
    earlier = np.zeros((len(rows), 0))
    for c in categories:
        y = rows[c].to_numpy(float)
        seen = np.hstack([x, earlier])
        chain.weights.append(fit_logistic(seen, y))
        out = np.zeros(len(y))
        for k in range(folds):
            w = fit_logistic(seen[fold != k], y[fold != k])
            out[fold == k] = _sigmoid(seen[fold == k] @ w[:-1] + w[-1])
        earlier = np.hstack([earlier, out[:, None]])
    return chain


def score(docs: DataFrame, chain: Chain, text_col: str = "text",
          names: list[str] | None = None) -> DataFrame:
    """``docs`` with a probability for each category (columns p_<category>)."""
    names = names or [f"p_{c}" for c in chain.categories]
    held = docs.sparkSession.sparkContext.broadcast(chain)  # FEATURES words, small weights
    columns = docs.columns
    at = columns.index(text_col)
    schema = with_field(docs.schema, *[(n, T.DoubleType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held.value
        for batch in batches:
            texts = texts_of(batch.column(at))
            p = np.zeros((len(texts), len(names)))
            for a in range(0, len(texts), 256):
                some = texts[a:a + 256]
                worded = np.array([bool(_WORD.search(t)) for t in some], bool)
                p[a:a + 256] = c.predict(c.matrix([c.row(t) for t in some])) * worded[:, None]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(p[:, i]) for i in range(len(names)))],
                names=[*columns, *names])

    return docs.mapInArrow(run, schema)


def toxicity_chain(docs: DataFrame, labels: DataFrame, learn: Column | None = None,
                   id_col: str = "doc_id", text_col: str = "text", **parameters) -> Chain:
    """The chain insult, contempt, toxic from a 0/1 label ``toxic``: the two
    narrower categories are toxic texts that hold one of their words."""
    def holds(words: tuple[str, ...]) -> Column:
        return (F.col("toxic") == 1) & F.lower("text").rlike(rf"\b({'|'.join(words)})\b")

    return fit(docs, labels.select(id_col, "toxic"), ["insult", "contempt", "toxic"], learn,
               id_col=id_col, text_col=text_col,
               derive={"insult": holds(INSULT_WORDS), "contempt": holds(CONTEMPT_WORDS)},
               **parameters)


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text",
               toxic_from: float = TOXIC_FROM) -> DataFrame:
    """The documents whose last category's probability is below ``toxic_from``,
    with all their columns."""
    columns = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    names = [f"p{i}" for i in range(len(chain.categories))]
    marked = score(numbered, chain, f"c{columns.index(text_col)}", names)
    return marked.where(F.col(names[-1]) < toxic_from).drop(*names).toDF(*columns)
