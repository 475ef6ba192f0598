"""Language identification by nearest centroids.

A text becomes the normalised TF-IDF vector of its hashed byte trigrams.  Each
language has several centroids, found by spherical k-means; a text gets the
language of the centroid with the largest cosine.  A text that is much farther
from every centroid than texts of its length usually are is rejected.

Learning: document frequencies, the last centroid update and the limits of
rejection cover every learning text, as sums over partitions.  The limits come
from three counts by length: how near learning texts are to centroids of their
own language (each left out of its centroid), how near to those of other
languages, and how near their shuffled characters are to any.  Only the k-means
seeds come from a sample: of each language the ``SAMPLE_PER_LANGUAGE`` distinct
texts with the smallest hashes (a documented bound).

Defined results: a text that is null or has no letter is ``und`` with score 0
and is rejected; with nothing to learn from, every text is ``und``; ties go to
the language first in order; a very long text is read whole, and lengths beyond
the last class share its limit; repeated rows and null ids give one row each; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_blocks, texts_of, with_field
from .ngrams import trigram_counts

DIMS = 1 << 12
CLUSTERS = 4
SAMPLE_PER_LANGUAGE = 400
#: Length classes (log2 of the number of trigrams), steps of a counted cosine, and
#: the learning texts that a class must have to get a limit of its own.
LENGTHS, BINS, ENOUGH = 16, 512, 20
#: The limit lies between the cosine that all but ``KEPT_ASIDE`` of a language's
#: texts reach and the one that ``OTHERS`` of the other texts stay below.
KEPT_ASIDE, OTHERS, BETWEEN = 0.001, 0.99, 0.5
UNDETERMINED = "und"
#: Shares of a language's hashes from which the smallest are taken first.
SHARES = 64
#: Rows and bytes of text that a step holds counts of at a time, at least one text.
_ROWS, _BYTES = 64, 1 << 18


@dataclass
class Model:
    languages: list[str]  # of each centroid
    idf: np.ndarray
    centroids: np.ndarray  # (centroids, dims), unit length
    limits: np.ndarray  # least cosine by log2 of the number of trigrams

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid, its cosine and whether it is too far."""
        vectors = tf_idf(counts, self.idf)
        cosine = vectors @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0).astype(np.float64)
        return best, score, score < self.limits[length_class(counts.sum(axis=1))]


def length_class(trigrams: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(trigrams, 1)).astype(np.int64), LENGTHS - 1)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts.astype(np.float32)) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _counts(column: pa.Array, dims: int) -> Iterator[tuple[int, int, np.ndarray]]:
    return trigram_counts(column, dims, _ROWS, _BYTES)


def _learning(docs: DataFrame, learn: Column, text_col: str, lang_col: str) -> DataFrame:
    return docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"),
        F.lower(F.col(text_col).cast("string")).alias("text"))


def document_frequencies(learning: DataFrame, dims: int) -> tuple[np.ndarray, int]:
    """Texts that hold each trigram bin, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims + 1, np.int64)
        for batch in batches:
            for _, _, counts in _counts(batch.column(0), dims):
                total[:dims] += (counts > 0).sum(axis=0)
                total[dims] += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1)), pa.array(total)],
                                         names=["bin", "n"])

    rows = learning.select("text").mapInArrow(run, "bin bigint, n bigint").groupBy("bin").agg(
        F.sum("n").alias("n")).collect()  # dims + 1 rows
    total = np.zeros(dims + 1, np.int64)
    for r in rows:
        total[r["bin"]] = r["n"]
    return total[:dims], int(total[dims])


def _seed_centroids(sample: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from farthest-first seeds."""
    seeds = [int(np.argmax(sample @ sample.mean(axis=0)))]
    while len(seeds) < min(clusters, len(sample)):
        nearest = (sample @ sample[seeds].T).max(axis=1)
        seeds.append(int(np.argmin(nearest)))
    centroids = sample[seeds]
    for _ in range(rounds):
        owner = (sample @ centroids.T).argmax(axis=1)
        sums = np.stack([sample[owner == c].sum(axis=0) if (owner == c).any() else centroids[c]
                         for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def _sample(learning: DataFrame, per_language: int) -> DataFrame:
    """The ``per_language`` distinct texts of each language with the smallest hashes."""
    hashed = learning.withColumn("h", F.xxhash64("text"))
    # Hashes only: the smallest of each share of a language, then of the language.
    found = hashed.select("lang", "h").distinct()
    for share in (F.pmod("h", F.lit(SHARES)), F.lit(0)):
        smallest = Window.partitionBy("lang", share).orderBy("h")
        found = found.withColumn("place", F.row_number().over(smallest)).where(
            F.col("place") <= per_language).drop("place")
    last = found.groupBy("lang").agg(F.max("h").alias("last"))
    # One row for each language.
    return hashed.join(F.broadcast(last), "lang").where("h <= last").groupBy("lang", "h").agg(
        F.min("text").alias("text"))


def _seeds(learning: DataFrame, idf: np.ndarray, dims: int, clusters: int,
           per_language: int) -> DataFrame:
    """Seed centroids of each language: lang, cluster, vector."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = np.concatenate([tf_idf(c, idf) for _, _, c in _counts(
            pa.array(frame.sort_values("h")["text"], pa.string()), dims)])
        centroids = _seed_centroids(vectors, clusters).astype(np.float32)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "cluster": range(len(centroids)),
                             "vector": [v.tobytes() for v in centroids]})

    return _sample(learning, per_language).groupBy("lang").applyInPandas(
        fit, "lang string, cluster bigint, vector binary")


def _refined(learning: DataFrame, languages: list[str], seeds: np.ndarray, idf: np.ndarray,
             dims: int) -> np.ndarray:
    """Sums of all learning texts nearest to each seed of their language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = {lang: np.flatnonzero([x == lang for x in languages]) for lang in set(languages)}
        total = np.zeros((len(languages), dims), np.float64)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for a, b, counts in _counts(batch.column(1), dims):
                vectors = tf_idf(counts, idf)
                cosine = vectors @ seeds.T
                for lang in set(langs[a:b]) & set(of):
                    rows = np.flatnonzero([x == lang for x in langs[a:b]])
                    owner = of[lang][cosine[np.ix_(rows, of[lang])].argmax(axis=1)]
                    np.add.at(total, owner, vectors[rows])
        c, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c), pa.array(b), pa.array(total[c, b])], names=["centroid", "bin", "weight"])

    rows = learning.select("lang", "text").mapInArrow(
        run, "centroid bigint, bin bigint, weight double").groupBy("centroid", "bin").agg(
        F.sum("weight").alias("weight"))
    found = rows.toPandas()  # centroids x dims at most
    total = np.zeros((len(languages), dims))
    total[found["centroid"], found["bin"]] = found["weight"]
    return total.astype(np.float32)


def shuffled(text: str) -> str:
    """The characters of a text in another order, which the text alone decides."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    order = np.random.default_rng(zlib.crc32(text.encode())).permutation(len(points))
    return points[order].tobytes().decode("utf-32-le")


def _similarities(learning: DataFrame, languages: list[str], seeds: np.ndarray, sums: np.ndarray,
                  centroids: np.ndarray, idf: np.ndarray, dims: int) -> np.ndarray:
    """Learning texts by kind, length class and cosine (in ``BINS`` steps): to the
    nearest centroid of their language, themselves left out of it (kind 0); to the
    nearest of another language (1); of the shuffled text to any (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, LENGTHS, BINS), np.int64)
        lengths = np.square(sums.astype(np.float64)).sum(axis=1)
        named = np.array(languages)

        def add(kind: int, classes: np.ndarray, cosine: np.ndarray) -> None:
            step = np.clip(cosine * BINS, 0, BINS - 1).astype(np.int64)
            np.add.at(total[kind], (classes, step), 1)

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist())
            for a, b, counts in _counts(batch.column(1), dims):
                vectors, classes = tf_idf(counts, idf), length_class(counts.sum(axis=1))
                every = np.arange(b - a)
                own = langs[a:b, None] == named[None, :]
                owner = np.where(own, vectors @ seeds.T, -2).argmax(axis=1)
                cosine = (vectors @ centroids.T).astype(np.float64)
                dot = (vectors * sums[owner]).sum(axis=1, dtype=np.float64)
                rest = np.sqrt(np.maximum(lengths[owner] - 2 * dot + 1, 0))
                other = np.where(own, -1, cosine).max(axis=1)
                add(1, classes[other >= 0], other[other >= 0])
                cosine[every, owner] = np.where(rest > 1e-3, (dot - 1) / np.maximum(rest, 1e-3), 0)
                add(0, classes, np.where(own, cosine, -1).max(axis=1))
                texts = batch.column(1).slice(a, b - a).to_pylist()
                for _, _, counts in _counts(pa.array(map(shuffled, texts), pa.string()), dims):
                    add(2, length_class(counts.sum(axis=1)),
                        (tf_idf(counts, idf) @ centroids.T).max(axis=1))
        found = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, found), pa.array(total[found])], names=["kind", "length", "step", "n"])

    rows = learning.select("lang", "text").mapInArrow(
        run, "kind bigint, length bigint, step bigint, n bigint").groupBy(
        "kind", "length", "step").agg(F.sum("n").alias("n")).toPandas()  # 3 x LENGTHS x BINS
    total = np.zeros((3, LENGTHS, BINS), np.int64)
    total[rows["kind"], rows["length"], rows["step"]] = rows["n"]
    return total


def _quantile(steps: np.ndarray, share: float) -> float:
    """The cosine that ``share`` of the counted texts stay below."""
    if not steps.sum():
        return 0.0
    return int(np.searchsorted(np.cumsum(steps), share * steps.sum())) / BINS


def limits(similarities: np.ndarray) -> np.ndarray:
    """The cosine below which a text of each length is rejected: between what texts
    of no or another language reach and what nearly all of the language do, and
    never above the latter.  A length with too few texts takes the limit of the
    next shorter one, or none."""
    out, last = np.zeros(LENGTHS), 0.0
    for c in range(LENGTHS):
        own, other, mixed = similarities[:, c]
        if own.sum() >= ENOUGH:
            near = _quantile(own, KEPT_ASIDE)
            far = max(_quantile(other, OTHERS), _quantile(mixed, OTHERS))
            last = far + BETWEEN * (near - far) if near > far else near
        out[c] = last
    return out


def fit(docs: DataFrame, learn: Column, dims: int = DIMS, clusters: int = CLUSTERS,
        per_language: int = SAMPLE_PER_LANGUAGE, text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Learn from the rows where ``learn`` holds and text and language are known."""
    learning = _learning(docs, learn, text_col, lang_col)
    seen, n = document_frequencies(learning, dims)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    rows = sorted(_seeds(learning, idf, dims, clusters, per_language).collect(),
                  key=lambda r: (r["lang"], r["cluster"]))
    if not rows:
        return Model([], idf, np.zeros((0, dims), np.float32), np.zeros(LENGTHS))
    languages = [r["lang"] for r in rows]
    seeds = np.stack([np.frombuffer(r["vector"], np.float32) for r in rows])
    sums = _refined(learning, languages, seeds, idf, dims)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    centroids = np.where(norm > 0, sums / np.maximum(norm, 1e-12), seeds)
    return Model(languages, idf, centroids, limits(
        _similarities(learning, languages, seeds, sums, centroids, idf, dims)))


def classify(docs: DataFrame, model: Model, text_col: str = "text",
             names: tuple[str, str, str] = ("lang_pred", "score", "rejected"),
             keep_text: bool = True) -> DataFrame:
    """``docs`` with three more columns: language, cosine, and whether the text is
    too far from all centroids; without the text itself unless ``keep_text``."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # centroids x dims
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    columns = [docs.columns[i] for i in kept]
    schema = with_field(T.StructType([docs.schema[i] for i in kept]), (names[0], T.StringType()), (names[1], T.DoubleType()),
                        (names[2], T.BooleanType()))
    dims = len(model.idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            n = batch.num_rows
            langs, scores, far = [UNDETERMINED] * n, [0.0] * n, [True] * n
            for first, last, *_ in text_blocks(batch.column(at)) if m.languages else ():
                texts = texts_of(batch.column(at).slice(first, last - first))
                letters = [any(map(str.isalpha, t[:64])) or any(map(str.isalpha, t)) for t in texts]
                lowered = pa.array([t.lower() for t in texts], pa.string())
                for a, b, counts in _counts(lowered, dims):
                    best, score, reject = m.predict(counts)
                    for i, c, s, r in zip(range(a, b), best.tolist(), score.tolist(),
                                          reject.tolist(), strict=True):
                        if letters[i]:
                            i += first
                            langs[i], scores[i], far[i] = m.languages[c], s, r
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(far, pa.bool_())],
                names=[*columns, *names])

    return docs.mapInArrow(run, schema)


def identified(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", **parameters) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, rejected."""
    model = fit(docs, learn, text_col=text_col, lang_col=lang_col, **parameters)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return classify(rows, model, keep_text=False)


def keep_identified(docs: DataFrame, learn: Column, text_col: str = "text",
                    lang_col: str = "lang", **parameters) -> DataFrame:
    """The documents whose language is known, with all their columns."""
    model = fit(docs, learn, text_col=text_col, lang_col=lang_col, **parameters)
    columns = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    marked = classify(numbered, model, f"c{columns.index(text_col)}", ("l", "s", "r"))
    return marked.where("not r").drop("l", "s", "r").toDF(*columns)
