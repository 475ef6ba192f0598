import base64
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataform.llm import language_id, queries
from strataform.llm.common import held_out
from strataform.llm.ngrams import trigram_counts


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.queries()["op1_language_id"](spark, sf)
    langs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(langs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and 150 < len(held) < 250
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 2


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return language_id.fit(docs, F.lit(True))


def test_edge_rows(edge_docs, model):
    rows = language_id.classify(edge_docs.select("doc_id", "text"), model).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        known = r.text is not None and any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == (not known)
        assert known or (r.score == 0 and r.rejected)


def test_far_texts_are_rejected_and_near_ones_are_not(spark, model):
    rows = [(1, "щжы ъ фыва ждл прой " * 30, True), (2, "zqxj wvkk qqzx jjxq " * 30, True),
            (3, "the thing that was of the and in it " * 10, False)]
    got = language_id.classify(spark.createDataFrame(rows, "id int, text string, far boolean"), model)
    assert all(r.rejected == r.far for r in got.collect())


def test_nothing_to_learn_from(edge_docs, no_docs):
    rows = language_id.identified(edge_docs, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert language_id.identified(no_docs, F.lit(True)).count() == 0


def test_filter_keeps_columns_and_ids_do_not_matter(edge_docs):
    kept = language_id.keep_identified(edge_docs, ~held_out("doc_id", 0))
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 5, 10}


FINNISH = ("Suomi on tasavalta Pohjois-Euroopassa, ja sen pääkaupunki on Helsinki. Maan väestö on noin viisi ja "
           "puoli miljoonaa ihmistä, ja suurin osa heistä asuu etelässä. Talvet ovat kylmiä ja pimeitä. ")
DUTCH = ("Nederland is een land in het noordwesten van Europa dat voor een groot deel onder de zeespiegel ligt. De "
         "hoofdstad is Amsterdam, maar de regering zit in Den Haag. Veel mensen gaan elke dag met de fiets. ")
ITALIAN = ("La Repubblica italiana si trova nel sud dell'Europa e la sua capitale è Roma. Il paese è famoso per la "
           "cucina, per la musica e per le opere d'arte che si trovano in ogni città. ")


def test_other_languages_random_letters_and_base64_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.fit(docs, ~held_out("doc_id", 0))
    r = random.Random(1)
    words = " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 9))) for _ in range(300))
    noise = base64.b64encode(r.randbytes(2000)).decode()
    rows = [(t,) for t in (FINNISH * 2, DUTCH * 2, ITALIAN * 2, words, noise)]
    assert all(x.rejected for x in language_id.classify(spark.createDataFrame(rows, "text string"), found).collect())
    kept = language_id.classify(docs.where(held_out("doc_id", 0) & F.col("text").rlike("[a-z]")), found)
    assert kept.where("rejected").count() <= 0.02 * kept.count()


def vector(text, idf):
    return language_id.tf_idf(next(trigram_counts(pa.array([text.lower()]), len(idf)))[2], idf)[0]


def test_similarities_and_predictions_one_by_one(spark, model):
    """Limits are counted from every learning text, each left out of its centroid."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(
        "lang is not null and text is not null").collect()
    learning = language_id._learning(spark.createDataFrame(rows), F.lit(True), "text", "lang")
    dims, langs = len(model.idf), np.array(model.languages)
    vectors = np.stack([vector(r.text, model.idf) for r in rows])
    # Any unit vectors serve as seeds.
    seeds = np.stack([vectors[[r.lang for r in rows].index(x)] for x in sorted(set(langs))])
    names = sorted(set(langs))
    owner = np.array([names.index(r.lang) for r in rows])
    sums = language_id._refined(learning, names, seeds, model.idf, dims)
    direct = np.stack([vectors[owner == i].sum(axis=0) for i in range(len(names))])
    assert np.allclose(sums, direct, atol=1e-3)
    unit = direct / np.linalg.norm(direct, axis=1, keepdims=True)
    got = language_id._similarities(learning, names, seeds, sums, unit.astype(np.float32), model.idf, dims)
    want = np.zeros_like(got)
    for r, v, o in zip(rows, vectors, owner, strict=True):
        def add(kind, text, cosine):
            n = next(trigram_counts(pa.array([text.lower()]), dims))[2].sum()
            want[kind, min(int(np.log2(max(n, 1))), 15), min(int(max(cosine, 0) * language_id.BINS), language_id.BINS - 1)] += 1
        rest = direct[o] - v
        add(0, r.text, v @ rest / np.linalg.norm(rest))
        add(1, r.text, max(v @ unit[i] for i in range(len(names)) if i != o))
        mixed = language_id.shuffled(r.text.lower())
        assert sorted(mixed) == sorted(r.text.lower())
        add(2, mixed, (unit @ vector(mixed, model.idf)).max())
    # Rounding may move a cosine by one step.
    assert (got.sum(axis=2) == want.sum(axis=2)).all()
    assert np.abs(np.cumsum(got, axis=2) - np.cumsum(want, axis=2)).max() <= 2
    # The prediction is the nearest centroid.
    for r in language_id.classify(spark.createDataFrame(rows).select("text"), model).collect():
        cosine = model.centroids @ vector(r.text, model.idf)
        assert r.lang_pred == langs[cosine.argmax()] and abs(r.score - cosine.max()) < 1e-4


def test_limits():
    counts = np.zeros((3, language_id.LENGTHS, language_id.BINS), np.int64)
    counts[0, 5, 400], counts[1, 5, 100], counts[2, 5, 200] = 50, 50, 50
    counts[0, 7, 150], counts[1, 7, 300] = 50, 50  # others are nearer: the language's own least
    counts[0, 9, 500] = language_id.ENOUGH - 1
    steps = language_id.limits(counts) * language_id.BINS
    assert steps.tolist() == [0] * 5 + [300] * 2 + [150] * 9


def test_sample_takes_distinct_texts(spark):
    rows = [("en", "the same text")] * 500 + [("en", f"text {i}") for i in range(30)] + [("fr", "un texte")] * 400
    learning = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    sample = language_id._sample(learning, 20).collect()
    assert sum(r.lang == "en" for r in sample) == 20 == len({r.text for r in sample if r.lang == "en"})
    assert [r.text for r in sample if r.lang == "fr"] == ["un texte"]


def test_passes_hold_a_few_texts_at_a_time():
    """What a pass holds does not grow with the rows of a batch."""
    dims, names = language_id.DIMS, ["de", "en"]
    seeds = np.eye(2, dims, dtype=np.float32)
    text = " ".join(f"word{i}" for i in range(2000))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 900), pa.array([text] * 900)], names=["lang", "text"])

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            tracemalloc.start()
            self.found = list(run(iter([batch])))
            self.peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            raise StopIteration

    rows = Rows()
    with pytest.raises(StopIteration):
        language_id._similarities(rows, names, seeds, seeds * 9, seeds, np.ones(dims, np.float32), dims)
    found = rows.found[0].to_pydict()
    assert [sum(n for k, n in zip(found["kind"], found["n"]) if k == kind) for kind in range(3)] == [900] * 3
    assert rows.peak < 24e6


def test_identified_does_not_bring_texts_back_from_python(edge_docs, model, monkeypatch):
    schemas = []
    plain = type(edge_docs).mapInArrow
    monkeypatch.setattr(type(edge_docs), "mapInArrow", lambda self, run, schema, *a: (
        schemas.append(schema), plain(self, run, schema, *a))[1])
    monkeypatch.setattr(language_id, "fit", lambda *_, **__: model)
    got = language_id.identified(edge_docs, F.lit(True))
    assert [s.fieldNames() for s in schemas] == [["doc_id", "lang_pred", "score", "rejected"]]
    want = language_id.classify(edge_docs.select("doc_id", "text"), model).drop("text")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
