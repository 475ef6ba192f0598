import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataform.llm import quality_embeddings as qe
from strataform.llm.common import held_out, read_table
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def tables(spark):
    folder = SF.replace("0.001", "0.01")
    return read_table(spark, folder, "documents"), read_table(spark, folder, "labels")


def plain_features(text):
    """Counts of table rows, word by word."""
    counts, words = {}, text.encode().split()
    codes = [zlib.crc32(w) for w in words]
    for w, code in zip(words, codes, strict=True):
        rows = [code % qe.BUCKETS]
        marked = [ord(c) for c in f"<{w.decode()}>"]
        for n in qe.GRAMS:
            for i in range(len(marked) - n + 1):
                h = n
                for c in marked[i:i + n]:
                    h = (h + c + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
                    h ^= h >> 29
                rows.append((h >> 17) % qe.BUCKETS + qe.BUCKETS)
        for r in rows:
            counts[r] = counts.get(r, 0) + 1
    for a, b in zip(codes, codes[1:]):
        h = (a * 0x9E3779B97F4A7C15 + b) * 0x9E3779B97F4A7C15 % (1 << 64)
        r = qe.TABLE - 1 if a == b else (h >> 17) % qe.BUCKETS + 2 * qe.BUCKETS
        counts[r] = counts.get(r, 0) + 1
    return counts


@pytest.mark.parametrize("text", ["", " ", "a", "The end, the end the the", "日本語 🙂 é x\x00y"])
def test_features_and_scores_match_plain_ones(text):
    rows, counts = qe.text_features(text)
    want = plain_features(text)
    assert dict(zip(rows.tolist(), counts.tolist(), strict=True)) == want
    model = qe.Model.fresh()
    rng = np.random.default_rng(1)
    model.layer[:] = rng.normal(size=model.layer.shape) * 5
    model.offset[:] = [0.2, 0.5]
    average = sum((model.table[r].astype(float) * n for r, n in want.items()), np.zeros(qe.WIDTH))
    z = average / max(1, sum(want.values())) @ model.layer + model.offset
    p = np.exp(z) / np.exp(z).sum()
    assert qe.Scorer(*model.differences()).scores([text])[0] == pytest.approx(p[1], abs=1e-6)


def test_words_forgotten_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(map(str, rng.integers(0, 900, 40))) for _ in range(60)]
    lean = rng.normal(size=qe.TABLE)
    want = qe.Scorer(lean, 0.1).scores(texts)
    monkeypatch.setattr(qe, "KNOWN_WORDS", 100)
    scorer = qe.Scorer(lean, 0.1)
    got = np.concatenate([scorer.scores(texts[i:i + 7]) for i in range(0, 60, 7)])
    np.testing.assert_allclose(got, want, rtol=1e-12)


def test_steps_move_towards_the_label():
    model = qe.Model.fresh()
    good, bad = qe.text_features("a plain good sentence"), qe.text_features("!! $$ !! $$ !!")
    for _ in range(60):
        model.step(*good, 1, 0.3)
        model.step(*bad, 0, 0.3)
    s = qe.Scorer(*model.differences()).scores(["a plain good sentence", "!! $$ !! $$ !!"])
    assert s[0] > 0.9 and s[1] < 0.1
    again = qe.Model.unpacked(np.frombuffer(model.packed(), np.float32))
    assert (again.table == model.table).all() and (again.offset == model.offset).all()


def test_held_out_labels(tables):
    docs, labels = tables
    model = qe.train(docs, labels, ~held_out("id", 2, folds=4))
    found = qe.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(
        held_out("doc_id", 2, folds=4)).select("score", "quality").toPandas()
    good, bad = found[found.quality == 1].score, found[found.quality == 0].score
    assert (good >= 0.7).mean() >= 0.97
    assert (bad < 0.7).mean() >= 0.8
    # The same rows give the same model.
    again = qe.train(docs.repartition(3), labels.repartition(2), ~held_out("id", 2, folds=4))
    np.testing.assert_allclose(again.table, model.table, atol=1e-5)


def test_sample_is_bounded_and_held_out_labels_are_not_seen(tables):
    docs, labels = tables
    learn = ~held_out("id", 2, folds=4)
    sample = qe._sample(docs, labels, "quality", learn, 50, "doc_id", "text")
    assert sample.count() == 50
    flipped = labels.withColumn("quality", F.when(held_out("doc_id", 2, folds=4), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a, b = (qe.train(docs, x, learn, size=120).differences() for x in (labels, flipped))
    np.testing.assert_allclose(a[0], b[0], atol=1e-6)


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (3, None), (5, 1), (99, 1), (None, 1), (10, 1)],
        "doc_id bigint, quality int")
    model = qe.train(edge_docs, labels, F.lit(True))
    found = qe.score(edge_docs, model, name="likely").collect()
    assert len(found) == edge_docs.count() and all(0 <= r.likely <= 1 for r in found)
    empty = 1 / (1 + np.exp(-model.differences()[1]))
    assert {round(r.likely, 12) for r in found if r.doc_id in (2, 3, 4)} == {round(empty, 12)}
    assert found[0].asDict().keys() == {*edge_docs.columns, "likely"}
    assert qe.score(no_docs, model).count() == 0
    blank = qe.train(edge_docs, labels.where("false"), F.lit(True))
    assert {r.score for r in qe.score(edge_docs.select("text"), blank).collect()} == {0.5}
    assert qe.score(edge_docs.select("text"), qe.train(no_docs, labels, F.lit(True))).count() == 13
