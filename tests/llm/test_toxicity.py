import numpy as np
import pytest
from pyspark.sql import functions as F

from strataform.llm import toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{SF}/documents.parquet"),
            spark.read.parquet(f"{SF}/labels.parquet"))


@pytest.fixture(scope="module")
def chain(tables):
    return toxicity.toxicity_chain(*tables, learn=F.col("id") % 5 != 0)


def test_held_out_rows(tables, chain):
    docs, labels = tables
    some = docs.where("doc_id % 5 = 0").join(labels.where("toxic is not null"), "doc_id")
    rows = toxicity.score(some.select("doc_id", "text", "toxic"), chain).collect()
    toxic = [r.p_toxic >= 0.5 for r in rows if r.toxic]
    clean = [r.p_toxic >= 0.5 for r in rows if not r.toxic]
    assert len(toxic) > 30 and np.mean(toxic) >= 0.9
    assert np.mean(clean) <= 0.01


def test_later_models_see_earlier_probabilities(chain):
    assert [len(w) for w in chain.weights] == [len(chain.features) + 1 + i for i in range(3)]
    x = chain.matrix([chain.row("you idiot, stupid moron"), chain.row("the thing")])
    p = chain.predict(x)
    assert p[0, 0] > p[1, 0]
    one = np.hstack([x, p[:, :2]])
    np.testing.assert_allclose(p[:, 2], 1 / (1 + np.exp(-(one @ chain.weights[2][:-1]
                                                         + chain.weights[2][-1]))))


def test_edge_rows(edge_docs, no_docs, chain):
    rows = toxicity.score(edge_docs.select("doc_id", "text"), chain).collect()
    assert len(rows) == edge_docs.count()
    assert all(r.p_toxic == 0 for r in rows if not any(map(str.isalpha, r.text or "")))
    assert toxicity.score(no_docs, chain).count() == 0
    kept = toxicity.keep_clean(edge_docs, chain)
    assert kept.columns == edge_docs.columns
    assert {r.doc_id for r in rows if r.p_toxic < 0.5} == {r.doc_id for r in kept.collect()}


def test_labels_of_one_kind_or_none(spark, edge_docs):
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, None), (None, 1), (99, 1)],
                                   "doc_id bigint, toxic int")
    for some in (labels, labels.where("false")):
        model = toxicity.toxicity_chain(edge_docs, some)
        assert all(r.p_toxic < 0.01 for r in toxicity.score(
            edge_docs.select("doc_id", "text"), model).collect())


def test_logistic_weights_separate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    w = toxicity.fit_logistic(x, y)
    assert ((x @ w[:-1] + w[-1] > 0) == (y > 0)).mean() > 0.97
