from collections import Counter

import __spark_entry__
import corpus_pipeline
import public_tokenizers
import pytest
from tests.llm.test_exact_dedup import plain as plain_exact
from tests.llm.test_minhash_dedup import plain as plain_near

from strataform.llm import oracle, queries, subwords
from strataform.session import scratch_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and gives, at sf0.001."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        done = scratch_table(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, done)
        docs = done
    return out


def rows(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_filters_keep_rows_whole(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns
            assert not Counter(map(tuple, after.collect())) - Counter(map(tuple, before.collect()))


def test_clean_documents_stay(stages, spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = stages["language"]
    assert after.count() >= before.count() - 1
    before, after = stages["toxicity"]
    gone = {i for i, _ in rows(before)} - {i for i, _ in rows(after)}
    assert gone and not any(labels.get(i) == 0 for i in gone)


def test_duplicates_match_the_plain_versions(stages):
    before, after = stages["exact_dedup"]
    assert sorted(i for i, _ in rows(after)) == sorted(
        i for i, _, _, kept, _ in plain_exact(rows(before)) if kept)
    before, after = stages["near_dedup"]
    assert sorted(i for i, _ in rows(after)) == sorted(
        i for i, _, _, kept in plain_near(rows(before)) if kept)


def test_all_of_the_rest_is_packed(stages):
    before, after = stages["packing"]
    encoder = subwords.word_bpe(public_tokenizers.path(queries.WORDS))
    texts = rows(before)
    want = {i: len(x) // encoder.dtype.itemsize + 1 for (i, _), x in
            zip(texts, encoder.encode_batch([t or "" for _, t in texts]))}
    got = Counter()
    for r in after.collect():
        got[r.doc_id] += r.length
    assert got == want


def test_stages_take_edge_rows_and_no_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        frame = scratch_table(docs, "test-edges")
        for name, stage in corpus_pipeline.STAGES:
            frame = scratch_table(stage(spark, frame, SF), f"test-edge-{name}")
            assert name == "packing" or frame.columns == docs.columns


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.queries()) | {"pipeline"} <= names
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.queries()}
    assert set(oracle.oracle_sql()) <= set(__spark_entry__.oracle_sql())
