import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataform.llm import exact_dedup


def plain(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), t in zip(rows, norm):
        groups[t].append(i)
    out = []
    for (i, _), t in zip(rows, norm):
        known = [x for x in groups[t] if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(groups[t]), i == keep,
                    hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)
                   for r in frame.collect()), key=repr)


def test_edge_rows_match_the_plain_version(edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert found(exact_dedup.exact_groups(edge_docs)) == plain(rows)


def test_the_snapshot_does_not_change_the_result(spark):
    rows = [(i, f"text {i % 7}  here") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = plain(rows)
    for inside in (F.lit(True), F.lit(False), F.col("doc_id") < 20):
        assert found(exact_dedup.exact_groups(docs, in_snapshot=inside)) == want


def test_no_rows(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.keep_first(no_docs).columns == no_docs.columns


def test_one_row_of_each_text_stays_with_all_columns(edge_docs):
    kept = exact_dedup.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    want = {(i, s) for i, _, _, k, s in plain(rows) if k}
    got = plain([(r.doc_id, r.text) for r in kept.collect()])
    assert len(got) == len(want) and {(i, s) for i, _, _, _, s in got} == want


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 5000, 40000])
def test_a_filter_knows_all_its_keys_and_few_others(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    built = exact_dedup.build_fuse(keys)
    assert exact_dedup.fuse_contains(built, keys).all()
    others = rng.integers(0, 1 << 63, 20000, dtype=np.uint64)
    assert exact_dedup.fuse_contains(built, others).mean() < 0.02


def test_repeated_keys_do_not_stop_the_filter():
    assert exact_dedup.fuse_contains(exact_dedup.build_fuse(np.full(50, 7, np.uint64)),
                                     np.array([7], np.uint64)).all()
