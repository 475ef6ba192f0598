import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataform.llm import kdtree_search

SCHEMA = "vec_id bigint, embedding array<float>, score int, rank int, shard int, tree string"


def plain(rows, k, step):
    good = [(i, [math.floor(float(np.float32(x)) * 256) for x in v]) for i, v in rows
            if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({i: min(w for j, w in good if j == i) for i, _ in good}.items()):
        if q % step:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block_queries", [(64, 5), (4096, 1024)])
def test_results_match_all_products(spark, shard_rows, block_queries):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(500)]
    rows += [(i, [0.5] * 6) for i in range(500, 560)]  # ties
    rows += [(1, [0.5] * 6), (50, [0.1] * 6)]  # repeated ids
    rows += [(600, None), (650, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (700, [math.nan] * 6),
             (750, [math.inf] + [0.0] * 5), (None, [1.0] * 6)]
    docs = spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)
    got = kdtree_search.top_k(docs, F.col("vec_id") % 50 == 0, shard_rows=shard_rows,
                              block_queries=block_queries).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain(rows, 5, 50)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, [])]
    docs = spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)
    got = kdtree_search.top_k(docs, F.col("vec_id") == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (0, 1, 1, 65536), (0, 2, 2, 0)]
    assert kdtree_search.top_k(docs.where("false"), F.col("vec_id") == 0).count() == 0


def test_boxes_bound_their_points():
    points = np.random.default_rng(1).integers(-50, 50, (700, 4))
    order, first, last, left, right, low, high = kdtree_search.build_tree(points, leaf=8)
    assert sorted(order.tolist()) == list(range(700))
    for a, b, lo, hi in zip(first, last, low, high):
        rows = points[order[a:b]]
        assert (rows.min(axis=0) == lo).all() and (rows.max(axis=0) == hi).all()
    assert all(last[n] - first[n] <= 8 for n in range(len(first)) if left[n] < 0)
