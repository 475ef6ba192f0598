"""Exact top-k search by inner product over one KD-tree per shard.

Vectors are dealt to shards by a hash; each shard's rows are ordered into a
KD-tree by median splits along the widest side, with tight bounding boxes, and
written as one row.  Queries are handled in blocks.  A query's search of a
shard is best-first: boxes are opened in the order of the largest inner product
that any point of the box could have, and it ends when that bound falls below
the k-th score so far.  Each block first searches one shard; the k-th scores
found there start the search of all the others, so most boxes there are never
opened.

Components become floor(scale * x); scores are their exact integer inner
products.  Shards and blocks have fixed sizes, so a task's memory does not grow
with the table.

Defined results: vectors that are null, or hold a null or a component that is
not finite, take no part, nor do rows with a null id; vectors shorter than the
longest count as ending in zeros; repeated ids are separate rows, and a query
never meets rows of its own id; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table

SHARD_ROWS = 1 << 13
BLOCK_QUERIES = 1 << 10
LEAF_ROWS = 64

RESULT = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """Rows that take part: vec_id and v (array<bigint>)."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & finite)
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"),
                       F.transform(v, lambda x: F.floor(x * scale)).alias("v"))


def build_tree(points: np.ndarray, leaf: int = LEAF_ROWS):
    """KD-tree over integer points: the row order, and per node its rows
    [first, last), its children (-1: leaf) and its bounding box."""
    order = np.arange(len(points))
    first, last, left, right, low, high = [], [], [], [], [], []

    def add(a: int, b: int) -> int:
        rows = points[order[a:b]]
        lo, hi = rows.min(axis=0), rows.max(axis=0)
        first.append(a)
        last.append(b)
        left.append(-1)
        right.append(-1)
        low.append(lo)
        high.append(hi)
        return len(first) - 1

    stack = [add(0, len(points))]
    while stack:
        n = stack.pop()
        a, b = first[n], last[n]
        wide = int(np.argmax(high[n] - low[n]))
        if b - a <= leaf or high[n][wide] == low[n][wide]:
            continue
        mid = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(points[order[a:b], wide], mid)]
        left[n], right[n] = add(a, a + mid), add(a + mid, b)
        stack += [left[n], right[n]]
    return (order, np.asarray(first), np.asarray(last), np.asarray(left), np.asarray(right),
            np.asarray(low), np.asarray(high))


def search_tree(tree, ids: np.ndarray, points: np.ndarray, query: np.ndarray, query_id: int,
                k: int, bound: int | None) -> list[tuple[int, int]]:
    """Best (score, id) of a shard, higher score and then smaller id first;
    ``bound`` is a score that k rows elsewhere are known to reach."""
    order, first, last, left, right, low, high = tree
    # Largest inner product with any point of each node's box.
    most = np.maximum(query * low, query * high).sum(axis=1)
    heap = [(-int(most[0]), 0)]
    best: list[tuple[int, int]] = []  # min-heap of (score, -id)
    floor = bound
    while heap:
        top, n = heapq.heappop(heap)
        if floor is not None and -top < floor:
            break
        if left[n] >= 0:
            for child in (left[n], right[n]):
                if floor is None or most[child] >= floor:
                    heapq.heappush(heap, (-int(most[child]), int(child)))
            continue
        rows = order[first[n]:last[n]]
        scores = points[rows] @ query
        if floor is not None:
            near = scores >= floor
            rows, scores = rows[near], scores[near]
        for s, i in zip(scores.tolist(), ids[rows].tolist(), strict=True):
            if i == query_id:
                continue
            if len(best) < k:
                heapq.heappush(best, (s, -i))
            elif (s, -i) > best[0]:
                heapq.heapreplace(best, (s, -i))
        if len(best) == k and (floor is None or best[0][0] > floor):
            floor = best[0][0]
    return [(s, -i) for s, i in sorted(best, reverse=True)]


def shard_trees(vectors: DataFrame, shards: int, dims: int, leaf: int = LEAF_ROWS) -> DataFrame:
    """One written row per shard: its ids and points in tree order, and the tree."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        points = _matrix(frame["v"], dims)
        tree = build_tree(points, leaf)
        order = tree[0]
        packed = [frame["vec_id"].to_numpy(np.int64)[order], points[order], *tree[1:]]
        return pd.DataFrame({"shard": [int(frame["shard"].iloc[0])], "tree": [_dump(packed)]})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return scratch_table(dealt.groupBy("shard").applyInPandas(build, "shard int, tree binary"),
                         "kd-trees")


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _dump(arrays: list[np.ndarray]) -> bytes:
    sink = pa.BufferOutputStream()
    for a in arrays:
        pa.ipc.write_tensor(pa.Tensor.from_numpy(np.ascontiguousarray(a, np.int64)), sink)
    return sink.getvalue().to_pybytes()


def _load(data: bytes) -> list[np.ndarray]:
    source = pa.BufferReader(data)
    return [pa.ipc.read_tensor(source).to_numpy() for _ in range(8)]


def _search_shards(blocks: DataFrame, trees: DataFrame, k: int, dims: int) -> DataFrame:
    """``blocks``: shard, block and the queries (query_id, q, bound) of a block;
    each (shard, block) is one group, so it holds one tree and one block."""

    def run(queries: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        if len(queries) and len(tree):
            ids, points, *nodes = _load(tree["tree"].iloc[0])
            whole = (np.arange(len(ids)), *nodes)
            for q, v, bound in zip(queries["query_id"], _matrix(queries["q"], dims),
                                   queries["bound"], strict=True):
                found += [(q, i, s) for s, i in search_tree(
                    whole, ids, points, v, q, k, None if pd.isna(bound) else int(bound))]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = blocks.select(F.col("shard").alias("t_shard"), F.col("block").alias("t_block")).distinct()
    placed = trees.join(keys, F.col("shard") == F.col("t_shard")).select(
        "t_shard", "t_block", "tree")
    return (blocks.groupBy("shard", "block").cogroup(placed.groupBy("t_shard", "t_block"))
            .applyInPandas(run, RESULT))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Each query's ``k`` best rows of another id: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column vec_id.  Repeated query ids are
    answered once, for the row with the smallest vector.
    """
    rows = scratch_table(integer_vectors(vectors, scale, id_col, vector_col), "vectors")
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    shards, dims = max(1, -(-n // shard_rows)), max(dims or 0, 1)
    trees = shard_trees(rows, shards, dims)
    queries = rows.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(
        F.min("v").alias("q"))
    queries = scratch_table(queries, "queries")
    blocks = max(1, -(-queries.count() // block_queries))
    blocked = queries.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)))
    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")

    # First one shard for each block: its k-th scores bound the other searches.
    start = scratch_table(_search_shards(
        blocked.select(home.alias("shard"), "block", "query_id", "q",
                       F.lit(None).cast("bigint").alias("bound")), trees, k, dims), "first-shard")
    bounds = start.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
    others = blocked.join(bounds, "query_id", "left").select(
        "block", "query_id", "q", "bound",
        F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), home)).alias("shard"))
    rest = _search_shards(others, trees, k, dims)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (start.unionByName(rest).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
