"""Near-duplicate groups by MinHash with tensored banding.

Each document's set is its distinct shingles.  Instead of one band of minhashes
for every table, a small collection of half-bands is computed, and each table's
key combines a pair of them: ``halves`` half-bands give halves * (halves - 1) / 2
tables, so the number of minhashes is about the square root of what separate
bands would take.  Two sets with similarity s miss each other only if fewer than
two of their half-bands agree; with 14 half-bands of two values that is about
1 in 5,600 at the threshold of 0.75, and far rarer above it.

A key is formed only of half-bands that another document shares too, which leaves
out most documents without a near duplicate before any key is written.

Candidates are verified on whole sets:

* documents with one and the same set are one node;
* in every table, each node is compared with the smallest node of its key;
  nodes linked so far form components;
* keys whose nodes are still in different components are finished by comparing
  the nodes of different components with each other.  Two nodes of one component
  need no comparison, so a large group of copies costs one comparison a node.
  Of the pairs left, those are dropped whose sizes or parity sketches rule the
  similarity out: a sketch holds the parity of the number of shingles in each of
  ``SKETCH_BITS`` cells, so two sketches differ in at most as many cells as the
  sets differ in shingles.  Texts that share one passage seldom pass.  A pair
  that shares several keys is met in the first of them only.

No step keeps a cap on partners.  All groupings are joins and partial
aggregates, so a key that holds a large share of the rows is split.

Defined results: null and empty texts have an empty set and are linked with
nothing; a null id comes after every other id, ``component_id`` is null only if
all ids of the component are; repeated rows are linked; an empty table gives no
row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_table, text_blocks

SHINGLE_WORDS = 5
HALVES = 14
HALF_WIDTH = 2
#: Similarity as a fraction: 75 / 100.
THRESHOLD = (75, 100)
SKETCH_BITS = 1024

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit value for each byte.
_BYTE = _mix((np.arange(1, 257, dtype=np.uint64)) * _ODD)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done = min(1, n)
    while done < n:
        take = min(done, n - done)
        step = np.uint64(pow(int(base), done, 1 << 64))
        out[done:done + take] = out[:take] * step
        done += take
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and each row's first word (one more at the end)."""
    inside = ~_SPACE[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        before[edges] = False
        after[edges[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    # Words as differences of one running polynomial, moved to position 0.
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * _powers(_ODD, len(data)), out=sums[1:])
    words = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return _mix(words + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and the
    rows' bounds in them.  A row with fewer words has one shingle of all."""
    with np.errstate(over="ignore"):
        words, first = word_hashes(data, offsets)
        factors = _powers(_ODD * np.uint64(3) | np.uint64(1), size + 1)[1:]
        n = max(0, len(words) - size + 1)
        sums = np.zeros(n, np.uint64)
        for i in range(size):
            sums += words[i:i + n] * factors[i]
        sums = _mix(sums)
        sets = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= size:
                some = np.sort(sums[a:b - size + 1])
                sets.append(some[np.concatenate(([True], some[1:] != some[:-1]))])
            elif b > a:
                sets.append(_mix((words[a:b] * factors[:b - a]).sum(dtype=np.uint64, keepdims=True)
                                 + np.uint64(b - a)))
            else:
                sets.append(sums[:0])
    bounds = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return (np.concatenate(sets) if sets else sums[:0]), bounds


def set_keys(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name each set; 0 for an empty one."""
    with np.errstate(over="ignore"):
        out = []
        for salt in (1, 2):
            total = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(_mix(hashes + np.uint64(salt) * _ODD), out=total[1:])
            out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def half_bands(hashes: np.ndarray, bounds: np.ndarray, halves: int, width: int) -> np.ndarray:
    """(rows with a set, halves): each half-band combines ``width`` minhashes."""
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    out = np.zeros((len(full), halves), np.uint64)
    if not len(full):
        return out.view(np.int64)
    at = bounds[full]
    seeds = _mix(np.arange(1, 2 * halves * width + 1, dtype=np.uint64) * _ODD)
    with np.errstate(over="ignore"):
        for h in range(halves):
            for w in range(width):
                i = 2 * (h * width + w)
                least = np.minimum.reduceat((hashes ^ seeds[i]) * (seeds[i + 1] | np.uint64(1)), at)
                out[:, h] = _mix(out[:, h] * _ODD + least)
    return out.view(np.int64)


def parity_sketches(hashes: np.ndarray, bounds: np.ndarray, rows: int = 256) -> np.ndarray:
    """(rows, SKETCH_BITS / 64): parity of the number of shingles in each cell."""
    out = np.zeros((len(bounds) - 1, SKETCH_BITS // 64), np.int64)
    cell = (hashes >> np.uint64(64 - (SKETCH_BITS.bit_length() - 1))).astype(np.int64)
    for at in range(0, len(out), rows):
        some = bounds[at:at + rows + 1]
        row = np.repeat(np.arange(len(some) - 1), np.diff(some))
        counts = np.bincount(row * SKETCH_BITS + cell[some[0]:some[-1]],
                             minlength=(len(some) - 1) * SKETCH_BITS)
        bits = np.packbits((counts & 1).astype(np.uint8).reshape(-1, SKETCH_BITS), axis=1)
        out[at:at + rows] = bits.view(np.int64)
    return out


_SIGNATURE = ("doc_id bigint, text_key bigint, n bigint, hi bigint, lo bigint, "
              "halves array<bigint>, sketch array<bigint>")


def signatures(docs: DataFrame, halves: int = HALVES, width: int = HALF_WIDTH,
               shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: size and name of its set, and its half-bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(2)):
                hashes, bounds = shingle_sets(data, offsets, shingle_words)
                hi, lo = set_keys(hashes, bounds)
                n = np.diff(bounds)
                bands = half_bands(hashes, bounds, halves, width)
                cells = parity_sketches(hashes, bounds)
                ends = np.concatenate(([0], np.cumsum(np.where(n > 0, halves, 0))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array(n), pa.array(hi), pa.array(lo),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                              pa.array(bands.ravel())),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(len(n) + 1) * cells.shape[1], pa.int32()),
                         pa.array(cells.ravel()))],
                    names=["doc_id", "text_key", "n", "hi", "lo", "halves", "sketch"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"),
                       text.alias("text")).mapInArrow(run, _SIGNATURE)


def whole_sets(texts: DataFrame, shingle_words: int) -> DataFrame:
    """Rows (hi, lo, shingles) of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0), 1 << 18):
                hashes, bounds = shingle_sets(data, offsets, shingle_words)
                hi, lo = set_keys(hashes, bounds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hi), pa.array(lo), pa.ListArray.from_arrays(
                        pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))],
                    names=["hi", "lo", "shingles"])

    return texts.select("text").mapInArrow(run, "hi bigint, lo bigint, shingles array<bigint>")


def _alike(a: str, b: str, threshold: tuple[int, int]):
    """The sizes alone allow the similarity."""
    part, whole = threshold
    return F.least(a, b) * whole >= F.greatest(a, b) * part


def _near_sketches(sketch_a: str, sketch_b: str, a: str, b: str, threshold: tuple[int, int]):
    """The parity sketches allow the similarity: at similarity s, sets differ in
    at most (1 - s) / (1 + s) of their sizes' sum."""
    part, whole = threshold
    cells = sum((F.bit_count(F.col(sketch_a)[i].bitwiseXOR(F.col(sketch_b)[i]))
                 for i in range(SKETCH_BITS // 64)), F.lit(0))
    return cells * (whole + part) <= (F.col(a) + F.col(b)) * (whole - part)


def _first_key(a: str, b: str, tables: list[tuple[int, int]]):
    """The key of the first table in which two nodes agree.  There the pair is
    met, or one of them is the key's smallest node and was compared already."""
    return F.coalesce(*[
        F.when((F.col(a)[i] == F.col(b)[i]) & (F.col(a)[j] == F.col(b)[j]),
               F.xxhash64(F.lit(t), F.col(a)[i], F.col(a)[j]))
        for t, (i, j) in enumerate(tables)])


def connected(edges: DataFrame) -> DataFrame:
    """Components of the edges (a, b): (node, component), the smallest node.

    Large-star and small-star steps alternate on written tables until the
    edges are stars; each is one minimum per node and one join.
    """
    edges = scratch_table(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # Large star: neighbours above a node point to its smallest neighbour.
        large = (both.join(least, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        large = scratch_table(large, "large-star")
        # Small star: a node and its neighbours below point to the smallest one.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = scratch_table(
            small.select("a", F.col("m").alias("b"))
            .unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct(), "small-star")
        # Stars: no node both has a smaller one and is one.
        done = not small.select("a").join(small.select(F.col("b").alias("a")), "a",
                                          "left_semi").limit(1).count() \
            and not small.groupBy("a").agg(F.min("b").alias("x"), F.max("b").alias("y")).where(
                "x <> y").limit(1).count()
        edges = small
        if done:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _linked(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    part, whole = threshold
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    return (both.select("a", "b", common.alias("common"),
                        (F.size("sa") + F.size("sb")).alias("sizes"))
            .where(F.col("common") * whole >= (F.col("sizes") - F.col("common")) * part)
            .select("a", "b"))


def _shared_halves(nodes: DataFrame) -> DataFrame:
    """(node, shared): bit i is set if another node has the same half-band i.  Two
    nodes share a key only if they share both of its halves, so only keys of
    shared halves are formed; most nodes have none."""
    each = nodes.select("node", F.posexplode("halves").alias("i", "value"))
    each = each.select("node", "i", F.xxhash64("i", "value").alias("half"))
    shared = each.groupBy("half").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("half")
    return each.join(shared, "half", "left_semi").groupBy("node").agg(
        F.expr("bit_or(shiftleft(1, i))").alias("shared")).where(
        F.bit_count("shared") > 1)


def near_duplicates(docs: DataFrame, threshold: tuple[int, int] = THRESHOLD,
                    halves: int = HALVES, width: int = HALF_WIDTH,
                    shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key (hash of the text), n_shingles,
    component_id (smallest doc_id reachable over links), kept, and node (null
    without shingles), which is the same for all documents of one component."""
    sig = scratch_table(
        signatures(docs, halves, width, shingle_words, id_col, text_col), "signatures")
    # One node for each distinct set.
    nodes = scratch_table(
        sig.where("n > 0").groupBy("hi", "lo", "n").agg(
            F.first("halves").alias("halves"), F.first("sketch").alias("sketch"),
            F.min("doc_id").alias("doc_id"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    tables = list(combinations(range(halves), 2))
    mask = _shared_halves(nodes)
    keys = F.explode(F.filter(F.array(*[
        F.when(F.col("shared").bitwiseAND((1 << i) | (1 << j)) == (1 << i) | (1 << j),
               F.xxhash64(F.lit(t), F.col("halves")[i], F.col("halves")[j]))
        for t, (i, j) in enumerate(tables)]), lambda key: key.isNotNull()))
    keyed = scratch_table(nodes.select("node", "n", "halves").join(mask, "node").select(
        keys.alias("key"), "node", "n"), "keys")
    first = keyed.groupBy("key").agg(
        F.min("node").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1")
    members = scratch_table(
        keyed.join(first, "key").where("node <> pivot"), "members")
    sizes = nodes.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n"))
    star = scratch_table(
        members.select("pivot", "node", "n").distinct().join(sizes, "pivot")
        .where(_alike("n", "pivot_n", threshold))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b")), "star-pairs")

    # Whole sets of the nodes that share a key, by the text of one document each.
    shared = members.select("node").unionByName(members.select(F.col("pivot").alias("node")))
    wanted = nodes.join(shared.distinct(), "node", "left_semi").select("node", "hi", "lo",
                                                                      "doc_id")
    ids = wanted.select(F.col("doc_id").alias("w_id")).distinct()
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text")).join(
        ids, F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi")
    sets = scratch_table(
        whole_sets(texts, shingle_words).join(wanted.select("node", "hi", "lo"), ["hi", "lo"])
        .dropDuplicates(["node"]).select("node", "shingles"), "sets")

    links = scratch_table(_linked(star, sets, threshold), "star-links")
    parts = connected(links)

    # Keys whose nodes are in different components: compare across components.
    placed = members.where("members > 2").select("key", "node", "n").join(
        parts, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("c"))
    open_keys = placed.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where(
        "x <> y").select("key")
    placed = scratch_table(
        placed.join(open_keys, "key", "left_semi").join(
            nodes.select("node", "sketch", "halves"), "node"), "open-keys")
    left, right = (placed.select("key", F.col("node").alias(x), F.col("n").alias(f"n{x}"),
                                 F.col("c").alias(f"c{x}"), F.col("sketch").alias(f"s{x}"),
                                 F.col("halves").alias(f"h{x}"))
                   for x in ("a", "b"))
    cross = (left.join(right, "key").where("a < b and ca <> cb")
             .where(_alike("na", "nb", threshold))
             .where(_near_sketches("sa", "sb", "na", "nb", threshold))
             .where(F.col("key") == _first_key("ha", "hb", tables))
             .select("a", "b").distinct().join(star, ["a", "b"], "left_anti"))
    more = scratch_table(_linked(scratch_table(cross, "cross-pairs"), sets, threshold), "links")
    # Later links join components found so far; only those go another round.
    named = parts.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    joined = (more.join(named, "a", "left").join(
        named.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    merged = connected(joined).select(F.col("node").alias("component"),
                                      F.col("component").alias("merged"))
    final = (nodes.select("node", "hi", "lo", "n").join(parts, "node", "left")
             .withColumn("component", F.coalesce("component", "node"))
             .join(merged, "component", "left")
             .select("hi", "lo", "n", F.coalesce("merged", "component").alias("node")))
    rows = sig.select("doc_id", "text_key", "n", "hi", "lo").join(final, ["hi", "lo", "n"], "left")
    rows = scratch_table(rows, "rows")
    smallest = rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("smallest"))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return (rows.join(smallest, "node", "left")
            .select("doc_id", "text_key", F.col("n").alias("n_shingles"),
                    component.alias("component_id"), "node")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             **parameters) -> DataFrame:
    """The documents that stay, with all their columns: one of each group (the
    one with the smallest id), and each document without shingles."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **parameters)
    best = found.where("kept and node is not null").groupBy("node").agg(
        F.min(F.struct("text_key")).alias("best"), F.first("doc_id").alias("doc_id"))
    stay = best.select(F.col("doc_id").alias("_keep_id"), F.col("best.text_key").alias("_keep_key"),
                       F.lit(True).alias("_one")).unionByName(
        found.where("node is null").select(F.col("doc_id").alias("_keep_id"),
                                           F.col("text_key").alias("_keep_key"),
                                           F.lit(False).alias("_one")).distinct())
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    keyed = whole.select("_row", F.col("_row")[id_col].cast("bigint").alias("_id"), F.xxhash64(
        F.coalesce(F.col("_row")[text_col].cast("string"), F.lit(""))).alias("_key"))
    joined = keyed.join(stay, (F.col("_key") == F.col("_keep_key"))
                        & F.col("_id").eqNullSafe(F.col("_keep_id")))
    single = joined.where("_one").dropDuplicates(["_id", "_key"])
    return single.unionByName(joined.where(~F.col("_one"))).select("_row.*")
