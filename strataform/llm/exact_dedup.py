"""Exact deduplication screened by static binary-fuse filters.

A snapshot is an immutable table of digests, one row for each distinct text,
with one binary-fuse filter for each bucket of it.  A batch of new rows is
grouped by digest for itself; its distinct digests pass the snapshot's filters,
and only those the filter lets through are joined with the exact buckets.
Texts of one digest are then compared byte by byte: the rows that share a
digest are grouped by the normalised text itself.

Buckets hold distinct digests, so a text copied any number of times weighs no
more than one row there; copies are counted before any shuffle.

Defined results: null text equals the empty text; a null id comes after every
other id, and the row that stays has a null ``keep_id`` only if all its copies
have; repeated rows count in ``group_size`` and share ``kept``; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, scratch_table

#: Distinct digests for each filter; bounds what one task builds and holds.
KEYS_PER_BUCKET = 1 << 14


def normalised(text_col: str | Column) -> Column:
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), ASCII_SPACE, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sha (SHA-256 of the normalised text) and check (a second hash)."""
    norm = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"))
    return norm.select("doc_id", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
                       F.xxhash64("norm").alias("check"))


# --- binary-fuse filter -----------------------------------------------------

def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """splitmix64 of key + seed."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64(seed)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _places(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three cells of each hash, in three neighbouring segments."""
    first = (hashes >> np.uint64(32)) % np.uint64(segments - 2)
    mask = np.uint64(segment - 1)
    bits = int(segment).bit_length() - 1
    return np.stack([((first + np.uint64(i)) * np.uint64(segment)
                      + ((hashes >> np.uint64(i * bits % 32)) & mask)).astype(np.int64)
                     for i in range(3)])


def _print_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(29))) & np.uint64(0xFF)).astype(np.uint8)


def build_fuse(keys: np.ndarray) -> tuple[int, int, bytes]:
    """Filter over distinct 64-bit keys: (seed, segment length, one byte a cell).

    Cells are peeled in rounds: every cell with one key left gives that key its
    place; keys are then filled in from the last round to the first.
    """
    keys = np.unique(np.asarray(keys, np.uint64))
    n = len(keys)
    segment = 1 << max(3, int(np.log2(max(n, 2)) / 1.8 + 2.25))
    segments = 3 + int(np.ceil(1.3 * n / segment))
    for seed in range(1, 200):
        if seed % 20 == 0:
            segments += 1 + segments // 4
        hashes = _mixed(keys, seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        cells = _places(hashes, segment, segments)
        size = segment * segments
        count = np.bincount(cells.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # xor of the keys' indexes
        for row in cells:
            np.bitwise_xor.at(owner, row, np.arange(n))
        rounds, left = [], n
        alone = np.flatnonzero(count == 1)
        while len(alone):
            key, pick = np.unique(owner[alone], return_index=True)
            rounds.append((key, alone[pick]))
            left -= len(key)
            for row in cells:
                np.subtract.at(count, row[key], 1)
                np.bitwise_xor.at(owner, row[key], key)
            near = np.unique(cells[:, key])
            alone = near[count[near] == 1]
        if left:
            continue
        table = np.zeros(size, np.uint8)
        want = _print_of(hashes)
        for key, cell in reversed(rounds):
            table[cell] = 0
            table[cell] = want[key] ^ table[cells[0, key]] ^ table[cells[1, key]] \
                ^ table[cells[2, key]]
        return seed, segment, table.tobytes()
    raise RuntimeError(f"no binary-fuse filter found for {n} keys")


def fuse_contains(built: tuple[int, int, bytes], keys: np.ndarray) -> np.ndarray:
    """False only for keys that are not in the filter."""
    seed, segment, data = built
    table = np.frombuffer(data, np.uint8)
    hashes = _mixed(np.asarray(keys, np.uint64), seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    a, b, c = _places(hashes, segment, len(table) // segment)
    return (table[a] ^ table[b] ^ table[c]) == _print_of(hashes)


# --- snapshot and batch -----------------------------------------------------

def grouped(digest_rows: DataFrame) -> DataFrame:
    """One row per distinct digest: sha, key, n (rows)."""
    return digest_rows.groupBy("sha").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "key", F.xxhash64("sha"))


def _in_buckets(digest_groups: DataFrame, buckets: int) -> DataFrame:
    return digest_groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))


def build_snapshot(digest_rows: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET
                   ) -> tuple[DataFrame, DataFrame, int]:
    """Immutable snapshot: its digest groups and its filters, both written, and
    the number of buckets, which follows the number of digests."""
    held = scratch_table(grouped(digest_rows), "snapshot-digests")
    buckets = max(1, -(-held.count() // keys_per_bucket))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        seed, segment, table = build_fuse(frame["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"bucket": [frame["bucket"].iloc[0]], "seed": [seed],
                             "segment": [segment], "cells": [table]})

    filters = _in_buckets(held.select("key"), buckets).groupBy("bucket").applyInPandas(
        build, "bucket bigint, seed int, segment int, cells binary")
    return held, scratch_table(filters, "snapshot-filters"), buckets


def screen(batch_groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The batch's distinct digests that the snapshot may hold."""

    def test(frame: pd.DataFrame, built: pd.DataFrame) -> pd.DataFrame:
        if not len(built) or not len(frame):
            return frame[["sha"]].iloc[:0]
        f = built.iloc[0]
        found = fuse_contains((int(f["seed"]), int(f["segment"]), f["cells"]),
                              frame["key"].to_numpy().view(np.uint64))
        return frame.loc[found, ["sha"]]

    return (_in_buckets(batch_groups.select("sha", "key"), buckets).groupBy("bucket")
            .cogroup(filters.groupBy("bucket")).applyInPandas(test, "sha binary"))


def shared_digests(snapshot_rows: DataFrame, batch_rows: DataFrame) -> DataFrame:
    """Digests with more than one row over snapshot and batch: doubled inside
    the snapshot, doubled inside the batch, or in both."""
    held, filters, buckets = build_snapshot(snapshot_rows)
    batch = scratch_table(grouped(batch_rows), "batch-digests")
    hits = screen(batch, filters, buckets).join(held.select("sha"), "sha", "left_semi")
    return (held.where("n > 1").select("sha").unionByName(batch.where("n > 1").select("sha"))
            .unionByName(hits).distinct())


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 in_snapshot: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``in_snapshot`` tells the rows of the snapshot from the new batch; without
    it the ids are dealt into halves by a hash.  The result does not depend on
    it.
    """
    if in_snapshot is None:
        in_snapshot = F.xxhash64("doc_id") % 2 == 0
    rows = scratch_table(digests(docs, id_col, text_col), "digests")
    inside = F.coalesce(in_snapshot, F.lit(True))
    shared = scratch_table(shared_digests(rows.where(inside), rows.where(~inside)),
                           "shared-digests")
    # Byte check: whole normalised texts of the rows whose digest is shared.
    wanted = (rows.join(shared, "sha", "left_semi").select("doc_id").distinct()
              .select(F.col("doc_id").alias("w_id")))
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
             .join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi")
             .select("doc_id", normalised("text").alias("norm")))
    groups = (texts.groupBy("norm").agg(F.min("doc_id").alias("keep"),
                                        F.count(F.lit(1)).alias("size"))
              .select(F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
                      F.xxhash64("norm").alias("check"), "keep", "size")
              .where("size > 1"))
    return (rows.join(groups, ["sha", "check"], "left")
            .select("doc_id", F.when(F.col("size").isNull(), F.col("doc_id"))
                    .otherwise(F.col("keep")).alias("keep_id"),
                    F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
                    F.lower(F.hex("sha")).alias("text_sha256"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: one row of each group of
    equal texts, of repeated rows any one."""
    groups = exact_groups(docs, id_col, text_col)
    stay = groups.where("kept").select(F.col("doc_id").alias("_keep_id"),
                                       F.unhex("text_sha256").alias("_keep_sha")).distinct()
    norm = normalised(F.col("_row")[text_col]).cast("binary")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).select(
        "_row", F.col("_row")[id_col].alias("_id"), F.unhex(F.sha2(norm, 256)).alias("_sha"))
    joined = keyed.join(stay, (F.col("_sha") == F.col("_keep_sha"))
                        & F.col("_id").eqNullSafe(F.col("_keep_id")), "left_semi")
    return joined.dropDuplicates(["_id", "_sha"]).select("_row.*")
