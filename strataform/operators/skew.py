"""Joins of many rows to one row a key where a few keys hold much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_keys(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys that hold more than a ``parts``-th of all rows: fewer than ``parts``
    keys.  Counted map-side; a table bucketed on the key is not shuffled.  Null
    keys are left out, as no join meets them."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).count()
    total = rows.agg(F.count(F.lit(1)).alias("_sk_total"))
    # One row.
    return counts.join(F.broadcast(total), F.col("count") * parts > F.col("_sk_total")).select(key)


def spread_join(rows: DataFrame, ones: DataFrame, key: str, heavy: DataFrame, spread_by: str,
                parts: int) -> DataFrame:
    """``rows`` joined to ``ones`` (one row a key) on ``key``, inner.

    Rows of ``heavy`` keys (fewer than ``parts``, as of ``heavy_keys``) are dealt over
    ``parts`` shares by a hash of ``spread_by`` and meet a copy of their key's row in
    each share; all others join as they are, so a bucketed read stays one.
    """
    hot = F.broadcast(heavy.select(key))  # fewer than ``parts`` keys
    light = rows.join(hot, key, "left_anti").join(ones, key)
    share = F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int")
    copies = ones.join(hot, key, "left_semi").withColumn(
        "_sk_share", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    apart = rows.join(hot, key, "left_semi").withColumn("_sk_share", share).join(
        copies.hint("shuffle_hash"), [key, "_sk_share"]).drop("_sk_share")
    return light.unionByName(apart)
