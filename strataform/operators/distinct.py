"""Exact distinct counts that can be added up: bitmaps.

A set of 64-bit ids is kept as one 64-bit word for each bucket of 64 neighbouring
ids that it touches.  Two sets are merged by OR, bucket by bucket, so counts of
batches, months or halves of a table give the count of the whole, which
``count_distinct`` cannot.  Ids that are close together (orders of a few days)
share words; the least dense set costs one short row an id, so a set never holds
more rows than the table it was made from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BITS = 6  # 2 ** 6 ids a word


def id_bitmaps(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """``keys``, bucket, bitmap: the distinct non-null ids of each group."""
    ids = F.col(id_col).cast("bigint")
    place = ids.bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
    word = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return df.where(F.col(id_col).isNotNull()).groupBy(
        *keys, F.shiftright(ids, _BITS).alias("bucket")).agg(F.bit_or(word).alias("bitmap"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the sets of each group (of any columns of ``bitmaps``)."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bit_or("bitmap").alias("bitmap"))


def count_ids(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``keys`` and how many different ids each group holds."""
    return merge_bitmaps(bitmaps, keys).groupBy(*keys).agg(
        F.sum(F.bit_count("bitmap")).alias(name))
