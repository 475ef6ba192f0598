"""Change sets: what differs between two extracts of one table.

``snapshot_changes`` compares two snapshots row by row; ``apply_snapshot`` brings a
type 2 dimension to the state of a snapshot, through the batch that the comparison
gives.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import assign_keys, next_key_start
from .scd import scd2_apply


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]
                     ) -> DataFrame:
    """One row for each key that one of the snapshots lacks or whose ``columns``
    differ: the key, ``change`` (``insert``, ``update``, ``delete``), the columns (of
    ``after``; of ``before`` for a deleted key) and ``changed``, the names of the
    columns that differ (of an update; else empty).

    Nulls are values: null and null are equal.  Keys equal in all columns give no
    row.  A null key, or a key that stands twice in a snapshot, fails the job when
    the result is read.  Both snapshots are shuffled once, together, by their key; a
    repeated key is counted before it is shuffled.  Other columns are not read.
    """
    columns = list(columns)
    values = F.struct(*columns)
    sides = before.select(key, F.lit(0).alias("_side"), values.alias("_row")).unionByName(
        after.select(key, F.lit(1).alias("_side"), values.alias("_row")))

    def of(side: int, value: Column) -> Column:
        return F.when(F.col("_side") == side, value)

    met = sides.groupBy(key).agg(
        F.count(of(0, F.lit(1))).alias("_n0"), F.count(of(1, F.lit(1))).alias("_n1"),
        F.max(of(0, F.col("_row"))).alias("_before"), F.max(of(1, F.col("_row"))).alias("_after"))
    bad = F.col(key).isNull() | (F.col("_n0") > 1) | (F.col("_n1") > 1)
    reason = F.concat(F.lit(f"{key} is null or stands twice in a snapshot: "),
                      F.coalesce(F.col(key).cast("string"), F.lit("null")))
    change = (F.when(bad, F.raise_error(reason).cast("string"))
              .when(F.col("_n0") == 0, "insert").when(F.col("_n1") == 0, "delete")
              .when(~F.col("_before").eqNullSafe(F.col("_after")), "update"))
    differing = F.array(*[F.when(~F.col(f"_before.{c}").eqNullSafe(F.col(f"_after.{c}")), F.lit(c))
                          for c in columns])
    changed = F.when(F.col("change") == "update", F.array_compact(differing)).otherwise(
        F.array().cast("array<string>"))
    present = F.when(F.col("change") == "delete", F.col("_before")).otherwise(F.col("_after"))
    return (met.withColumn("change", change).where(F.col("change").isNotNull())
            .select(key, "change", present.alias("_now"), changed.alias("changed"))
            .select(key, "change", *[F.col(f"_now.{c}").alias(c) for c in columns], "changed"))


def update_batch(changes: DataFrame, key: str, tracked: Sequence[str], on: dt.date) -> DataFrame:
    """The batch for ``scd2_apply``: updates that touch a tracked column, all on the
    day ``on``."""
    touches = F.arrays_overlap("changed", F.array(*[F.lit(t) for t in tracked]))
    return changes.where((F.col("change") == "update") & touches).select(
        key, F.lit(on).alias("change_date"), *tracked)


def apply_snapshot(dim: DataFrame, snapshot: DataFrame, on: dt.date, *,
                   natural_key: str = "customer_id", surrogate_key: str = "customer_key",
                   tracked: Sequence[str] = ("city",), starts: str | None = "signup_date",
                   close_deleted: bool = True) -> DataFrame:
    """The type 2 dimension ``dim`` brought to the state of ``snapshot`` (one row per
    natural key with all attributes) on the day ``on``; returns the whole dimension.

    * Keys whose tracked columns differ from their current version get a version
      from ``on`` (``scd2_apply``); a difference in other columns alone gives none.
    * Keys without a current version are inserted, current, valid from their column
      ``starts`` (from ``on`` if that is None), so a closed key comes back.
    * Current versions of keys that the snapshot lacks are closed the day before
      ``on``, or kept if not ``close_deleted``.

    New surrogate keys go on from the largest: first the inserted keys, then the
    versions of updated ones, each in the order of the natural key.
    """
    nk, sk = natural_key, surrogate_key
    history = [sk, nk, "valid_from", "valid_to", "is_current"]
    attributes = [c for c in dim.columns if c not in history]
    current = dim.where(F.col("is_current") == 1)
    changes = snapshot_changes(current, snapshot, nk, attributes)

    start = next_key_start(dim, sk)
    first = changes.where("change = 'insert'").select(
        nk, *attributes, (F.col(starts) if starts else F.lit(on)).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.lit(1).alias("is_current"))
    inserted = assign_keys(first, sk, [nk], start).select(*dim.columns)
    known = max(start, next_key_start(inserted, sk)) - 1
    versions = scd2_apply(dim, update_batch(changes, nk, tracked, on), natural_key=nk,
                          surrogate_key=sk, tracked=tracked, max_key=known)
    if close_deleted:
        gone = changes.where("change = 'delete'").select(nk, F.lit(True).alias("_gone"))
        closing = F.col("_gone").isNotNull() & (F.col("is_current") == 1)
        versions = versions.join(gone, nk, "left").select(*[
            F.when(closing, F.date_sub(F.lit(on), 1)).otherwise(F.col(c)).alias(c)
            if c == "valid_to" else
            F.when(closing, F.lit(0)).otherwise(F.col(c)).alias(c) if c == "is_current" else F.col(c)
            for c in dim.columns])
    return versions.unionByName(inserted)
