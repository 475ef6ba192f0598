"""Slowly changing dimensions: type 2 change batches, type 1 upserts, history.

``scd2_apply`` generalises the single-customer change of the operational
script (close the current version the day before the change, open a new one
copied from the latest version with the new value) to a whole batch of
changes, several per key allowed.  Changes of one key are applied in
``(change date, sequence, tracked values)`` order, exactly as if run one after
another (the values decide only between changes of one date and sequence, so
that the result does not depend on the order of the rows):

* every current version of a changed key is closed with
  ``valid_to = first change date - 1 day`` and ``is_current = 0``;
* each change opens a version copied from the key's latest version (greatest
  ``valid_from``, then greatest surrogate key), with the tracked values of the
  change, ``valid_from`` = change date and ``valid_to`` = next change date - 1
  day (NULL and current for the last change);
* changes of unknown keys have no effect; an unchanged value still opens a
  version unless ``skip_unchanged``; a key with only closed versions still
  gets a new one; replaying a change adds another version;
* ``late='reject'`` drops changes dated on or before the key's latest
  ``valid_from`` (the default ``'apply'`` keeps them, as the source does).

The result is one plan: closing and inserting land in the same write, so no
reader can see a key without a current version.  Write it to a new folder,
never onto the folder being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import (assign_keys, lag_within, latest_per_key, neighbor_values,
                       next_key_start, row_number_within, with_position)

_D, _SEQ, _NEXT_D, _FIRST_D = "_sf_change_date", "_sf_change_seq", "_sf_next_date", "_sf_first_date"


def scd2_apply(dim: DataFrame, changes: DataFrame, *, natural_key: str = "customer_id",
               surrogate_key: str = "customer_key", tracked: Sequence[str] = ("city",),
               date_col: str = "change_date", sequence_col: str | None = None,
               skip_unchanged: bool = False, late: str = "apply",
               max_key: int | None = None) -> DataFrame:
    """Apply a batch of type-2 changes; returns the whole new dimension.

    ``max_key`` is the largest surrogate key of ``dim`` when already known
    (observed when the dimension was written); otherwise it is computed.
    """
    if late not in ("apply", "reject"):
        raise ValueError("late must be 'apply' or 'reject'")
    nk, sk, tracked = natural_key, surrogate_key, list(tracked)
    history_cols = [sk, "valid_from", "valid_to", "is_current"]
    carried = [c for c in dim.columns if c not in {nk, *tracked, *history_cols}]

    chg = changes.select(
        nk, F.col(date_col).cast("date").alias(_D), *tracked,
        (F.col(sequence_col) if sequence_col else F.lit(0)).cast("bigint").alias(_SEQ))
    # Unknown keys: no version to close, none to copy from.  Key sets are
    # deduplicated (map-side) before the semi-joins, so a key with many
    # changes or versions is one row on the probing side.
    chg = chg.join(dim.select(nk).distinct(), nk, "left_semi")
    affected = dim.join(chg.select(nk).distinct(), nk, "left_semi")
    latest = latest_per_key(affected, [nk], ["valid_from", sk])

    if late == "reject":
        bound = latest.select(nk, F.col("valid_from").alias("_sf_latest_from"))
        chg = chg.join(bound, nk).where(F.col(_D) > F.col("_sf_latest_from")).drop(
            "_sf_latest_from")
    if skip_unchanged:
        prev = {t: f"_sf_prev_{t}" for t in tracked}
        with_prev = lag_within(chg, [nk], [_D, _SEQ, *tracked], {**prev, _D: "_sf_prev_date"})
        base = latest.select(nk, *[F.col(t).alias(f"_sf_base_{t}") for t in tracked])
        with_prev = with_prev.join(base, nk)
        # A change is compared with the previous change of its key, the first
        # one with the key's latest version (a skipped change equals the value
        # before it, so comparing with raw previous changes is exact).
        has_prev = F.col("_sf_prev_date").isNotNull()
        changed = F.lit(False)
        for t in tracked:
            before = F.when(has_prev, F.col(prev[t])).otherwise(F.col(f"_sf_base_{t}"))
            changed = changed | ~F.col(t).eqNullSafe(before)
        chg = with_prev.where(changed).select(nk, _D, *tracked, _SEQ)

    # One numbering of the applied changes in (key, date, sequence) order
    # serves twice: as the surrogate keys of the new versions (continuing
    # after the largest existing key) and to find each change's successor.
    start = next_key_start(dim, sk) if max_key is None else max_key + 1
    numbered = with_position(chg, [nk, _D, _SEQ, *tracked], sk, start=start)
    chained = neighbor_values(numbered, sk, [nk], {_D: _NEXT_D}, 1)
    attrs = latest.select(nk, *carried)
    new_keyed = chained.join(attrs, nk).select(
        sk, nk, *carried, *tracked,
        F.col(_D).alias("valid_from"),
        F.date_sub(F.col(_NEXT_D), 1).alias("valid_to"),
        F.when(F.col(_NEXT_D).isNull(), 1).otherwise(0).alias("is_current"))

    # Read from the materialised numbering, not by re-deriving the batch.
    first = numbered.groupBy(nk).agg(F.min(_D).alias(_FIRST_D))
    closing = (F.col("is_current") == 1) & F.col(_FIRST_D).isNotNull()
    kept = dim.join(first, nk, "left").select(*[
        F.when(closing, F.date_sub(F.col(_FIRST_D), 1)).otherwise(F.col("valid_to")).alias(c)
        if c == "valid_to" else
        F.when(closing, F.lit(0)).otherwise(F.col("is_current")).alias(c)
        if c == "is_current" else F.col(c)
        for c in dim.columns])
    return kept.unionByName(new_keyed.select(*dim.columns))


def scd1_upsert(dim: DataFrame, updates: DataFrame, *, natural_key: str,
                surrogate_key: str) -> DataFrame:
    """Type-1 upsert: matched keys take the new attribute values and keep their
    surrogate key; new natural keys are appended with new keys.

    ``updates`` has the natural key and the attribute columns of ``dim``, one
    row per natural key; a repeated key is an error.
    """
    nk, sk = natural_key, surrogate_key
    twice = updates.groupBy(nk).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{nk} {twice[0][0]} is updated more than once")
    attrs = [c for c in dim.columns if c not in (nk, sk)]
    incoming = updates.select(nk, *[F.col(a).alias(f"_sf_new_{a}") for a in attrs],
                              F.lit(True).alias("_sf_hit"))
    merged = dim.join(incoming, nk, "left").select(*[
        F.when(F.col("_sf_hit"), F.col(f"_sf_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in attrs else F.col(c) for c in dim.columns])
    fresh = updates.select(nk, *attrs).join(dim.select(nk), nk, "left_anti")
    fresh_keyed = assign_keys(fresh, sk, [nk], next_key_start(dim, sk))
    return merged.unionByName(fresh_keyed.select(*dim.columns))


def version_history(dim: DataFrame, *, natural_key: str = "customer_id",
                    surrogate_key: str = "customer_key") -> DataFrame:
    """Every version with its number inside the key, oldest first
    (``WHERE id = ? ORDER BY valid_from`` for all keys at once)."""
    cols = [surrogate_key, natural_key, "full_name", "city", "valid_from", "valid_to", "is_current"]
    cols = [c for c in cols if c in dim.columns]
    return row_number_within(dim.select(*cols), [natural_key], ["valid_from", surrogate_key],
                             "version_no")


def history_of(dim: DataFrame, key_value, *, natural_key: str = "customer_id") -> DataFrame:
    """Versions of one key, oldest first (``WHERE id = ? ORDER BY valid_from``);
    the filter reaches the Parquet scan."""
    return dim.where(F.col(natural_key) == F.lit(key_value)).orderBy("valid_from")
