"""Order-dependent operators that never gather a whole table or group in one task.

Spark's ``row_number()``/``rank()`` over a window without ``PARTITION BY`` moves
every row to a single partition, and a window partitioned by a business key
puts a hot key in one task.  The operators here are built on one primitive,
``with_position``: a dense 1..N position in a total order, computed as

1. range-partition on the sort key (a hot key value is split across ranges
   because the sort key is completed with tie-breaker columns) and sort
   inside each range,
2. tag rows with ``monotonically_increasing_id`` (partition id in the upper
   bits, row index in the lower 33 bits) and write them as a table in the
   shared checkpoint folder, so a lost executor cannot change the numbering,
3. count rows per partition (one row per partition), turn the counts into
   start offsets and add them back through a broadcast of that small table.

Everything else (surrogate keys, global rank with gaps, next row in a group,
row number in a group) is expressed with positions, equi-joins on unique
columns and map-side-combinable aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_table

_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1
_MID, _PID, _CNT, _OFF = "_sf_mid", "_sf_pid", "_sf_cnt", "_sf_off"

ColumnOrName = Column | str


def _sort_cols(order_by: Sequence[ColumnOrName]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in order_by]


def _range_partition(df: DataFrame, sort_cols: list[Column], partitions: int | None) -> DataFrame:
    """Range-partition and sort inside each range.  Without an explicit count
    adaptive execution sizes the ranges (merging neighbours keeps the global
    order), so small inputs do not fan out into many tiny tasks."""
    ranged = (df.repartitionByRange(partitions, *sort_cols) if partitions
              else df.repartitionByRange(*sort_cols))
    return ranged.sortWithinPartitions(*sort_cols)


def with_position(df: DataFrame, order_by: Sequence[ColumnOrName], name: str = "pos",
                  start: int = 1, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order_by`` (a total order).

    ``order_by`` should identify rows uniquely; ties get distinct positions in
    an order fixed by the materialisation.  Runs two jobs when called (range
    sampling, then one pass that sorts, tags and writes to the checkpoint
    folder); the returned DataFrame is otherwise lazy.
    """
    ordered = _range_partition(df, _sort_cols(order_by), partitions)
    tagged = scratch_table(ordered.withColumn(_MID, F.monotonically_increasing_id()), "position")
    pid = F.shiftright(F.col(_MID), _ROW_BITS)
    # One row per partition: bounded by the partition count, safe to broadcast.
    counts = tagged.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias(_CNT))
    offsets = counts.select(
        _PID, (F.sum(_CNT).over(Window.orderBy(_PID)) - F.col(_CNT)).alias(_OFF))
    joined = tagged.join(F.broadcast(offsets), pid == F.col(_PID))
    position = F.lit(start) + F.col(_OFF) + F.col(_MID).bitwiseAND(F.lit(_ROW_MASK))
    return joined.select(*df.columns, position.cast("bigint").alias(name))


def prefix_sum(df: DataFrame, order_by: Sequence[ColumnOrName], value: str,
               name: str = "running_total", partitions: int | None = None) -> DataFrame:
    """Running sum of the integer column ``value`` along a global total order.

    A distributed scan: range-partition and sort (as ``with_position``), sum
    inside each range over Arrow batches (rows arrive in sorted order, no
    shuffle, the other columns are passed through untouched) and write to the
    checkpoint folder, then add the totals of all earlier ranges (one row per
    range, broadcast).
    """
    ordered = _range_partition(df, _sort_cols(order_by), partitions)
    tagged = ordered.select(
        *df.columns, F.monotonically_increasing_id().alias(_MID),
        F.coalesce(F.col(value).cast("bigint"), F.lit(0)).alias("_sf_v"))
    local_name = "_sf_local"
    out_schema = T.StructType(tagged.schema.fields + [T.StructField(local_name, T.LongType(), False)])

    def running(batches):
        # One call per range partition; batches arrive in sorted row order.
        carry = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            local = pc.add(pc.cumulative_sum(batch.column("_sf_v")), carry)
            carry = local[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, local],
                                             names=[*batch.schema.names, local_name])

    local = scratch_table(tagged.mapInArrow(running, out_schema), "prefix")
    pid = F.shiftright(F.col(_MID), _ROW_BITS)
    totals = local.groupBy(pid.alias(_PID)).agg(F.sum("_sf_v").alias(_CNT))
    offsets = totals.select(
        _PID, (F.sum(_CNT).over(Window.orderBy(_PID)) - F.col(_CNT)).alias(_OFF))
    joined = local.join(F.broadcast(offsets), pid == F.col(_PID))
    return joined.select(*df.columns, (F.col(_OFF) + F.col(local_name)).alias(name))


def carry_forward(df: DataFrame, order_by: Sequence[ColumnOrName], is_source: str,
                  values: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Add the ``values`` (column -> output name) of the nearest earlier row, in the
    total order, for which the boolean column ``is_source`` holds (the row
    itself included); NULL before the first.

    Range-partition and sort, fill forward inside each range over Arrow
    batches, and write once.  Rows before their range's first source row take
    the last source row of the earlier ranges: one row per range, broadcast.
    """
    ordered = _range_partition(df, _sort_cols(order_by), partitions)
    tagged = ordered.withColumn(_MID, F.monotonically_increasing_id())
    filled, whole = "_sf_filled", list(values)
    kind = T.StructType([T.StructField(c, df.schema[c].dataType) for c in whole])
    out_schema = T.StructType([*tagged.schema.fields, T.StructField(filled, kind)])

    def fill(batches):
        # One call per range partition; batches arrive in sorted row order.
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            found = pa.StructArray.from_arrays([batch.column(c) for c in whole], names=whole)
            rows = pa.array(range(batch.num_rows), pa.int64())
            at = pc.fill_null_forward(pc.if_else(
                pc.fill_null(batch.column(is_source), False), rows, pa.scalar(None, pa.int64())))
            here = found.take(at)
            if last is not None:  # rows before the batch's first source row
                here = pa.concat_arrays([last, found]).take(
                    pc.if_else(pc.is_null(at), 0, pc.add(at, 1)))
            last = here.slice(len(here) - 1, 1) if here[-1].is_valid else last
            yield pa.RecordBatch.from_arrays([*batch.columns, here],
                                             names=[*batch.schema.names, filled])

    local = scratch_table(tagged.mapInArrow(fill, out_schema), "carried")
    pid = F.shiftright(F.col(_MID), _ROW_BITS)
    ends = local.groupBy(pid.alias(_PID)).agg(F.max_by(
        F.struct(*whole), F.when(F.col(is_source), F.col(_MID))).alias("_sf_end"))
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(_PID, F.last("_sf_end", ignorenulls=True).over(earlier).alias("_sf_before"))
    joined = local.join(F.broadcast(ends), pid == F.col(_PID))
    value = F.coalesce(filled, "_sf_before")
    return joined.select(*df.columns, *[value[c].alias(name) for c, name in values.items()])


def assign_keys(df: DataFrame, key: str, order_by: Sequence[ColumnOrName],
                start: int = 1, partitions: int | None = None) -> DataFrame:
    """Surrogate key assignment (AUTO_INCREMENT in natural-key order).

    The key is put first, as in a dimension's declared column list.
    """
    with_key = with_position(df, order_by, key, start, partitions)
    return with_key.select(key, *df.columns)


def next_key_start(df: DataFrame, key: str) -> int:
    """1 + the largest existing key (one scalar through the driver)."""
    row = df.agg(F.max(key).alias("m")).first()
    return 1 if row is None or row["m"] is None else int(row["m"]) + 1


def global_rank(df: DataFrame, value: str, name: str = "rank", descending: bool = True,
                tie_breakers: Sequence[str] = ()) -> DataFrame:
    """SQL ``RANK() OVER (ORDER BY value)`` without a single-partition window."""
    return rank_in_order(df, [f"-{value}" if descending else value], name, tie_breakers)


def rank_in_order(df: DataFrame, order: Sequence[str], name: str = "rank",
                  tie_breakers: Sequence[str] = ()) -> DataFrame:
    """SQL ``RANK()`` over several columns (``-`` marks a descending one; nulls first
    in ascending, last in descending columns) without a single-partition window.

    rank = first position of the row's tie group.  Tie groups are reduced with
    a map-side ``min`` and joined back on the (null-safe) values; a hot tie value
    is split by adaptive skew-join handling, not gathered.
    """
    values = [c.lstrip("-") for c in order]
    sort = [F.col(v).desc_nulls_last() if c.startswith("-") else F.col(v).asc_nulls_first()
            for c, v in zip(order, values)]
    pos_col = "_sf_rank_pos"
    positioned = with_position(df, [*sort, *tie_breakers], pos_col)
    firsts = positioned.groupBy(*[F.col(v).alias(f"_sf_rank_{i}") for i, v in enumerate(values)]).agg(
        F.min(pos_col).alias(name))
    joined = positioned.join(firsts, [positioned[v].eqNullSafe(firsts[f"_sf_rank_{i}"])
                                      for i, v in enumerate(values)])
    return joined.select(*df.columns, F.col(name))


def row_number_within(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnOrName],
                      name: str = "row_in_group") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_by)``, skew-safe."""
    pos_col = "_sf_rn_pos"
    positioned = with_position(df, [*keys, *order_by], pos_col)
    renamed = {k: f"_sf_rn_key_{i}" for i, k in enumerate(keys)}
    firsts = positioned.groupBy(*[F.col(k).alias(renamed[k]) for k in keys]).agg(
        F.min(pos_col).alias("_sf_rn_first"))
    cond = [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys]
    joined = positioned.join(firsts, cond)
    return joined.select(*df.columns,
                         (F.col(pos_col) - F.col("_sf_rn_first") + 1).alias(name))


def neighbor_values(positioned: DataFrame, pos_col: str, keys: Sequence[str],
                    values: dict[str, str], offset: int = 1) -> DataFrame:
    """On a frame numbered by ``with_position`` (keys first in the order), add
    the ``values`` (source -> output name) of the row ``offset`` positions
    away when it belongs to the same key group, else NULL.

    A join of position p with position p + offset: a unique key on both
    sides, so no key is hot however large its group.
    """
    other = positioned.select(
        (F.col(pos_col) - offset).alias(pos_col),
        *[F.col(k).alias(f"_sf_nb_{k}") for k in keys],
        *[F.col(src).alias(dst) for src, dst in values.items()])
    joined = positioned.join(other, pos_col, "left")
    same_group = F.lit(True)
    for k in keys:
        same_group = same_group & F.col(k).eqNullSafe(F.col(f"_sf_nb_{k}"))
    return joined.select(
        *[c for c in positioned.columns],
        *[F.when(same_group, F.col(dst)).alias(dst) for dst in values.values()])


def neighbor_within(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnOrName],
                    values: dict[str, str], offset: int = 1) -> DataFrame:
    """Values of the row ``offset`` places away inside each key group.

    ``LEAD(v, k)`` (offset k > 0) or ``LAG(v, -k)`` (k < 0) ``OVER (PARTITION
    BY keys ORDER BY order_by)``, skew-safe (see ``neighbor_values``).
    """
    pos_col = "_sf_nb_pos"
    positioned = with_position(df, [*keys, *order_by], pos_col)
    return neighbor_values(positioned, pos_col, keys, values, offset).drop(pos_col)


def lead_within(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnOrName],
                values: dict[str, str]) -> DataFrame:
    """``LEAD(v) OVER (PARTITION BY keys ORDER BY order_by)``, skew-safe."""
    return neighbor_within(df, keys, order_by, values, 1)


def lag_within(df: DataFrame, keys: Sequence[str], order_by: Sequence[ColumnOrName],
               values: dict[str, str]) -> DataFrame:
    """``LAG(v) OVER (PARTITION BY keys ORDER BY order_by)``, skew-safe."""
    return neighbor_within(df, keys, order_by, values, -1)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key (``ORDER BY .. DESC LIMIT 1``).

    ``max_by`` is combined map-side, so a key holding many rows is reduced
    before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*order_by)).alias("_sf_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_sf_best.{c}").alias(c)
                                                       for c in others]).select(*df.columns)
