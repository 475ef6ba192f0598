"""Returns of lines that are in the fact already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table


def returns_per_line(returns: DataFrame) -> DataFrame:
    """order_item_id, n: how many returns each line has."""
    return returns.where(F.col("order_item_id").isNotNull()).groupBy("order_item_id").agg(
        F.count(F.lit(1)).alias("n"))


def with_late_returns(fact: DataFrame, returns: DataFrame, fact_id_start: int | Column = 0
                      ) -> DataFrame:
    """``fact`` as if ``returns`` had been known when its lines were loaded.

    The fact holds one row for each return of a line, or one row without any.  So
    the first return of a line marks its row, and every further one adds a row
    like it, whose ``fact_id`` goes on from ``fact_id_start``.  Returns of other
    lines change nothing.  A line returned often is one row here until its copies
    are made.  The joined rows are written once, as ``fact`` may be a load that has
    not run yet.
    """
    late = returns_per_line(returns).select("order_item_id", F.col("n").alias("_late"))
    rows = scratch_table(fact.join(late, "order_item_id", "left").select(*fact.columns, "_late"),
                         "late_returns", "zstd")
    marked = rows.withColumn("is_returned", F.when(F.col("_late").isNotNull(), F.lit(1)).otherwise(
        F.col("is_returned")).cast("int")).select(*fact.columns)
    # Of a line returned before, any row stands for all of them.
    like = F.min(F.struct("fact_id", *[c for c in fact.columns if c != "fact_id"])).alias("_row")
    # The one row of a line that was not returned before takes its only return.
    more = F.col("_late") + F.col("is_returned") > 1
    further = rows.where(F.col("_late").isNotNull() & more).groupBy("order_item_id").agg(
        like, F.first("_late").alias("_late")).select(
        "_row", (F.col("_late") + F.col("_row.is_returned") - 1).alias("_more")).where("_more > 0")
    copies = further.select("_row.*", F.explode(F.sequence(F.lit(1).cast("bigint"), "_more")).alias("_copy"))
    copies = copies.withColumn("is_returned", F.lit(1)).withColumn(
        "fact_id", F.monotonically_increasing_id() + F.lit(fact_id_start))
    return marked.unionByName(copies.select(*fact.columns))


def unknown_lines(returns: DataFrame, fact: DataFrame) -> DataFrame:
    """Lines that are returned but not in the fact."""
    return returns_per_line(returns).join(fact.select("order_item_id"), "order_item_id", "left_anti")
