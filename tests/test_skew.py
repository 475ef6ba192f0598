"""Heavy orders: one order with 30 % of the lines."""

import statistics

from pyspark.sql import functions as F

from strataform.operators.skew import heavy_keys, spread_join

PARTS = 16


def tables(spark):
    lines = spark.range(20_000).select(
        F.col("id").alias("order_item_id"),
        F.when(F.col("id") % 10 < 3, F.lit(7)).when(F.col("id") % 1000 == 999, F.lit(None))
        .otherwise(1000 + F.col("id") % 5000).cast("bigint").alias("order_id"))
    # Orders without lines, and lines without orders.
    headers = spark.range(5900).where("id % 9 > 0").select(
        F.col("id").alias("order_id"), (F.col("id") * 3).alias("store_key"))
    return lines, headers


def test_heavy_keys(spark):
    lines, _ = tables(spark)
    assert [r[0] for r in heavy_keys(lines, "order_id", PARTS).collect()] == [7]
    assert heavy_keys(lines, "order_id", 3).count() == 0
    assert heavy_keys(lines.where("false"), "order_id", PARTS).count() == 0


def test_spread_join_equals_the_join_and_levels_its_tasks(spark):
    lines, headers = tables(spark)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        # The plan of tables beyond any broadcast, without rebalancing by the engine.
        for k, v in zip(before, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        got = spread_join(lines, headers, "order_id", heavy_keys(lines, "order_id", PARTS), "order_item_id", PARTS)
        columns = ["order_item_id", "order_id", "store_key"]
        want = lines.join(headers, "order_id").select(columns)
        assert sorted(got.select(columns).collect()) == sorted(want.collect())

        def largest_to_median(joined):
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(sizes) / statistics.median(sizes)

        assert largest_to_median(lines.join(headers, "order_id")) > 2
        assert largest_to_median(got.where("order_id <> 7")) <= 2
        # Shares of the heavy order, over the join's own tasks.
        assert got.where("order_id = 7").groupBy(F.spark_partition_id()).count().count() > 3
        assert got.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0] < 20_000 * 0.15
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
