"""Tables are sent to all tasks by the size of their rows, not of their files."""

import os

import pytest
from pyspark.sql import functions as F

from strataform.session import FILE_BROADCAST, apply_required_conf, written_once

PLANNED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


@pytest.fixture
def thresholds(spark):
    """Sets both bounds and lets the library look at them; restores them at the end."""
    old = {k: spark.conf.get(k, None) for k in (PLANNED, MEASURED)}

    def use(planned, measured=None):
        spark.conf.unset(MEASURED)
        spark.conf.set(PLANNED, planned)
        if measured is not None:
            spark.conf.set(MEASURED, measured)
        apply_required_conf(spark)
        return spark.conf.get(PLANNED), spark.conf.get(MEASURED)

    yield use
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def kept(spark, rows):
    """A kept table of keys in order, its files' size and itself."""
    table = written_once(lambda: spark.range(rows).select(
        F.col("id").alias("product_id"), (F.col("id") + 1).alias("product_key")), spark, "keys")
    return table, sum(os.path.getsize(f.removeprefix("file:")) for f in table.inputFiles())


def plan_of(spark, table):
    """The plan that a join of many lines with ``table`` ended with."""
    lines = spark.range(4_000_000).select((F.col("id") % 1_000).alias("product_id"))
    df = lines.join(table, "product_id").agg(F.count("product_key"))
    assert df.collect()[0][0] == 4_000_000
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_many_rows_in_small_files_are_not_broadcast(spark, thresholds):
    thresholds("10m", "10m")
    table, size = kept(spark, 1_000_000)
    assert FILE_BROADCAST < size < 10 << 20 < 1_000_000 * 16
    plan = plan_of(spark, table)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_few_rows_are_broadcast(spark, thresholds):
    thresholds("10m", "10m")
    table, size = kept(spark, 1_000)
    assert size < FILE_BROADCAST
    assert "BroadcastHashJoin" in plan_of(spark, table)


def test_rows_measured_below_the_bound_are_broadcast(spark, thresholds):
    """Files beyond the planner's bound, rows below the session's."""
    thresholds("32m", "32m")
    table, size = kept(spark, 500_000)
    assert size > FILE_BROADCAST
    assert "BroadcastHashJoin" in plan_of(spark, table)


@pytest.mark.parametrize("planned", ["10485760b", "32m", "1g"])
def test_the_session_bound_holds_for_what_is_measured(thresholds, planned):
    assert thresholds(planned) == (str(FILE_BROADCAST), planned)
    assert thresholds(planned, "7m") == (str(FILE_BROADCAST), "7m")


def test_lower_bounds_are_left(thresholds):
    assert thresholds("-1") == ("-1", "-1")
    assert thresholds("1000", "5m") == ("1000", "5m")
