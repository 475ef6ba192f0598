"""Order-dependent operators against brute force on small fixtures."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataform.operators.ordering import (assign_keys, global_rank, lag_within, latest_per_key,
                                           lead_within, prefix_sum, rank_in_order,
                                           row_number_within, with_position)


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_with_position_is_dense_and_ordered(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(1000), i) for i in range(500)]
    df = _frame(spark, rows, "k int, i int").repartition(7)
    got = with_position(df, ["k", "i"], "pos", start=10).toPandas()
    expected = sorted(rows)
    got = got.sort_values("pos")
    assert list(got["pos"]) == list(range(10, 10 + len(rows)))
    assert list(zip(got["k"], got["i"])) == expected


def test_with_position_splits_a_hot_key(spark):
    # One key holds a third of the rows; positions stay dense and ordered.
    rows = [(0, i) for i in range(300)] + [(k, i) for i, k in enumerate(range(1, 601))]
    df = _frame(spark, rows, "k int, i int")
    got = with_position(df, ["k", "i"], "pos").toPandas().sort_values("pos")
    assert list(got["pos"]) == list(range(1, 901))
    assert list(zip(got["k"], got["i"])) == sorted(rows)


def test_assign_keys_puts_key_first(spark):
    df = _frame(spark, [("b",), ("a",), ("c",)], "name string")
    out = assign_keys(df, "name_key", ["name"])
    assert out.columns == ["name_key", "name"]
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_global_rank_has_gaps_after_ties(spark):
    rows = [("a", 10), ("b", 30), ("c", 30), ("d", 20), ("e", None)]
    df = _frame(spark, rows, "name string, v int")
    got = dict((r["name"], r["rank"]) for r in global_rank(df, "v", "rank").collect())
    assert got == {"b": 1, "c": 1, "d": 3, "a": 4, "e": 5}


def test_row_number_within_matches_pandas(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(50), i) for i in range(200)]
    df = _frame(spark, rows, "g int, v int, i int")
    got = row_number_within(df, ["g"], ["v", "i"], "rn").toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "v", "i"]).sort_values(["g", "v", "i"])
    pdf["rn"] = pdf.groupby("g").cumcount() + 1
    merged = got.merge(pdf, on=["g", "v", "i"], suffixes=("", "_exp"))
    assert len(merged) == len(rows)
    assert (merged["rn"] == merged["rn_exp"]).all()


@pytest.mark.parametrize("direction", ["lead", "lag"])
def test_lead_lag_within_match_pandas(spark, direction):
    rng = random.Random(11)
    rows = [(rng.choice([1, 1, 2, 3, 4]), i, rng.randrange(100)) for i in range(150)]
    df = _frame(spark, rows, "g int, t int, v int")
    op = lead_within if direction == "lead" else lag_within
    got = op(df, ["g"], ["t"], {"v": "other"}).toPandas().sort_values(["g", "t"])
    pdf = pd.DataFrame(rows, columns=["g", "t", "v"]).sort_values(["g", "t"])
    shift = -1 if direction == "lead" else 1
    pdf["other"] = pdf.groupby("g")["v"].shift(shift)
    assert got["other"].fillna(-1).tolist() == pdf["other"].fillna(-1).astype(int).tolist()


def test_prefix_sum_matches_cumsum(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(20), i, rng.randrange(3)) for i in range(300)]
    df = _frame(spark, rows, "k int, i int, w int")
    got = prefix_sum(df, ["k", "i"], "w", "run").toPandas().sort_values(["k", "i"])
    pdf = pd.DataFrame(rows, columns=["k", "i", "w"]).sort_values(["k", "i"])
    assert got["run"].tolist() == pdf["w"].cumsum().tolist()


def test_latest_per_key(spark):
    rows = [(1, "2024-01-01", "x"), (1, "2024-03-01", "y"), (2, "2023-01-01", "z")]
    df = _frame(spark, rows, "k int, d string, v string").withColumn("d", F.to_date("d"))
    got = {r["k"]: r["v"] for r in latest_per_key(df, ["k"], ["d"]).collect()}
    assert got == {1: "y", 2: "z"}


@pytest.fixture
def many_small_partitions(spark):
    """Make adaptive execution keep many small ranges (offsets across ranges)."""
    keys = ["spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize",
            "spark.sql.shuffle.partitions"]
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "1k")
    spark.conf.set(keys[1], "1k")
    spark.conf.set(keys[2], "32")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_positions_and_prefix_sums_across_many_ranges(spark, many_small_partitions,
                                                     monkeypatch):
    import strataform.operators.ordering as ordering

    written = []
    real = ordering.scratch_table
    monkeypatch.setattr(ordering, "scratch_table",
                        lambda d, label: written.append(real(d, label)) or written[-1])
    rng = random.Random(17)
    rows = [(rng.randrange(50), i, rng.randrange(5)) for i in range(5000)]
    df = _frame(spark, rows, "k int, i int, w int").repartition(9)
    pos = with_position(df, ["k", "i"], "pos")
    ranges = written[0].select(F.shiftright("_sf_mid", 33)).distinct().count()
    assert ranges > 1
    got = pos.toPandas().sort_values("pos")
    assert list(got["pos"]) == list(range(1, len(rows) + 1))
    assert list(zip(got["k"], got["i"])) == sorted((k, i) for k, i, _ in rows)
    run = prefix_sum(df, ["k", "i"], "w", "run").toPandas().sort_values(["k", "i"])
    expected = pd.DataFrame(rows, columns=["k", "i", "w"]).sort_values(["k", "i"])["w"].cumsum()
    assert run["run"].tolist() == expected.tolist()


def test_rank_in_order_of_several_columns(spark):
    rows = [(a, b, i) for i, (a, b) in enumerate(
        [(1, "x"), (1, "x"), (None, "y"), (2, None), (2, "z"), (1, "a"), (None, "y"), (2, "z")])]
    df = spark.createDataFrame(rows, "a int, b string, i int")
    want = df.withColumn("rank", F.rank().over(Window.orderBy(F.col("a").asc(), F.desc("b"))).cast("bigint"))
    got = rank_in_order(df, ["a", "-b"], "rank", ["i"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert rank_in_order(df.where("false"), ["a"]).count() == 0
