"""Mergeable distinct counts, partial aggregates, late returns and appends."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from strataform import schemas
from strataform.operators.distinct import count_ids, id_bitmaps, merge_bitmaps
from strataform.operators.late_returns import unknown_lines, with_late_returns
from strataform.operators.staging import extract
from strataform.plans import increments, partials, warehouse
from strataform.plans.marts import MARTS
from strataform.sources import driver_tables
from strataform.sources.published import (ConcurrentPublish, last_version, month_of, new_run,
                                          publish_tables, published)
from tests.conftest import SF_SMALL

D = dt.date


def same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bitmaps_of_halves_merge_to_the_whole(spark):
    ids = spark.range(0, 40_000).select(
        (F.col("id") % 3).alias("k"), ((F.col("id") * 7919) % 100_003 - 50_000).alias("v"))
    ids = ids.unionByName(ids.limit(500)).unionByName(
        spark.createDataFrame([(0, None), (1, 2 ** 40), (None, 5), (5, None)], "k bigint, v bigint"))
    want = ids.groupBy("k").agg(F.count_distinct("v").alias("n")).where("n > 0")
    whole = id_bitmaps(ids, ["k"], "v")
    assert same(count_ids(whole, ["k"], "n"), want)
    left, right = (id_bitmaps(ids.where(F.pmod("v", F.lit(2)) == r), ["k"], "v") for r in (0, 1))
    both = merge_bitmaps(left.unionByName(right), ["k"])
    assert same(both, whole)
    # Over all groups: the sets are merged, not their counts added up.
    assert count_ids(whole.withColumn("all", F.lit(1)), ["all"], "n").first()["n"] == \
        ids.agg(F.count_distinct("v")).first()[0]


def test_scattered_ids_take_a_short_row_each(spark):
    """Ids far apart: as many words as ids, of 8 bytes, combined in a hash table."""
    ids = spark.range(0, 20_000).select((F.col("id") % 5).alias("k"), (F.col("id") * 100_003).alias("v"))
    found = id_bitmaps(ids.unionByName(ids), ["k"], "v")
    assert dict(found.dtypes)["bitmap"] == "bigint" and found.count() == 20_000
    for df in (found, merge_bitmaps(found, ["k"]), count_ids(found, ["k"], "n")):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()
    # Neighbours share a word.
    assert id_bitmaps(spark.range(-640, 640).selectExpr("1 k", "id v"), ["k"], "v").count() == 20


@pytest.fixture(scope="module")
def star(spark):
    wh = warehouse.derive_warehouse(spark, SF_SMALL)
    return {name: wh.star[name] for name in schemas.STAR}


def test_marts_from_partials_equal_the_marts(star):
    found = partials.marts_from(partials.partial_tables(star["fact_sales"], star["dim_customer"]), star)
    for name, build in MARTS.items():
        assert found[name].columns == build(star).columns
        assert [f.dataType for f in found[name].schema] == [f.dataType for f in build(star).schema]
        assert same(found[name], build(star)), name


def test_partials_of_three_batches_merge(star):
    fact = star["fact_sales"]
    parts = [partials.partial_tables(fact.where(F.pmod(F.xxhash64("order_item_id"), F.lit(3)) == i),
                                     star["dim_customer"]) for i in range(3)]
    both = {n: partials.merged(n, [p[n] for p in parts]) for n in partials.PARTIALS}
    for name, found in partials.marts_from(both, star).items():
        assert same(found, MARTS[name](star)), name


def test_partials_have_their_declared_schema(star):
    found = partials.partial_tables(star["fact_sales"], star["dim_customer"])
    for name, df in found.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in partials.partial_schema(name)]


def test_names_without_values_are_groups(star):
    nameless = dict(star)
    nameless["dim_store"] = star["dim_store"].withColumn("region", F.lit(None).cast("string"))
    nameless["dim_product"] = star["dim_product"].withColumn("category_name", F.lit(None).cast("string"))
    found = partials.marts_from(partials.partial_tables(star["fact_sales"], star["dim_customer"]), nameless)
    for name in ("mart_monthly_revenue", "mart_product_performance"):
        assert same(found[name], MARTS[name](nameless)), name


def _fact(spark, rows):
    line = spark.createDataFrame(rows, "fact_id bigint, order_item_id bigint, is_returned int")
    return line.withColumn("order_id", F.col("order_item_id") * 10)


def test_late_returns(spark):
    fact = _fact(spark, [(1, 1, 0), (2, 2, 0), (3, 3, 1), (4, 3, 1), (5, 4, 1)])
    returns = spark.createDataFrame(
        [(2,), (2,), (2,), (3,), (9,), (None,), (1,)], "order_item_id bigint")
    got = with_late_returns(fact, returns, 100).collect()
    assert sorted((r.order_item_id, r.order_id, r.is_returned) for r in got) == [
        (1, 10, 1), *[(2, 20, 1)] * 3, *[(3, 30, 1)] * 3, (4, 40, 1)]
    assert {1, 2, 3, 4, 5} <= {r.fact_id for r in got} and len({r.fact_id for r in got}) == 8
    assert min(r.fact_id for r in got if r.fact_id > 5) >= 100
    assert [r.order_item_id for r in unknown_lines(returns, fact).collect()] == [9]
    assert same(with_late_returns(fact, returns.where("false")), fact)


def test_late_returns_run_the_load_once(spark):
    """Both uses of the rows, marked and copied, read what was written."""
    runs = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(x):
        runs.add(1)
        return x

    fact = _fact(spark, [(i, i, 0) for i in range(1, 9)]).withColumn("fact_id", seen("fact_id"))
    returns = spark.createDataFrame([(1,), (1,), (3,)], "order_item_id bigint")
    got = with_late_returns(fact, returns, 100)
    assert got.where("is_returned = 1").count() == 3 and got.count() == 9
    assert runs.value == 8


def test_orders_are_derived_once(spark):
    source = driver_tables.source_tables(spark, SF_SMALL)
    plan = source["sales_orders"]._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


@pytest.fixture(scope="module")
def batches(spark):
    """The operational tables in two batches of orders, by date; every return is in
    the second one, so most are of lines sold in the first."""
    source = {n: t for n, t in driver_tables.source_tables(spark, SF_SMALL).items()}
    orders = source["sales_orders"]
    cut = orders.agg(F.percentile_approx("order_date", 0.8)).first()[0]
    early = {**source, "sales_orders": orders.where(F.col("order_date") <= cut),
             "product_returns": source["product_returns"].where("false")}
    early["sales_order_items"] = source["sales_order_items"].join(
        early["sales_orders"].select("order_id"), "order_id", "left_semi").select(
        *source["sales_order_items"].columns)
    late = {"sales_orders": orders.where(F.col("order_date") > cut),
            "product_returns": source["product_returns"]}
    late["sales_order_items"] = source["sales_order_items"].join(
        late["sales_orders"].select("order_id"), "order_id", "left_semi").select(
        *source["sales_order_items"].columns)
    span = orders.agg(F.min("order_date"), F.max("order_date")).first()
    return source, early, late, (D(span[0].year, 1, 1), D(span[1].year, 12, 31))


@pytest.fixture(scope="module")
def grown(spark, batches, tmp_path_factory):
    """A warehouse of the first batch and the one after the second."""
    _, early, late, calendar = batches
    root = str(tmp_path_factory.mktemp("warehouse"))
    none = spark.createDataFrame([], "customer_id bigint, change_date date, city string")
    warehouse.run_build(spark, None, root, changes=none, sources=early, calendar=calendar)
    args = [extract(late[n], n) for n in ("sales_order_items", "sales_orders", "product_returns")]
    # A first, small append deals the fact by month.
    small = args[1].orderBy("order_id").limit(3)
    some = args[0].join(small.select("order_id"), "order_id", "left_semi").select(*args[0].columns)
    first = [some, small, args[2].where("false")]
    increments.append_sales(spark, root, *first)
    before = published(spark, root)
    rest = [args[0].join(small, "order_id", "left_anti").select(*args[0].columns),
            args[1].join(small, "order_id", "left_anti").select(*args[1].columns), args[2]]
    increments.append_sales(spark, root, *rest)
    return root, before, rest


def test_two_batches_equal_a_full_load(spark, grown, batches, star):
    root, before, _ = grown
    got = increments.published_star(spark, root)
    assert same(got["fact_sales"].drop("fact_id"), star["fact_sales"].drop("fact_id"))
    assert got["fact_sales"].select("fact_id").distinct().count() == got["fact_sales"].count()
    tables = published(spark, root)["tables"]
    for name, build in MARTS.items():
        assert same(spark.read.parquet(*tables[f"marts/{name}"]), build(got)), name
        assert same(spark.table(name), build(got)), name


def test_only_touched_months_are_replaced(spark, grown):
    root, before, rest = grown
    after = published(spark, root)["tables"]["star/fact_sales"]
    old = before["tables"]["star/fact_sales"]
    assert all(month_of(f) is not None for f in after)
    lines = spark.read.schema(schemas.STAR["fact_sales"]).parquet(*old)
    returned = {r[0] for r in lines.join(rest[2], "order_item_id", "left_semi").select(
        partials.sales_month()).distinct().collect()}
    kept = [f for f in old if month_of(f) not in returned]
    assert all(f in after for f in kept)
    assert not any(f in after for f in old if month_of(f) in returned)


def test_a_batch_of_new_lines_reads_only_its_own_folders(spark, grown, batches):
    """The partials of a batch come from its own rows."""
    root, before, _ = grown
    run = published(spark, root)["run"]
    for name in partials.PARTIALS:
        folders = published(spark, root)["tables"][f"partials/{name}"]
        assert len({month_of(f) for f in folders}) == len(folders)  # one folder a month
    assert glob.glob(os.path.join(run, "partials", "sums", "month_folder=*"))


def test_staging_audit_and_counts_follow(spark, grown, batches):
    root, _, rest = grown
    source = batches[0]
    now = published(spark, root)["tables"]
    for name in ("sales_order_items", "sales_orders", "product_returns"):
        assert spark.read.parquet(*now[f"staging/stg_{name}"]).count() == source[name].count()
    counts = {r.table_name: r.row_count for r in spark.read.parquet(*now["audit/row_counts"]).collect()}
    assert counts["stg_sales_order_items"] == source["sales_order_items"].count()
    assert counts["fact_sales"] == increments.published_star(spark, root)["fact_sales"].count()
    assert all(r.passed for r in spark.read.parquet(*now["audit/checks"]).collect())
    steps = {r.step: r.status for r in spark.read.parquet(*now["audit/steps"]).collect()}
    assert set(steps) == {"extract", "fact", "returns", "partials", "marts"}
    assert set(steps.values()) == {"OK"}


def test_bad_batches_change_nothing(spark, grown):
    root, _, rest = grown
    items, orders, returns = rest
    before = published(spark, root)
    with pytest.raises(RuntimeError, match="already loaded"):
        increments.append_sales(spark, root, items, orders, returns)
    unknown = returns.limit(1).withColumn("order_item_id", F.lit(10 ** 12))
    with pytest.raises(RuntimeError, match="unknown lines"):
        increments.append_sales(spark, root, items.where("false"), orders.where("false"), unknown)
    assert published(spark, root) == before


def test_returns_alone(spark, grown):
    root, _, rest = grown
    fact = increments.published_star(spark, root)["fact_sales"]
    line = fact.where("is_returned = 0").orderBy("order_item_id").first()
    rows, kept = fact.count(), fact.where("is_returned = 0").count()
    two = rest[2].limit(1).withColumn("order_item_id", F.lit(line.order_item_id))
    increments.append_sales(spark, root, rest[0].where("false"), rest[1].where("false"),
                            two.unionByName(two))
    now = increments.published_star(spark, root)
    assert (now["fact_sales"].count(), now["fact_sales"].where("is_returned = 0").count()) == (
        rows + 1, kept - 1)
    tables = published(spark, root)["tables"]
    for name, build in MARTS.items():
        assert same(spark.read.parquet(*tables[f"marts/{name}"]), build(now)), name


def test_customer_changes_after_appends(spark, grown):
    root, _, _ = grown
    log = spark.read.parquet(*published(spark, root)["tables"]["audit/customer_changes"]).count()
    customer = increments.published_star(spark, root)["dim_customer"].orderBy("customer_id").first()
    increments.apply_batch(spark, root, spark.createDataFrame(
        [(customer.customer_id, D(2002, 1, 1), "Elsewhere")],
        "customer_id bigint, change_date date, city string"))
    star, tables = increments.published_star(spark, root), published(spark, root)["tables"]
    for name, build in MARTS.items():
        assert same(spark.read.parquet(*tables[f"marts/{name}"]), build(star)), name
    assert spark.read.parquet(*tables["audit/customer_changes"]).count() == log + 1


def test_the_second_of_two_writers_fails(spark, tmp_path):
    root = str(tmp_path)
    first = publish_tables(spark, root, new_run(root), {"a/b": ["x"]})
    assert first == 1 == last_version(spark, root)
    publish_tables(spark, root, new_run(root), {"a/b": ["x", "y"]}, after=first)
    with pytest.raises(ConcurrentPublish):
        publish_tables(spark, root, new_run(root), {"a/b": ["x", "z"]}, after=first)
    assert published(spark, root)["tables"] == {"a/b": ["x", "y"]}
    assert [n for n in os.listdir(os.path.join(root, "published")) if n.startswith("_")] == []
