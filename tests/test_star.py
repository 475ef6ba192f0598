"""Calendar, fact load and mart edge cases (returns fan-out, null keys,
point-in-time keys, zero revenue, cities without sales, ties, name merges)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strataform import schemas
from strataform.operators.dimensions import dim_date
from strataform.operators.facts import fact_sales
from strataform.plans import marts

D = dt.date


def test_dim_date_2024(spark):
    cal = dim_date(spark, D(2024, 1, 1), D(2024, 12, 31))
    rows = {r["full_date"]: r for r in cal.collect()}
    assert len(rows) == 366
    leap = rows[D(2024, 2, 29)]
    assert leap["date_key"] == 20240229 and leap["month_name"] == "February"
    assert rows[D(2024, 12, 31)]["quarter"] == 4
    sat, sun, mon = rows[D(2024, 1, 6)], rows[D(2024, 1, 7)], rows[D(2024, 1, 8)]
    assert (sat["day_of_week"], sat["is_weekend"]) == ("Saturday", 1)
    assert (sun["day_of_week"], sun["is_weekend"]) == ("Sunday", 1)
    assert (mon["day_of_week"], mon["is_weekend"]) == ("Monday", 0)


def _star_inputs(spark):
    items = spark.createDataFrame([
        (101, 1, 10, 2, Decimal("100.00"), Decimal("0.00")),
        (102, 1, 11, 1, Decimal("50.00"), Decimal("10.00")),
        (201, 2, 10, 3, Decimal("100.00"), Decimal("0.00")),
        (301, 3, 10, 1, Decimal("100.00"), Decimal("0.00")),   # order without customer
    ], schemas.SOURCE["sales_order_items"])
    orders = spark.createDataFrame([
        (1, 7, 1, 1, D(2024, 3, 5), "card"),
        (2, 7, 1, 1, D(2024, 8, 1), "cash"),
        (3, None, 1, 1, D(2024, 8, 2), "cash"),
    ], schemas.SOURCE["sales_orders"])
    returns = spark.createDataFrame([
        (1, 102, D(2024, 3, 9), None), (2, 102, D(2024, 3, 10), "again"),
    ], schemas.SOURCE["product_returns"])
    customers = spark.createDataFrame([
        (1, 7, "Ann", "Nantes", 1, D(2024, 1, 1), D(2024, 1, 1), D(2024, 6, 30), 0),
        (2, 7, "Ann", "Paris", 1, D(2024, 1, 1), D(2024, 7, 1), None, 1),
    ], schemas.STAR["dim_customer"])
    products = spark.createDataFrame([
        (1, 10, "Lamp", "Home", Decimal("60.00"), Decimal("100.00")),
        (2, 11, "Lamp", "Home", Decimal("30.00"), Decimal("55.00")),
    ], schemas.STAR["dim_product"])
    stores = spark.createDataFrame([(1, 1, "Centre", "Paris", "IDF", D(2019, 1, 1))],
                                   schemas.STAR["dim_store"])
    employees = spark.createDataFrame([(1, 1, "Lea", "Sales Assistant", 1, D(2020, 1, 1))],
                                      schemas.STAR["dim_employee"])
    return items, orders, returns, customers, products, stores, employees


def test_fact_current_keys_returns_fanout_and_null_customer(spark):
    items, orders, returns, customers, products, stores, employees = _star_inputs(spark)
    fact = fact_sales(items, orders, returns, customers, products, stores, employees)
    rows = sorted((r["order_item_id"], r["customer_key"], r["is_returned"], r["line_revenue"],
                   r["line_cost"], r["line_margin"], r["date_key"]) for r in fact.collect())
    assert rows == [
        (101, 2, 0, Decimal("200.00"), Decimal("120.00"), Decimal("80.00"), 20240305),
        (102, 2, 1, Decimal("50.00"), Decimal("30.00"), Decimal("20.00"), 20240305),
        (102, 2, 1, Decimal("50.00"), Decimal("30.00"), Decimal("20.00"), 20240305),
        (201, 2, 0, Decimal("300.00"), Decimal("180.00"), Decimal("120.00"), 20240801),
    ]
    once = fact_sales(items, orders, returns, customers, products, stores, employees,
                      dedupe_returns=True)
    assert once.where("order_item_id = 102").count() == 1
    assert fact.select("fact_id").distinct().count() == 4


def test_fact_with_heavy_orders_apart(spark):
    from strataform.operators.skew import heavy_keys

    items, orders, returns, customers, products, stores, employees = _star_inputs(spark)
    # More lines of one order: it holds over a third of them.
    kind = items.schema["order_item_id"].dataType
    more = items.limit(1).withColumn("order_item_id", F.explode(F.sequence(
        F.lit(1001).cast(kind), F.lit(1020).cast(kind))))
    items = items.unionByName(more)
    assert heavy_keys(items, "order_id", 3).count() == 1
    tables = (items, orders, returns, customers, products, stores, employees)
    plain = fact_sales(*tables, with_fact_id=False).collect()
    apart = fact_sales(*tables, with_fact_id=False, heavy_parts=3).collect()
    assert len(plain) > 20 and sorted(plain, key=repr) == sorted(apart, key=repr)
    ids = [r.fact_id for r in fact_sales(*tables, heavy_parts=3).collect()]
    assert len(set(ids)) == len(ids) == len(plain)


def test_fact_with_headers_last(spark):
    """The same rows; no shuffle moves the lines for the products again, or the
    keys of the header."""
    tables = _star_inputs(spark)
    plain = fact_sales(*tables, with_fact_id=False)
    last = fact_sales(*tables, with_fact_id=False, headers_last=True)
    assert last.columns == plain.columns
    assert sorted(last.collect(), key=repr) == sorted(plain.collect(), key=repr) != []
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("-1", "-1", "false")):
            spark.conf.set(k, v)
        items, orders, returns, *dims = tables
        parts = spark.range(0, 50).select(F.col("id").alias("p"))
        items = items.join(parts, items["product_id"] == parts["p"]).drop("p")  # as derived

        def exchanges(**how):
            plan = fact_sales(items, orders, returns, *dims, with_fact_id=False, **how)
            return plan._jdf.queryExecution().executedPlan().toString().count("Exchange hash")

        assert exchanges(headers_last=True) == exchanges() - 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("open_first", [False, True])
def test_fact_as_of_keys(spark, open_first):
    items, orders, returns, customers, products, stores, employees = _star_inputs(spark)
    fact = fact_sales(items, orders, returns, customers, products, stores, employees,
                      key_mode="as_of", open_first_version=open_first)
    got = {r["order_item_id"]: r["customer_key"] for r in fact.collect()}
    assert got[101] == 1 and got[102] == 1 and got[201] == 2
    assert 301 not in got


def test_as_of_before_first_version(spark):
    items, orders, returns, customers, products, stores, employees = _star_inputs(spark)
    early = spark.createDataFrame([
        (1, 7, "Ann", "Nantes", 1, D(2024, 4, 1), D(2024, 4, 1), D(2024, 6, 30), 0),
        (2, 7, "Ann", "Paris", 1, D(2024, 4, 1), D(2024, 7, 1), None, 1),
    ], schemas.STAR["dim_customer"])
    strict = fact_sales(items, orders, returns, early, products, stores, employees,
                        key_mode="as_of")
    assert strict.where("order_id = 1").count() == 0      # placed before signup
    opened = fact_sales(items, orders, returns, early, products, stores, employees,
                        key_mode="as_of", open_first_version=True)
    assert {r["customer_key"] for r in opened.where("order_id = 1").collect()} == {1}


def _star(spark):
    items, orders, returns, customers, products, stores, employees = _star_inputs(spark)
    fact = fact_sales(items, orders, returns, customers, products, stores, employees)
    extra_customer = spark.createDataFrame(
        [(3, 8, "Bo", "Lille", 0, D(2024, 2, 1), D(2024, 2, 1), None, 1)],
        schemas.STAR["dim_customer"])
    return {
        "fact_sales": fact, "dim_customer": customers.unionByName(extra_customer),
        "dim_product": products, "dim_store": stores, "dim_employee": employees,
        "dim_date": dim_date(spark, D(2024, 1, 1), D(2024, 12, 31)),
    }


def test_product_mart_merges_equal_names_and_counts_returned_lines(spark):
    rows = marts.mart_product_performance(_star(spark)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["product_name"], r["units_sold"], r["units_returned"]) == ("Lamp", 7, 2)
    assert r["total_revenue"] == Decimal("600.00")
    assert r["return_rate_pct"] == 50.0 and r["margin_pct"] == 40.0


def test_geography_mart_keeps_cities_without_sales(spark):
    got = {r["city"]: (r["num_customers"], r["total_revenue"])
           for r in marts.mart_customer_geography(_star(spark)).collect()}
    assert got["Paris"] == (1, Decimal("500.00"))
    assert got["Lille"] == (1, None)


def test_zero_revenue_gives_null_percent(spark):
    star = _star(spark)
    star["fact_sales"] = star["fact_sales"].withColumn(
        "line_revenue", star["fact_sales"]["line_revenue"] * 0).withColumn(
        "line_margin", star["fact_sales"]["line_margin"] * 0)
    rows = marts.mart_monthly_revenue(star).collect()
    assert rows and all(r["margin_pct"] is None for r in rows)


def test_employee_rank_ties_share_rank_then_gap(spark):
    from pyspark.sql import functions as F

    star = _star(spark)
    star["dim_employee"] = spark.createDataFrame(
        [(1, 1, "Lea", "Sales Assistant", 1, D(2020, 1, 1)), (2, 2, "Max", "Sales Assistant", 1, D(2020, 1, 1)),
         (3, 3, "Zoe", "Sales Assistant", 1, D(2020, 1, 1)), (4, 4, "Ugo", "Sales Assistant", 1, D(2020, 1, 1))],
        schemas.STAR["dim_employee"])
    fact = star["fact_sales"]
    order2 = fact.where("order_id = 2")   # 300.00 of kept sales

    def copy(employee_key, order_id, scale=1):
        return (order2.withColumn("employee_key", F.lit(employee_key).cast("long"))
                .withColumn("order_id", F.lit(order_id).cast("long"))
                .withColumn("line_revenue", (F.col("line_revenue") * scale).cast("decimal(12,2)")))

    star["fact_sales"] = (fact.unionByName(copy(2, 9)).unionByName(copy(3, 10))
                          .unionByName(copy(4, 11, Decimal("0.5"))))
    got = {r["employee_name"]: r["sales_rank"]
           for r in marts.mart_employee_performance(star).collect()}
    # Lea 500.00; Max and Zoe 300.00 each (tie); Ugo 150.00 after the gap.
    assert got == {"Lea": 1, "Max": 2, "Zoe": 2, "Ugo": 4}
