"""The five analytical marts, read from the star schema only.

Each mart is a function ``star -> DataFrame`` (``star`` maps table names to
DataFrames), published as a view by ``publish_marts``.  Where the grouping
allows it exactly, the fact is aggregated on its foreign key *before* the
dimension join, so the large table is reduced map-side and the join sees one
row per key instead of one per order line:

* product mart: per ``product_key`` sums and counts, then regrouped by name;
* customer geography: per ``customer_key`` revenue, then by city;
* cohorts: per ``(customer_key, date_key)`` revenue, then by cohort;
* employee ranking: employees and stores are joined first, then revenue per
  seller and order, then by seller (each order counted once).

Sums of decimals are exact, so regrouping partial sums gives the same value as
one sum over the joined rows.  The monthly mart joins two calendar- and
store-sized dimensions and lets Spark aggregate partially.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_bucket
from ..functions.money import money_sum, percent
from ..operators.ordering import rank_in_order
from ..sources.io import publish

# Documented read order of each mart ("-" marks a descending column).
MART_ORDER = {
    "mart_monthly_revenue": ["year", "month_number"],
    "mart_customer_cohorts": ["cohort_month", "order_year", "order_month"],
    "mart_product_performance": ["-total_revenue"],
    "mart_employee_performance": ["sales_rank"],
    "mart_customer_geography": ["-total_revenue"],
}


def _kept_sales(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("is_returned") == 0)


def mart_monthly_revenue(star: dict[str, DataFrame]) -> DataFrame:
    """Revenue, margin and distinct orders by month and store (returns excluded)."""
    f = _kept_sales(star["fact_sales"]).select(
        "date_key", "store_key", "order_id", "line_revenue", "line_margin")
    d = star["dim_date"].select("date_key", "year", "month_number", "month_name")
    s = star["dim_store"].select("store_key", "store_name", "region")
    grouped = f.join(d, "date_key").join(s, "store_key").groupBy(
        "year", "month_number", "month_name", "store_name", "region")
    return grouped.agg(
        F.count_distinct("order_id").alias("num_orders"),
        money_sum("line_revenue").alias("total_revenue"),
        money_sum("line_margin").alias("total_margin"),
    ).withColumn("margin_pct", percent(F.col("total_margin"), F.col("total_revenue"), 1))


def mart_customer_cohorts(star: dict[str, DataFrame]) -> DataFrame:
    """Distinct customers and revenue by signup month and order month, over all
    customer versions (returns excluded)."""
    per_day = _kept_sales(star["fact_sales"]).groupBy("customer_key", "date_key").agg(
        F.sum("line_revenue").alias("_rev"))
    d = star["dim_date"].select("date_key", F.col("year").alias("order_year"),
                                F.col("month_number").alias("order_month"))
    c = star["dim_customer"].select("customer_key", "customer_id",
                                    month_bucket("signup_date").alias("cohort_month"))
    return (per_day.join(d, "date_key").join(c, "customer_key")
            .groupBy("cohort_month", "order_year", "order_month")
            .agg(F.count_distinct("customer_id").alias("active_customers"),
                 money_sum("_rev").alias("cohort_revenue")))


def mart_product_performance(star: dict[str, DataFrame]) -> DataFrame:
    """Units, revenue, margin and return rate by category and product name
    (returned lines included; equal names merge)."""
    per_product = star["fact_sales"].groupBy("product_key").agg(
        F.sum("quantity").alias("_units"),
        F.sum("line_revenue").alias("_rev"),
        F.sum("line_margin").alias("_margin"),
        F.sum("is_returned").alias("_returned"),
        F.count(F.lit(1)).alias("_lines"))
    p = star["dim_product"].select("product_key", "category_name", "product_name")
    agg = per_product.join(p, "product_key").groupBy("category_name", "product_name").agg(
        F.sum("_units").cast("bigint").alias("units_sold"),
        money_sum("_rev").alias("total_revenue"),
        money_sum("_margin").alias("total_margin"),
        F.sum("_returned").cast("bigint").alias("units_returned"),
        F.sum("_lines").alias("_lines"))
    return agg.select(
        "category_name", "product_name", "units_sold", "total_revenue", "total_margin",
        percent(F.col("total_margin"), F.col("total_revenue"), 1).alias("margin_pct"),
        "units_returned",
        percent(F.col("units_returned"), F.col("_lines"), 2).alias("return_rate_pct"))


def mart_employee_performance(star: dict[str, DataFrame]) -> DataFrame:
    """Distinct orders, sales and global sales rank (ties share a rank, then a
    gap) by employee name, role and the employee's store (returns excluded)."""
    e = star["dim_employee"].select("employee_key", F.col("full_name").alias("employee_name"),
                                    "role", "store_key")
    s = star["dim_store"].select("store_key", "store_name")
    names = ["employee_name", "role", "store_name"]
    sellers = e.join(s, "store_key").select("employee_key", *names)
    # The fact is shuffled once, reduced to one row per seller and order.
    per_order = (_kept_sales(star["fact_sales"]).select("employee_key", "order_id", "line_revenue")
                 .join(sellers, "employee_key").groupBy(*names, "order_id")
                 .agg(F.sum("line_revenue").alias("_rev")))
    agg = per_order.groupBy(*names).agg(F.count("order_id").alias("orders_handled"),
                                        money_sum("_rev").alias("total_sales"))
    # One row per seller: ranked in one task.
    return agg.withColumn("sales_rank", F.rank().over(Window.orderBy(F.desc("total_sales")))
                          .cast("int"))


def mart_customer_geography(star: dict[str, DataFrame]) -> DataFrame:
    """Customers (current versions) and their revenue by city; customers
    without sales count, and a city without sales has NULL revenue."""
    per_key = _kept_sales(star["fact_sales"]).groupBy("customer_key").agg(
        F.sum("line_revenue").alias("_rev"))
    current = star["dim_customer"].where(F.col("is_current") == 1).select(
        "customer_key", "customer_id", "city")
    return current.join(per_key, "customer_key", "left").groupBy("city").agg(
        F.count_distinct("customer_id").alias("num_customers"),
        money_sum("_rev").alias("total_revenue"))


def top_product(star: dict[str, DataFrame], n: int = 1) -> DataFrame:
    """``ORDER BY total_revenue DESC LIMIT n`` on the product mart (a top-k:
    each partition keeps its best n, then they are merged)."""
    return (mart_product_performance(star)
            .orderBy(F.desc("total_revenue"), "category_name", "product_name")
            .limit(n).select("category_name", "product_name", "total_revenue"))


MARTS = {
    "mart_monthly_revenue": mart_monthly_revenue,
    "mart_customer_cohorts": mart_customer_cohorts,
    "mart_product_performance": mart_product_performance,
    "mart_employee_performance": mart_employee_performance,
    "mart_customer_geography": mart_customer_geography,
}


def publish_marts(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Publish every mart as a view (``CREATE OR REPLACE VIEW``)."""
    return {name: publish(build(star), name) for name, build in MARTS.items()}


def ordered_mart(star: dict[str, DataFrame], name: str) -> DataFrame:
    """The published mart read back in its documented order, with the row's
    place in it (``position``, rows of equal order share one).  Rows are placed by
    ranges of the order, not in one task; ties are dealt by the other columns."""
    mart = publish(MARTS[name](star), name)
    order = MART_ORDER[name]
    others = [c for c in mart.columns if c not in {o.lstrip("-") for o in order}]
    return rank_in_order(mart, order, "position", others).orderBy("position")


def read_mart(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT * FROM mart ORDER BY ..`` with the mart's documented order."""
    cols = [F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in MART_ORDER[name]]
    return spark.table(name).orderBy(*cols)
