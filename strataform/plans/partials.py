"""Stored partial aggregates, from which all five marts follow.

For each sales month and the surrogate keys a mart needs, ``partial_tables`` keeps
the sums and counts of the fact, and the distinct orders or customers as bitmaps
(``operators.distinct``).  They can be merged: the partials of new rows are added
to those of the months they fall in, and a month whose old rows changed is
computed again from that month alone.  ``marts_from`` joins them with the
dimensions; its results equal ``marts.MARTS`` over the whole fact.

Names are looked up when a mart is made, so a renamed store or employee shows
under the new name.  A line's cohort is that of its customer version.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import month_bucket
from ..functions.money import money_sum, percent
from ..operators.distinct import count_ids, id_bitmaps, merge_bitmaps
from ..schemas import INT, LONG

MONTH = "sales_month"

# Key (after the month) of each kind of sums, and what it adds up.
SUMS: dict[str, tuple[str, list[str]]] = {
    "by_store": ("store_key", ["revenue", "margin"]),
    "by_cohort": ("cohort_month", ["revenue"]),
    "by_product": ("product_key", ["units", "revenue", "margin", "returned", "lines"]),
    "by_employee": ("employee_key", ["revenue"]),
    "by_customer": ("customer_key", ["revenue"]),
}
# Key of each kind of bitmaps, and the column whose values it holds.
SETS: dict[str, tuple[str, str]] = {
    "orders_by_store": ("store_key", "order_id"),
    "customers_by_cohort": ("cohort_month", "customer_id"),
    "orders_by_employee": ("employee_key", "order_id"),
}
#: The stored tables: all sums together, all bitmaps together, told apart by kind.
PARTIALS = ["sums", "sets"]

_MEASURES: dict[str, tuple[str, T.DataType]] = {
    "revenue": ("line_revenue", T.DecimalType(28, 2)),
    "margin": ("line_margin", T.DecimalType(28, 2)),
    "units": ("quantity", LONG), "returned": ("is_returned", LONG), "lines": ("_one", LONG),
}
_GROUP = [MONTH, "kind", "key", "label"]  # the key is a number, or a label for the cohort


def sales_month() -> Column:
    """yyyymm of the fact's date key."""
    return F.floor(F.col("date_key") / 100).cast("int")


def partial_schema(name: str) -> T.StructType:
    """The columns of a stored table."""
    fields = [(MONTH, INT), ("kind", T.StringType()), ("key", LONG), ("label", T.StringType())]
    fields += ([(m, t) for m, (_, t) in _MEASURES.items()] if name == "sums"
               else [("bucket", LONG), ("bitmap", LONG)])
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _named(key: str) -> list[Column]:
    """A mart's key as the columns key and label."""
    column = F.col(key)
    return ([F.lit(None).cast("bigint").alias("key"), column.alias("label")]
            if key == "cohort_month" else
            [column.alias("key"), F.lit(None).cast("string").alias("label")])


def partial_tables(fact: DataFrame, dim_customer: DataFrame) -> dict[str, DataFrame]:
    """The partial aggregates of the given fact rows.  Only the cohort needs a
    dimension; the products count returned lines, all others leave them out."""
    rows = fact.withColumn(MONTH, sales_month()).withColumn("_one", F.lit(1))
    kept = rows.where(F.col("is_returned") == 0)
    cohorts = dim_customer.select("customer_key", "customer_id",
                                  month_bucket("signup_date").alias("cohort_month"))
    # One row a customer, month before the join with the customers.
    bought = kept.groupBy(MONTH, "customer_key").agg(F.sum("line_revenue").alias("line_revenue"))
    sources = {"by_product": rows, "by_cohort": bought.join(cohorts, "customer_key"),
               "by_customer": bought}
    sources["customers_by_cohort"] = sources["by_cohort"]
    sums, sets = [], []
    for name, (key, measures) in SUMS.items():
        found = sources.get(name, kept).groupBy(MONTH, key).agg(*[
            F.sum(_MEASURES[m][0]).cast(_MEASURES[m][1]).alias(m) for m in measures])
        sums.append(found.select(MONTH, F.lit(name).alias("kind"), *_named(key), *[
            F.col(m) if m in measures else F.lit(None).cast(t).alias(m)
            for m, (_, t) in _MEASURES.items()]))
    for name, (key, ids) in SETS.items():
        found = id_bitmaps(sources.get(name, kept), [MONTH, key], ids)
        sets.append(found.select(MONTH, F.lit(name).alias("kind"), *_named(key), "bucket", "bitmap"))
    return {"sums": reduce(DataFrame.unionByName, sums), "sets": reduce(DataFrame.unionByName, sets)}


def merged(name: str, tables: list[DataFrame]) -> DataFrame:
    """Partials of several batches as one."""
    every = reduce(DataFrame.unionByName, tables)
    if name == "sets":
        return merge_bitmaps(every, _GROUP).select(*every.columns)
    return every.groupBy(*_GROUP).agg(*[
        F.sum(m).cast(t).alias(m) for m, (_, t) in _MEASURES.items()])


def by_kind(partials: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The stored tables as one table for each kind, under its own key."""
    out = {}
    for table, kinds in (("sums", SUMS), ("sets", SETS)):
        for name, (key, what) in kinds.items():
            rows = partials[table].where(F.col("kind") == name)
            value = F.col("label" if key == "cohort_month" else "key").alias(key)
            out[name] = rows.select(MONTH, value, *(what if table == "sums" else ["bucket", "bitmap"]))
    return out


def _monthly(p: Mapping[str, DataFrame], star: Mapping[str, DataFrame]) -> DataFrame:
    months = star["dim_date"].select(sales_month().alias(MONTH), "year", "month_number",
                                     "month_name").distinct()
    stores = star["dim_store"].select("store_key", "store_name", "region")
    names = ["store_name", "region"]
    sums = p["by_store"].join(stores, "store_key").groupBy(MONTH, *names).agg(
        money_sum("revenue").alias("total_revenue"), money_sum("margin").alias("total_margin"))
    orders = count_ids(p["orders_by_store"].join(stores, "store_key"), [MONTH, *names], "num_orders")
    both = _beside(sums, orders, [MONTH, *names]).join(months, MONTH)
    return both.select("year", "month_number", "month_name", *names, "num_orders", "total_revenue",
                       "total_margin", percent(F.col("total_margin"), F.col("total_revenue"), 1)
                       .alias("margin_pct"))


def _cohorts(p: Mapping[str, DataFrame], star: Mapping[str, DataFrame]) -> DataFrame:
    months = star["dim_date"].select(sales_month().alias(MONTH), F.col("year").alias("order_year"),
                                     F.col("month_number").alias("order_month")).distinct()
    keys = ["cohort_month", MONTH]
    sums = p["by_cohort"].groupBy(*keys).agg(money_sum("revenue").alias("cohort_revenue"))
    both = _beside(sums, count_ids(p["customers_by_cohort"], keys, "active_customers"), keys)
    return both.join(months, MONTH).select("cohort_month", "order_year", "order_month",
                                           "active_customers", "cohort_revenue")


def _products(p: Mapping[str, DataFrame], star: Mapping[str, DataFrame]) -> DataFrame:
    names = star["dim_product"].select("product_key", "category_name", "product_name")
    agg = p["by_product"].join(names, "product_key").groupBy("category_name", "product_name").agg(
        F.sum("units").alias("units_sold"), money_sum("revenue").alias("total_revenue"),
        money_sum("margin").alias("total_margin"), F.sum("returned").alias("units_returned"),
        F.sum("lines").alias("_lines"))
    return agg.select(
        "category_name", "product_name", "units_sold", "total_revenue", "total_margin",
        percent(F.col("total_margin"), F.col("total_revenue"), 1).alias("margin_pct"),
        "units_returned",
        percent(F.col("units_returned"), F.col("_lines"), 2).alias("return_rate_pct"))


def _employees(p: Mapping[str, DataFrame], star: Mapping[str, DataFrame]) -> DataFrame:
    names = ["employee_name", "role", "store_name"]
    sellers = star["dim_employee"].select(
        "employee_key", F.col("full_name").alias("employee_name"), "role", "store_key").join(
        star["dim_store"].select("store_key", "store_name"), "store_key").drop("store_key")
    sums = p["by_employee"].join(sellers, "employee_key").groupBy(*names).agg(
        money_sum("revenue").alias("total_sales"))
    orders = count_ids(p["orders_by_employee"].join(sellers, "employee_key"), names,
                       "orders_handled")
    both = _beside(sums, orders, names).select(*names, "orders_handled", "total_sales")
    # One row per seller: ranked in one task.
    return both.withColumn("sales_rank", F.rank().over(Window.orderBy(F.desc("total_sales")))
                           .cast("int"))


def _geography(p: Mapping[str, DataFrame], star: Mapping[str, DataFrame]) -> DataFrame:
    revenue = p["by_customer"].groupBy("customer_key").agg(F.sum("revenue").alias("_rev"))
    current = star["dim_customer"].where(F.col("is_current") == 1).select(
        "customer_key", "customer_id", "city")
    return current.join(revenue, "customer_key", "left").groupBy("city").agg(
        F.count_distinct("customer_id").alias("num_customers"),
        money_sum("_rev").alias("total_revenue"))


def _beside(sums: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and counts of the same groups; a NULL name is a group too."""
    [count] = [c for c in counts.columns if c not in keys]
    other = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(count).alias("_count"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return sums.join(other, same, "left").select(
        *sums.columns, F.coalesce("_count", F.lit(0)).cast("bigint").alias(count))


_FINISH = {
    "mart_monthly_revenue": _monthly,
    "mart_customer_cohorts": _cohorts,
    "mart_product_performance": _products,
    "mart_employee_performance": _employees,
    "mart_customer_geography": _geography,
}


def marts_from(partials: Mapping[str, DataFrame], star: Mapping[str, DataFrame]
               ) -> dict[str, DataFrame]:
    """The five marts; of ``star`` only the dimensions are read."""
    kinds = by_kind(partials)
    return {name: finish(kinds, star) for name, finish in _FINISH.items()}
