"""Operational source tables derived from the TPC-H-like driver tables.

The driver data has no retail tables, so the eight source tables are derived
from it with the rules below (every rule reads whole tables):

=================  ===========================================================
stores             nation + region: one store per nation, city = nation name
employees          supplier: works at the store of its nation, role by key
categories         distinct ``p_type``; id = position in name order
products           part: price = retail price, cost = 60 % of the price
customers          customer + nation: city = nation name (NULL if no nation)
sales_orders       all orders; employee = smallest supplier key on the order's
                   lines, or the smallest of all for an order without lines
                   (the house account); store = that supplier's nation
sales_order_items  lineitem + part: one item per line, id = position of the
                   line among all lines; price paid = list price less discount
product_returns    one return per line flagged 'R', dated on the ship date
=================  ===========================================================

Scale notes: lines are numbered in one global order (range sort, no group is
gathered), so ids cannot collide however many lines an order has.  The
per-order employee is a map-side ``min``.  Items and returns share one written
numbering of the lines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.ordering import assign_keys
from ..session import written_once
from .io import conform
from .lazy import LazyTables, once

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the derived source data.
ROLES = ["Sales Assistant", "Senior Assistant", "Floor Lead", "Branch Manager"]
STORE_OPENING_DATE = dt.date(1990, 1, 1)
HIRE_DATE_BASE = dt.date(1990, 1, 1)
HIRE_DATE_SPREAD_DAYS = 1461
SIGNUP_DATE_BASE = dt.date(1995, 1, 1)
SIGNUP_DATE_SPREAD_DAYS = 365
LOYALTY_SEGMENT = "HOUSEHOLD"
UNIT_COST_RATIO = Decimal("0.60")
RETURN_FLAG = "R"


def read_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy scans of the driver tables (column pruning reaches the Parquet
    reader).  Their schemas are read from the files, one small job each,
    issued side by side."""
    def scan(table: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")

    with ThreadPoolExecutor(max_workers=len(DRIVER_TABLES)) as pool:
        return dict(zip(DRIVER_TABLES, pool.map(scan, DRIVER_TABLES)))


def stores(t: dict[str, DataFrame]) -> DataFrame:
    n, r = t["nation"], t["region"]
    df = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.lit(STORE_OPENING_DATE).alias("opening_date"))
    return conform(df, schemas.SOURCE["stores"])


def employees(t: dict[str, DataFrame]) -> DataFrame:
    s = t["supplier"]
    roles = F.array(*[F.lit(r) for r in ROLES])
    df = s.select(
        F.col("s_suppkey").alias("employee_id"),
        F.col("s_name").alias("full_name"),
        F.col("s_nationkey").alias("store_id"),
        F.date_add(F.lit(HIRE_DATE_BASE), F.pmod("s_suppkey", F.lit(HIRE_DATE_SPREAD_DAYS)).cast("int"))
        .alias("hire_date"),
        F.element_at(roles, (F.pmod("s_suppkey", F.lit(len(ROLES))) + 1).cast("int")).alias("role"))
    return conform(df, schemas.SOURCE["employees"])


def categories(t: dict[str, DataFrame]) -> DataFrame:
    names = t["part"].select(F.col("p_type").alias("category_name")).distinct()
    return conform(assign_keys(names, "category_id", ["category_name"]),
                   schemas.SOURCE["categories"])


def products(t: dict[str, DataFrame], cats: DataFrame | None = None) -> DataFrame:
    cats = categories(t) if cats is None else cats
    p = t["part"]
    price = F.col("p_retailprice").cast(schemas.MONEY)
    df = p.join(cats, p["p_type"] == cats["category_name"]).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("category_id"),
        F.round(price * F.lit(UNIT_COST_RATIO), 2).alias("unit_cost"),
        price.alias("unit_price"))
    return conform(df, schemas.SOURCE["products"])


def customers(t: dict[str, DataFrame]) -> DataFrame:
    c, n = t["customer"], t["nation"]
    df = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("n_name").alias("city"),
        F.date_add(F.lit(SIGNUP_DATE_BASE),
                   F.pmod("c_custkey", F.lit(SIGNUP_DATE_SPREAD_DAYS)).cast("int")).alias("signup_date"),
        F.when(F.col("c_mktsegment") == LOYALTY_SEGMENT, 1).otherwise(0).alias("loyalty_member"))
    return conform(df, schemas.SOURCE["customers"])


# What order items and returns take from a line; equal lines are interchangeable.
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount",
                "l_returnflag", "l_shipdate"]


def numbered_lines(t: dict[str, DataFrame]) -> DataFrame:
    """Driver lines with their order item id: 1, 2, ... in the order of the
    line's columns."""
    return assign_keys(t["lineitem"].select(*LINE_COLUMNS), "order_item_id", LINE_COLUMNS)


def sales_order_items(t: dict[str, DataFrame], lines: DataFrame | None = None) -> DataFrame:
    lines = numbered_lines(t) if lines is None else lines
    p = t["part"]
    discount = F.col("l_discount").cast(schemas.PERCENT)
    list_price = F.col("p_retailprice").cast(schemas.MONEY)
    df = lines.join(p, lines["l_partkey"] == p["p_partkey"]).select(
        F.col("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(list_price * (F.lit(1) - discount), 2).alias("unit_price_paid"),
        (discount * F.lit(100)).alias("discount_pct"))
    return conform(df, schemas.SOURCE["sales_order_items"])


def product_returns(t: dict[str, DataFrame], lines: DataFrame | None = None) -> DataFrame:
    lines = numbered_lines(t) if lines is None else lines
    df = lines.where(F.col("l_returnflag") == RETURN_FLAG).select(
        F.col("order_item_id").alias("return_id"),
        F.col("order_item_id"),
        F.col("l_shipdate").cast("date").alias("return_date"),
        F.lit(None).cast("string").alias("reason"))
    return conform(df, schemas.SOURCE["product_returns"])


def sales_orders(t: dict[str, DataFrame]) -> DataFrame:
    o, s = t["orders"], t["supplier"]
    seller = t["lineitem"].groupBy("l_orderkey").agg(F.min("l_suppkey").alias("seller"))
    house = s.agg(F.min("s_suppkey")).scalar()
    df = (o.join(seller, o["o_orderkey"] == seller["l_orderkey"], "left")
          .withColumn("employee_id", F.coalesce("seller", house))
          .join(s, F.col("employee_id") == s["s_suppkey"])
          .select(F.col("o_orderkey").alias("order_id"),
                  F.col("o_custkey").alias("customer_id"),
                  F.col("s_nationkey").alias("store_id"),
                  F.col("employee_id"),
                  F.col("o_orderdate").cast("date").alias("order_date"),
                  F.col("o_orderpriority").alias("payment_method")))
    return conform(df, schemas.SOURCE["sales_orders"])


def _builders(t: dict[str, DataFrame], cats: Callable[[], DataFrame],
              lines: Callable[[], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    return {
        "stores": lambda: stores(t),
        "employees": lambda: employees(t),
        "categories": cats,
        "products": lambda: products(t, cats()),
        "customers": lambda: customers(t),
        "sales_orders": lambda: sales_orders(t),
        "sales_order_items": lambda: sales_order_items(t, lines()),
        "product_returns": lambda: product_returns(t, lines()),
    }


def source_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """All eight operational tables over ``sf_dir``, each built on first use;
    the categories and the lines are numbered at most once, and the orders, which
    group all lines, are written once for their many readers."""
    t = read_driver_tables(spark, sf_dir)
    built = _builders(t, once(lambda: categories(t)), once(lambda: numbered_lines(t)))
    orders = built["sales_orders"]
    built["sales_orders"] = lambda: written_once(orders, spark, "sales_orders")
    return LazyTables(built)


def source_tables_now(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same tables with the numbering done by this call, for a job that
    removes its scratch tables at its end."""
    t = read_driver_tables(spark, sf_dir)
    cats, lines = categories(t), numbered_lines(t)
    return {name: build() for name, build in _builders(t, lambda: cats, lambda: lines).items()}
