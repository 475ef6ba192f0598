"""Star-schema dimensions built from the staging layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.calendar import calendar_columns
from ..sources.io import conform
from .ordering import assign_keys


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per calendar day in [start, end] (inclusive).

    Days are generated by ``spark.range`` (split across tasks), then each row
    derives its nine calendar columns.
    """
    days = (end - start).days + 1
    if days <= 0:
        raise ValueError(f"empty calendar: {start} .. {end}")
    seq = spark.range(0, days)
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return conform(seq.select(*calendar_columns(d)), schemas.STAR["dim_date"])


def calendar_bounds(orders: DataFrame, date_col: str = "order_date") -> tuple[dt.date, dt.date]:
    """Whole calendar years covering every order date (two scalars)."""
    row = orders.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    if row is None or row["lo"] is None:
        raise ValueError("no order dates: give the calendar's first and last day")
    return dt.date(row["lo"].year, 1, 1), dt.date(row["hi"].year, 12, 31)


def dim_date_for_orders(spark: SparkSession, stg_orders: DataFrame,
                        calendar: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """The calendar between two given days; without them, the whole years of the
    orders (check Q05 can then not fail)."""
    start, end = calendar or calendar_bounds(stg_orders)
    return dim_date(spark, start, end)


def dim_store(stg_stores: DataFrame) -> DataFrame:
    """SCD1 store dimension: staging copy plus a surrogate key."""
    cols = ["store_id", "store_name", "city", "region", "opening_date"]
    return conform(assign_keys(stg_stores.select(*cols), "store_key", ["store_id"]),
                   schemas.STAR["dim_store"])


def dim_employee(stg_employees: DataFrame, dim_store_df: DataFrame) -> DataFrame:
    """Employees with their store's surrogate key (inner join: an employee of an
    unknown store is not loaded)."""
    stores = dim_store_df.select("store_id", "store_key")
    joined = stg_employees.join(stores, "store_id").select(
        "employee_id", "full_name", "role", "store_key", "hire_date")
    return conform(assign_keys(joined, "employee_key", ["employee_id"]),
                   schemas.STAR["dim_employee"])


def dim_product(stg_products: DataFrame, stg_categories: DataFrame) -> DataFrame:
    """Products denormalised with their category name."""
    cats = stg_categories.select("category_id", "category_name")
    joined = stg_products.join(cats, "category_id").select(
        "product_id", "product_name", "category_name", "unit_cost", "unit_price")
    return conform(assign_keys(joined, "product_key", ["product_id"]),
                   schemas.STAR["dim_product"])


def dim_customer_initial(stg_customers: DataFrame) -> DataFrame:
    """SCD2 initial load: one open version per customer, valid from signup."""
    first = stg_customers.select(
        "customer_id", "full_name", "city", "loyalty_member", "signup_date",
        F.col("signup_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(1).alias("is_current"))
    return conform(assign_keys(first, "customer_key", ["customer_id"]),
                   schemas.STAR["dim_customer"])
