"""The order-line fact table and its customer-key resolution modes.

Join plan (written in this order on purpose; Spark does not reorder joins
without cost-based optimisation):

1. order headers resolve customer, store and employee keys on their own -
   the header table is several times smaller than the lines, so any shuffle
   these joins need moves headers, not lines;
2. lines join headers on ``order_id`` first: when both staged tables are
   bucketed on ``order_id`` (as ``run_build`` writes them) the lines are not
   shuffled at all (only headers, if a dimension join re-partitioned them);
3. then the product key and unit cost (a broadcast when ``dim_product`` is
   small, else one shuffle of the lines on ``product_id``);
4. returns are reduced to one row per order line (a count, combined
   map-side) and joined last, so a line returned many times is never a hot
   join key; the fact row is then repeated once per return, as the row-level
   outer join of the source does.

Staged tables that are not bucketed move the lines for every shuffle join; then
``headers_last`` joins products first (the derived lines still lie by product),
then returns while the rows are narrow, and the four keys of the header last,
so that no shuffle moves them.

Dimension sides are broadcast only when their files are very small or their
measured size is under the session's bound (``session.bound_broadcasts``);
otherwise the join stays a shuffle join and adaptive execution splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.calendar import date_key
from ..functions.money import flag, line_amount, line_margin
from ..sources.io import conform
from .ordering import carry_forward
from .skew import heavy_keys, spread_join


def resolve_customer_current(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customer key of the *current* version (what the load does)."""
    current = dim_customer.where(F.col("is_current") == 1).select("customer_id", "customer_key")
    return orders.join(current, "customer_id")


def resolve_customer_as_of(orders: DataFrame, dim_customer: DataFrame,
                           open_first_version: bool = False,
                           date_col: str = "order_date") -> DataFrame:
    """Point-in-time key: the customer version valid on the order date.

    Semantics: among the customer's versions with a non-empty validity
    interval and ``valid_from <= date``, take the latest (greatest
    ``valid_from``, then greatest key); the order resolves when that version
    is still open on the date (``valid_to`` NULL or ``>= date``).  For a
    well-formed history this is exactly the range join
    ``valid_from <= date <= valid_to``.  With ``open_first_version`` the
    oldest version also covers every date before it, so orders placed before
    the signup date resolve too.

    Computed as a merge of versions and orders in one global order
    ``(customer_id, date, versions first)``, in which the last version before
    each order is carried forward (``carry_forward``): no join by customer, so
    the number of versions or orders of a customer does not matter, and one
    written table.
    """
    versions = dim_customer.where(
        F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("valid_from"))
    ).select("customer_id", "customer_key", "valid_from", "valid_to")
    start = F.col("valid_from")
    if open_first_version:
        first = versions.groupBy("customer_id").agg(F.min("valid_from").alias("_sf_first"))
        versions = versions.join(first, "customer_id")
        # NULL sorts before every date: the first version is open on the left.
        start = F.when(F.col("valid_from") == F.col("_sf_first"),
                       F.lit(None).cast("date")).otherwise(F.col("valid_from"))
    payload = [c for c in orders.columns if c != "customer_id"]
    typed_nulls = {c: F.lit(None).cast(t) for c, t in orders.dtypes if c != "customer_id"}
    ev_versions = versions.select(
        "customer_id", start.alias("_sf_t"), F.lit(0).alias("_sf_kind"),
        F.col("customer_key").alias("_sf_vkey"), F.col("valid_to").alias("_sf_vto"),
        *[typed_nulls[c].alias(c) for c in payload])
    ev_orders = orders.select(
        "customer_id", F.col(date_col).alias("_sf_t"), F.lit(1).alias("_sf_kind"),
        F.lit(None).cast("bigint").alias("_sf_vkey"), F.lit(None).cast("date").alias("_sf_vto"),
        *payload)
    events = ev_versions.unionByName(ev_orders)
    tie = [c for c in ("order_id",) if c in payload]
    carried = carry_forward(
        events.withColumns({"_sf_is_version": F.col("_sf_kind") == 0,
                            "_sf_vcid": F.col("customer_id")}),
        ["customer_id", "_sf_t", "_sf_kind", "_sf_vkey", *tie], "_sf_is_version",
        {"_sf_vcid": "_sf_last_id", "_sf_vkey": "_sf_last_key", "_sf_vto": "_sf_last_to"})
    hit = carried.where(
        (F.col("_sf_kind") == 1) & (F.col("customer_id") == F.col("_sf_last_id"))
        & (F.col("_sf_last_to").isNull() | (F.col(date_col) <= F.col("_sf_last_to"))))
    return hit.select(*orders.columns, F.col("_sf_last_key").alias("customer_key"))


def fact_sales(stg_items: DataFrame, stg_orders: DataFrame, stg_returns: DataFrame,
               dim_customer: DataFrame, dim_product: DataFrame, dim_store: DataFrame,
               dim_employee: DataFrame, *, key_mode: str = "current",
               open_first_version: bool = False, dedupe_returns: bool = False,
               with_fact_id: bool = True, fact_id_start: int = 0,
               heavy_parts: int | None = None, headers_last: bool = False) -> DataFrame:
    """Build ``fact_sales`` at order-line grain.

    Lines whose order, customer, product, store or employee do not resolve are
    dropped (inner joins, as in the load); ``quality`` counts them.
    ``fact_id`` is unique but not dense (the source's keys are not dense
    either, and nothing reads it); ``fact_id_start`` continues the ids of
    earlier loads.  With ``heavy_parts`` given, the lines of orders that hold more
    than that part of all lines are spread over as many shares for the join to
    their header (one more pass over the order ids finds them).  ``headers_last``
    is for staged tables that are not bucketed (see the join plan above); the rows
    are the same.
    """
    headers = stg_orders.select("order_id", "customer_id", "store_id", "employee_id", "order_date")
    if key_mode == "current":
        headers = resolve_customer_current(headers, dim_customer)
    elif key_mode == "as_of":
        headers = resolve_customer_as_of(headers, dim_customer, open_first_version)
    else:
        raise ValueError("key_mode must be 'current' or 'as_of'")
    headers = (headers
               .join(dim_store.select("store_id", "store_key"), "store_id")
               .join(dim_employee.select("employee_id", "employee_key"), "employee_id")
               .select("order_id", date_key("order_date").alias("date_key"),
                       "customer_key", "store_key", "employee_key"))

    lines = stg_items.select("order_item_id", "order_id", "product_id", "quantity",
                             "unit_price_paid", "discount_pct")
    products = dim_product.select("product_id", "product_key", "unit_cost")
    returns = stg_returns.where(F.col("order_item_id").isNotNull()).groupBy("order_item_id").agg(
        F.count(F.lit(1)).alias("_sf_returns"))

    def with_headers(rows: DataFrame) -> DataFrame:
        if heavy_parts is None:
            return rows.join(headers, "order_id")
        heavy = heavy_keys(stg_items.select("order_id"), "order_id", heavy_parts)
        return spread_join(rows, headers, "order_id", heavy, "order_item_id", heavy_parts)

    if headers_last:
        lines = with_headers(lines.join(products, "product_id").drop("product_id")
                             .join(returns, "order_item_id", "left"))
    else:
        lines = with_headers(lines).join(products, "product_id").join(
            returns, "order_item_id", "left")
    copies = F.col("_sf_returns") if not dedupe_returns else F.least(F.col("_sf_returns"), F.lit(1))
    lines = (lines.withColumn("_sf_copy", F.explode(F.sequence(F.lit(1), F.coalesce(copies, F.lit(1)))))
             .withColumn("is_returned", flag(F.col("_sf_returns").isNotNull())))

    fact = lines.select(
        "date_key", "customer_key", "product_key", "store_key", "employee_key",
        "order_id", "order_item_id", "quantity", "unit_price_paid", "discount_pct",
        line_amount("quantity", "unit_price_paid").alias("line_revenue"),
        line_amount("quantity", "unit_cost").alias("line_cost"),
        line_margin("quantity", "unit_price_paid", "unit_cost").alias("line_margin"),
        "is_returned")
    fact = fact.withColumn("fact_id", F.monotonically_increasing_id() + F.lit(fact_id_start))
    out = conform(fact, schemas.STAR["fact_sales"])
    return out if with_fact_id else out.drop("fact_id")
