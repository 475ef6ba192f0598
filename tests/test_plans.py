"""Plan-shape regressions over a built warehouse (see PLANS.md)."""

import io
import re
from contextlib import redirect_stdout

import pytest

from strataform import schemas
from strataform.operators.facts import fact_sales
from strataform.plans import marts
from strataform.plans.warehouse import BUCKETED, build_database
from strataform.sources.io import conform, read_table, table_path


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _scan_details(plan: str, marker: str) -> str:
    """The detail block of the first scan whose header line contains ``marker``."""
    blocks = re.split(r"\n(?=\(\d+\) )", plan)
    for block in blocks:
        header = block.splitlines()[0]
        if header.startswith("(") and "Scan" in header and marker in header:
            return block
    for block in blocks:  # unnamed file scans: match on the location
        if block.splitlines()[0].startswith("(") and "Scan" in block and marker in block:
            return block
    raise AssertionError(f"no scan of {marker}")


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _star(spark, root):
    star = {n: read_table(spark, table_path(root, "star", n), schemas.STAR[n])
            for n in ("dim_date", "dim_store", "dim_employee", "dim_product", "fact_sales")}
    star["dim_customer"] = read_table(spark, table_path(root, "star", "dim_customer_v2"),
                                      schemas.STAR["dim_customer"])
    return star


def test_fact_load_reads_lines_from_buckets_without_exchange(spark, built_root, no_broadcast):
    root, _ = built_root
    db = build_database(spark, root)
    stg = {n: conform(spark.table(f"{db}.{n}"), schemas.STAGING[n]) for n in BUCKETED}
    stg["stg_product_returns"] = read_table(
        spark, table_path(root, "staging", "stg_product_returns"),
        schemas.STAGING["stg_product_returns"])
    star = _star(spark, root)
    initial = read_table(spark, table_path(root, "star", "dim_customer"),
                         schemas.STAR["dim_customer"])
    plan = _plan(fact_sales(stg["stg_sales_order_items"], stg["stg_sales_orders"],
                            stg["stg_product_returns"], initial, star["dim_product"],
                            star["dim_store"], star["dim_employee"]))
    lines_scan = _scan_details(plan, "stg_sales_order_items")
    assert "Bucketed: true" in lines_scan
    # The lines go Scan -> Filter -> Sort -> SortMergeJoin(order_id): no Exchange between.
    tree = plan.split("\n\n")[0]
    lines_at = next(i for i, line in enumerate(tree.splitlines()) if "stg_sales_order_items" in line)
    above = tree.splitlines()[max(0, lines_at - 3):lines_at]
    assert not any("Exchange" in line for line in above), above
    # The current customer versions come from their own partition.
    assert "(is_current" in _scan_details(plan, "star/dim_customer]")


def test_marts_push_filters_and_prune_columns(spark, built_root):
    root, _ = built_root
    star = _star(spark, root)
    monthly = _plan(marts.mart_monthly_revenue(star))
    fact_scan = _scan_details(monthly, "fact_sales")
    assert "EqualTo(is_returned,0)" in fact_scan
    read = re.search(r"ReadSchema: struct<(.*)>", fact_scan).group(1)
    assert sorted(re.findall(r"(\w+):", read)) == sorted(
        ["date_key", "store_key", "order_id", "line_revenue", "line_margin", "is_returned"])
    geo = _plan(marts.mart_customer_geography(star))
    assert "PartitionFilters: [isnotnull(is_current" in _scan_details(geo, "dim_customer_v2")
