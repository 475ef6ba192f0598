"""End to end: the audited layered build, the checks, the driver contract and
every registered query against its DuckDB statement (sf0.001)."""

import datetime as dt
import decimal
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import sql_oracle
from tests.conftest import SF_SMALL
from strataform.plans.quality import evaluate_checks
from strataform.plans.warehouse import derive_warehouse

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_run_build_writes_every_layer_and_passes_checks(spark, built_root):
    out, audit = built_root
    assert list(audit) == ["source", "extract", "dimensions", "changes", "fact", "scd2", "marts",
                           "checks", "total"]
    assert all(r["status"] == "OK" for r in audit.values())
    checks = spark.read.parquet(os.path.join(out, "audit", "checks")).collect()
    assert len(checks) == 26 and all(r["passed"] for r in checks)
    counts = {r["table_name"]: r["row_count"]
              for r in spark.read.parquet(os.path.join(out, "audit", "row_counts")).collect()}
    assert counts["fact_sales"] == counts["stg_sales_order_items"] == 6000
    assert spark.read.parquet(os.path.join(out, "star", "dim_customer_v2")).count() == \
        counts["dim_customer"]


def test_checks_detect_an_orphan_key(spark):
    wh = derive_warehouse(spark, SF_SMALL)
    star = dict(wh.star_after)
    star["dim_product"] = star["dim_product"].where(F.col("product_key") != 1)
    failed = {r[0] for r in evaluate_checks(wh.source, wh.staging, star, wh.changes)
              if not r[3]}
    assert "Q07" in failed


def test_entry_and_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "month_number", "month_name", "store_name", "region",
                          "num_orders", "total_revenue", "total_margin", "margin_pct"]
    assert set(sql_oracle.oracle_statements()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(sql_oracle.oracle_statements()))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _bag(df.columns, rows) == _bag(d_cols, res.fetchall())


def test_checks_detect_staged_orphans_and_missing_values(spark):
    wh = derive_warehouse(spark, SF_SMALL)
    staging = dict(wh.staging)
    first_store = staging["stg_employees"].agg(F.min("store_id")).first()[0]
    staging["stg_stores"] = staging["stg_stores"].where(F.col("store_id") != first_store)
    staging["stg_products"] = staging["stg_products"].withColumn(
        "unit_cost", F.when(F.col("product_id") == 1, F.lit(None)).otherwise(F.col("unit_cost")))
    failed = {r[0] for r in evaluate_checks(wh.source, staging, wh.star_after, wh.changes)
              if not r[3]}
    assert {"Q19e", "Q19f"} <= failed


def test_command_line_prints_marts_of_a_build(spark, built_root, monkeypatch, capsys):
    import strataform.__main__ as cli

    root = built_root[0].rpartition("/runs/")[0]
    monkeypatch.setattr("sys.argv", ["strataform", "marts", "--out", root])
    cli.main()
    out = capsys.readouterr().out
    assert "== mart_monthly_revenue" in out and "== mart_customer_geography" in out
    assert "margin_pct" in out and "sales_rank" in out
