"""Bulk load by declared schema, views, and hot keys in the SCD2 batch and the
point-in-time join."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from strataform import schemas
from strataform.operators.facts import resolve_customer_as_of
from strataform.operators.scd import scd2_apply
from strataform.plans import marts
from strataform.sources.io import load_source_tables, read_published

D = dt.date


def test_csv_bulk_load_uses_declared_schema(spark):
    folder = tempfile.mkdtemp(prefix="strataform-csv-")
    for name, schema in schemas.SOURCE.items():
        rows = []
        if name == "products":
            rows = [(1, "Laptop Pro 15", 1, Decimal("650.00"), Decimal("1199.00"))]
        if name == "customers":
            rows = [(1, "Ann", None, D(2022, 4, 25), 1)]
        (spark.createDataFrame(rows, schema).coalesce(1).write.option("header", "true")
         .csv(os.path.join(folder, name)))
    loaded = load_source_tables(spark, folder, "csv")
    assert set(loaded) == set(schemas.SOURCE)
    product = loaded["products"].collect()[0]
    assert [(f.name, f.dataType) for f in loaded["products"].schema] == \
        [(f.name, f.dataType) for f in schemas.SOURCE["products"]]
    assert product["unit_cost"] == Decimal("650.00") and product["product_id"] == 1
    customer = loaded["customers"].collect()[0]
    assert customer["city"] is None and customer["signup_date"] == D(2022, 4, 25)


def test_published_marts_read_in_documented_order(spark):
    fact = spark.createDataFrame([
        (1, 20240105, 1, 1, 1, 1, 1, 11, 1, Decimal("10.00"), Decimal("0.00"),
         Decimal("10.00"), Decimal("6.00"), Decimal("4.00"), 0),
        (2, 20240205, 1, 1, 1, 1, 2, 21, 1, Decimal("30.00"), Decimal("0.00"),
         Decimal("30.00"), Decimal("18.00"), Decimal("12.00"), 0),
    ], schemas.STAR["fact_sales"])
    from strataform.operators.dimensions import dim_date
    star = {
        "fact_sales": fact, "dim_date": dim_date(spark, D(2024, 1, 1), D(2024, 12, 31)),
        "dim_store": spark.createDataFrame([(1, 1, "Centre", "Paris", "IDF", D(2019, 1, 1))],
                                           schemas.STAR["dim_store"]),
        "dim_employee": spark.createDataFrame([(1, 1, "Lea", "Sales Assistant", 1, D(2020, 1, 1))],
                                              schemas.STAR["dim_employee"]),
        "dim_product": spark.createDataFrame(
            [(1, 1, "Lamp", "Home", Decimal("6.00"), Decimal("10.00"))],
            schemas.STAR["dim_product"]),
        "dim_customer": spark.createDataFrame(
            [(1, 1, "Ann", "Paris", 1, D(2023, 1, 1), D(2023, 1, 1), None, 1)],
            schemas.STAR["dim_customer"]),
    }
    marts.publish_marts(star)
    monthly = [(r["year"], r["month_number"]) for r in
               marts.read_mart(spark, "mart_monthly_revenue").collect()]
    assert monthly == [(2024, 1), (2024, 2)]
    assert read_published(spark, "mart_product_performance").count() == 1


def test_scd2_with_one_customer_holding_most_changes(spark):
    dim = spark.createDataFrame(
        [(k, k, f"C{k}", "Lyon", 0, D(2020, 1, 1), D(2020, 1, 1), None, 1) for k in range(1, 21)],
        schemas.STAR["dim_customer"])
    hot = [(1, D(2021, 1, 1) + dt.timedelta(days=i), f"City{i % 5}") for i in range(300)]
    cold = [(k, D(2022, 6, 1), "Nice") for k in range(2, 21)]
    changes = spark.createDataFrame(hot + cold, "customer_id long, change_date date, city string")
    out = scd2_apply(dim, changes).where("customer_id = 1").collect()
    assert len(out) == 301
    assert sum(r["is_current"] for r in out) == 1
    chain = sorted((r for r in out if r["customer_key"] > 20), key=lambda r: r["valid_from"])
    assert all(a["valid_to"] == b["valid_from"] - dt.timedelta(days=1)
               for a, b in zip(chain, chain[1:]))
    assert chain[-1]["city"] == "City4" and chain[-1]["valid_to"] is None


def test_as_of_with_one_customer_holding_most_orders(spark):
    versions = spark.createDataFrame([
        (1, 1, "A", "X", 0, D(2020, 1, 1), D(2020, 1, 1), D(2020, 12, 31), 0),
        (2, 1, "A", "Y", 0, D(2020, 1, 1), D(2021, 1, 1), None, 1),
        (3, 2, "B", "Z", 0, D(2020, 1, 1), D(2020, 1, 1), None, 1),
    ], schemas.STAR["dim_customer"])
    orders = spark.createDataFrame(
        [(i, 1, D(2020, 6, 1) + dt.timedelta(days=i % 400)) for i in range(600)]
        + [(1000 + i, 2, D(2021, 3, 1)) for i in range(10)],
        "order_id long, customer_id long, order_date date")
    got = {r["order_id"]: r["customer_key"] for r in
           resolve_customer_as_of(orders, versions).collect()}
    assert len(got) == 610
    for i in range(600):
        day = D(2020, 6, 1) + dt.timedelta(days=i % 400)
        assert got[i] == (1 if day <= D(2020, 12, 31) else 2)
    assert all(got[1000 + i] == 3 for i in range(10))


def test_bucketing_is_reattached_to_written_files(spark):
    from pyspark.sql import functions as F

    from strataform.sources.io import register_bucketed_table, write_bucketed_table

    folder = tempfile.mkdtemp(prefix="strataform-bucket-")
    rows = spark.range(0, 2000).select(F.col("id").alias("order_id"),
                                       (F.col("id") % 7).alias("v"))
    write_bucketed_table(rows, os.path.join(folder, "t"), "default.bk_written", "order_id", 8)
    again = register_bucketed_table(spark, "default.bk_reattached", os.path.join(folder, "t"),
                                    rows.schema, "order_id", 8)
    assert again.count() == 2000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        import io
        from contextlib import redirect_stdout

        joined = again.join(spark.table("default.bk_written"), "order_id")
        buf = io.StringIO()
        with redirect_stdout(buf):
            joined.explain()
        assert "Exchange" not in buf.getvalue()
        assert joined.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

histories = st.lists(
    st.tuples(st.integers(1, 4), st.lists(st.integers(0, 300), min_size=1, max_size=4,
                                          unique=True)),
    min_size=1, max_size=4, unique_by=lambda t: t[0])
order_lists = st.lists(st.tuples(st.integers(1, 5), st.integers(-30, 330)), min_size=1,
                       max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history=histories, order_rows=order_lists)
def test_as_of_matches_a_brute_force_range_join(spark, history, order_rows):
    base = D(2020, 1, 1)
    versions, key = [], 0
    for cid, offsets in history:
        starts = sorted(base + dt.timedelta(days=o) for o in offsets)
        for i, start in enumerate(starts):
            key += 1
            end = starts[i + 1] - dt.timedelta(days=1) if i + 1 < len(starts) else None
            versions.append((key, cid, "n", "c", 0, base, start, end, 1 if end is None else 0))
    orders = [(i, cid, base + dt.timedelta(days=o)) for i, (cid, o) in enumerate(order_rows)]
    expected = {}
    for oid, cid, day in orders:
        hits = [v[0] for v in versions if v[1] == cid and v[6] <= day
                and (v[7] is None or day <= v[7])]
        if hits:
            expected[oid] = hits[0]
    got = {r["order_id"]: r["customer_key"] for r in resolve_customer_as_of(
        spark.createDataFrame(orders, "order_id long, customer_id long, order_date date"),
        spark.createDataFrame(versions, schemas.STAR["dim_customer"])).collect()}
    assert got == expected
