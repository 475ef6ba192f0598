"""Sources, strict loads, publishing and further batches."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from strataform import schemas
from strataform.operators.facts import resolve_customer_as_of
from strataform.operators.scd import scd1_upsert, scd2_apply
from strataform.operators.staging import extract
from strataform.plans import increments, warehouse
from strataform.plans.quality import evaluate_checks
from strataform.sources import driver_tables
from strataform.sources.io import conform, load_source_tables, read_jdbc, write_bucketed_table
from strataform.sources.published import published, published_table

D = dt.date


def test_an_order_of_many_lines_leaves_its_neighbour_alone(spark):
    lines = spark.range(130).select(
        F.when(F.col("id") < 120, 1).otherwise(2).cast("bigint").alias("l_orderkey"),
        F.col("id").alias("l_linenumber"), F.lit(1).cast("bigint").alias("l_partkey"),
        F.lit(1.0).alias("l_quantity"), F.lit(0.0).alias("l_discount"),
        F.when(F.col("id") < 120, "R").otherwise("N").alias("l_returnflag"),
        F.lit(D(1995, 1, 1)).alias("l_shipdate"))
    part = spark.createDataFrame([(1, 10.0)], "p_partkey bigint, p_retailprice double")
    tables = {"lineitem": lines, "part": part}
    numbered = driver_tables.numbered_lines(tables)
    items = driver_tables.sales_order_items(tables, numbered)
    returns = driver_tables.product_returns(tables, numbered)
    assert items.select("order_item_id").distinct().count() == 130
    returned = items.join(returns, "order_item_id").groupBy("order_id").count().collect()
    assert [(r.order_id, r["count"]) for r in returned] == [(1, 120)]


def test_orders_without_lines_stay(spark):
    source = driver_tables.source_tables(spark, SF_SMALL)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert source["sales_orders"].count() == orders.count()
    bare = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left_anti")
    assert bare.count() > 0
    house = spark.read.parquet(f"{SF_SMALL}/supplier.parquet").agg(F.min("s_suppkey")).first()[0]
    credited = source["sales_orders"].join(
        bare.select(F.col("o_orderkey").alias("order_id")), "order_id")
    assert {r.employee_id for r in credited.collect()} == {house}


def test_as_of_keys_stay_exact_beyond_53_bits(spark):
    big = 9007199254740993
    versions = spark.createDataFrame(
        [(big + 4, big, D(2020, 1, 1), D(2020, 5, 31)), (big + 6, big, D(2020, 6, 1), None),
         (big + 8, big + 2, D(2020, 1, 1), None)],
        "customer_key bigint, customer_id bigint, valid_from date, valid_to date")
    orders = spark.createDataFrame(
        [(big, big, D(2020, 3, 1)), (big + 2, big, D(2020, 7, 1)), (big + 4, big + 2, D(2021, 1, 1)),
         (big + 6, big, D(2019, 1, 1)), (big + 8, None, D(2021, 1, 1))],
        "order_id bigint, customer_id bigint, order_date date")
    got = resolve_customer_as_of(orders, versions).collect()
    assert sorted((r.order_id, r.customer_id, r.customer_key) for r in got) == [
        (big, big, big + 4), (big + 2, big, big + 6), (big + 4, big + 2, big + 8)]


def test_a_small_table_builds_no_fact_and_new_input_is_seen(spark, tmp_path, monkeypatch):
    sf = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, sf)
    for f in glob.glob(f"{sf}/*"):
        os.chmod(f, 0o644)
    os.chmod(sf, 0o755)
    monkeypatch.setattr(warehouse, "fact_sales", lambda *a, **k: pytest.fail("fact built"))
    assert warehouse.derive_warehouse(spark, sf).staging["stg_stores"].count() == 25
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet").limit(20).toPandas()
    nation.to_parquet(f"{sf}/nation.parquet")
    assert warehouse.derive_warehouse(spark, sf).staging["stg_stores"].count() == 20


@pytest.fixture(scope="module")
def exported(spark, tmp_path_factory):
    """The eight source tables as CSV files with a header."""
    folder = str(tmp_path_factory.mktemp("export"))
    for name, df in driver_tables.source_tables(spark, SF_SMALL).items():
        df.coalesce(1).write.csv(f"{folder}/{name}", header=True)
    return folder


@pytest.fixture(scope="module")
def from_csv(spark, exported, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    warehouse.run_build(spark, None, root, sources=load_source_tables(spark, exported, "csv"))
    return root


def test_build_from_csv_equals_build_from_driver_tables(spark, from_csv, built_root):
    for table in ("fact_sales", "dim_customer"):
        stored = "dim_customer_v2" if table == "dim_customer" else table
        a = published_table(spark, from_csv, "star", table, schemas.STAR[table])
        b = conform(spark.read.parquet(os.path.join(built_root[0], "star", stored)),
                    schemas.STAR[table])
        assert a.drop("fact_id").exceptAll(b.drop("fact_id")).count() == 0
        assert a.count() == b.count()


def _broken(exported, tmp_path, change):
    folder = str(tmp_path / "broken")
    shutil.copytree(exported, folder)
    [file] = glob.glob(f"{folder}/stores/*.csv")
    os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
    with open(file) as f:
        lines = f.read().splitlines()
    with open(file, "w") as f:
        f.write("\n".join(change(lines)))
    return folder


@pytest.mark.parametrize("change", [
    lambda x: [x[0], x[1].replace(x[1].split(",")[0], "abc", 1), *x[2:]],
    lambda x: ["store_id,city,store_name,region,opening_date", *x[1:]],
    lambda x: [line.rpartition(",")[0] for line in x],
], ids=["bad cell", "swapped header", "missing column"])
def test_strict_csv(spark, exported, tmp_path, change):
    folder = _broken(exported, tmp_path, change)
    with pytest.raises(Exception):
        load_source_tables(spark, folder, "csv")["stores"].collect()


def test_conform_and_jdbc_refuse_what_is_missing(spark):
    with pytest.raises(ValueError, match="missing columns: city"):
        conform(spark.range(1).selectExpr("id store_id", "'x' store_name", "'r' region",
                                          "current_date() opening_date"), schemas.SOURCE["stores"])
    with pytest.raises(ValueError, match="split read"):
        read_jdbc(spark, "jdbc:none", "t", schemas.SOURCE["stores"], partition_column="store_id")


def test_a_failing_check_leaves_the_published_tables(spark, from_csv, exported):
    before = published(spark, from_csv)
    sources = dict(load_source_tables(spark, exported, "csv"))
    sources["sales_order_items"] = sources["sales_order_items"].unionByName(
        sources["sales_order_items"].limit(1))
    with pytest.raises(RuntimeError, match="Q19"):
        warehouse.run_build(spark, None, from_csv, sources=sources)
    assert published(spark, from_csv) == before


def test_a_replayed_batch_and_appended_sales(spark, from_csv):
    [customer] = increments.published_star(spark, from_csv)["dim_customer"].where(
        "is_current = 1").orderBy("customer_id").limit(1).collect()
    had = increments.published_star(spark, from_csv)["dim_customer"].where(
        F.col("customer_id") == customer.customer_id).count()
    for day, city in ((D(2001, 1, 1), "Here"), (D(2001, 2, 1), "There")):
        increments.apply_batch(spark, from_csv, spark.createDataFrame(
            [(customer.customer_id, day, city)], "customer_id bigint, change_date date, city string"))
    star = increments.published_star(spark, from_csv)
    versions = star["dim_customer"].where(
        F.col("customer_id") == customer.customer_id).orderBy("valid_from").collect()
    assert len(versions) == had + 2 and versions[-1].city == "There"
    assert versions[-2].valid_to == D(2001, 1, 31) and sum(v.is_current for v in versions) == 1
    # Sales: the ids go on, and a second load of the same lines fails.
    fact = star["fact_sales"]
    largest, rows = fact.agg(F.max("fact_id"), F.count(F.lit(1))).first()
    some = fact.limit(1).first()
    product = star["dim_product"].where(F.col("product_key") == some.product_key).first()
    store = star["dim_store"].where(F.col("store_key") == some.store_key).first()
    seller = star["dim_employee"].where(F.col("employee_key") == some.employee_key).first()
    day = star["dim_date"].where(F.col("date_key") == some.date_key).first().full_date
    new = {
        "sales_orders": [(10 ** 9, customer.customer_id, store.store_id, seller.employee_id, day, "x")],
        "sales_order_items": [(10 ** 9, 10 ** 9, product.product_id, 2, some.unit_price_paid,
                               some.discount_pct)],
        "product_returns": [],
    }
    staged = {n: extract(spark.createDataFrame(r, schemas.SOURCE[n]), n) for n, r in new.items()}
    args = [staged["sales_order_items"], staged["sales_orders"], staged["product_returns"]]
    assert increments.append_sales(spark, from_csv, *args) == 1
    grown = increments.published_star(spark, from_csv)["fact_sales"]
    assert grown.count() == rows + 1 and grown.agg(F.max("fact_id")).first()[0] > largest
    with pytest.raises(RuntimeError, match="already loaded"):
        increments.append_sales(spark, from_csv, *args)


def test_one_file_a_bucket(spark, tmp_path):
    rows = spark.range(0, 5000, numPartitions=20).select(F.col("id").alias("order_id"))
    write_bucketed_table(rows, str(tmp_path / "t"), "default.bk_files", "order_id", 8)
    assert len(glob.glob(str(tmp_path / "t" / "part-*"))) == 8


def test_same_day_changes_do_not_depend_on_their_order(spark):
    dim = spark.createDataFrame(
        [(1, 7, "N", "Old", 0, D(2020, 1, 1), D(2020, 1, 1), None, 1)], schemas.STAR["dim_customer"])
    rows = [(7, D(2021, 1, 1), "B"), (7, D(2021, 1, 1), "A")]
    schema = "customer_id bigint, change_date date, city string"
    results = [sorted(map(tuple, scd2_apply(dim, spark.createDataFrame(r, schema)).collect()), key=str)
               for r in (rows, rows[::-1])]
    assert results[0] == results[1] and len(results[0]) == 3


def test_a_repeated_update_is_refused(spark):
    dim = spark.createDataFrame([(1, 5, "a", "c", "r", D(2020, 1, 1))], schemas.STAR["dim_store"])
    twice = dim.drop("store_key").unionByName(dim.drop("store_key"))
    with pytest.raises(ValueError, match="more than once"):
        scd1_upsert(dim, twice, natural_key="store_id", surrogate_key="store_key")


def test_violations_are_found(spark):
    """One warehouse with many faults: every check concerned reports them."""
    wh = warehouse.derive_warehouse(spark, SF_SMALL)
    star, staging = dict(wh.star_after), dict(wh.staging)
    fact, customers = star["fact_sales"], star["dim_customer"]
    item = fact.agg(F.min("order_item_id")).first()[0]
    # One line lost and one doubled: the totals still agree.
    other = fact.where(F.col("order_item_id") != item).limit(1)
    star["fact_sales"] = fact.where(F.col("order_item_id") != item).unionByName(other).withColumn(
        "line_margin", F.col("line_margin") + F.lit(1).cast("decimal(3,2)")).withColumn(
        "date_key", F.when(F.col("order_id") % 2 == 0, 19000101).otherwise(F.col("date_key")))
    changed = wh.changes.limit(1).first().customer_id
    star["dim_customer"] = customers.withColumns({
        "is_current": F.when(F.col("customer_id") == changed, 1).otherwise(F.col("is_current")),
        "city": F.when(F.col("customer_id") == changed, "nowhere").otherwise(F.col("city")),
        "valid_to": F.lit(None).cast("date")})
    sold_in = fact.agg(F.min("store_key")).first()[0]
    star["dim_store"] = star["dim_store"].where(F.col("store_key") != sold_in)
    star["dim_product"] = star["dim_product"].where("product_key > 1")
    star["dim_employee"] = star["dim_employee"].unionByName(star["dim_employee"].limit(1))
    staging["stg_sales_orders"] = staging["stg_sales_orders"].limit(1400)
    failed = {r[0] for r in evaluate_checks(wh.source, staging, star, wh.changes) if not r[3]}
    assert {"Q01", "Q04", "Q05", "Q07", "Q07b", "Q09", "Q11", "Q12", "Q13", "Q14", "Q15", "Q19a",
            "Q19c", "Q19e"} <= failed


def test_profiles_shuffle_bare_keys(spark):
    """What is added up per table does not travel with the keys."""
    from pyspark.sql import functions as F

    from strataform.plans.quality import combined_profiles

    rows = spark.createDataFrame([(1, "a", 2), (1, "a", None), (1, "b", 3), (None, "c", 4), (None, "c", 5)],
                                 "k bigint, s string, v int")
    found = combined_profiles({
        "one": (rows, ["k"], ["k", "v"], {"total": F.col("v")}),
        "two": (rows, ["k", "s"], [], {}),
        "none": (rows.where("false"), ["k"], ["k"], {"other": F.col("v")})})
    got = {r["t"]: (r["n"], r["dup"], r["nulls"], r["total"], r["other"]) for r in found.collect()}
    assert got == {"one": (5, 3, 3, 14, None), "two": (5, 2, 0, None, None), "none": (0, 0, 0, None, None)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    keyed = [x for x in plan.splitlines() if "keys=[_t#" in x and "_k#" in x]
    assert keyed and not any("total" in x or "_nulls" in x for x in keyed)
