"""Constraints counted by the write, content fingerprints, loads with rejects."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataform import schemas
from strataform.operators.constraints import (ConstraintViolation, fingerprint, violations,
                                              write_checked)
from strataform.operators.scd_folders import apply_to_folders, deal_dimension
from strataform.plans.warehouse import write_layer
from strataform.sources.rejects import (TooManyRejects, load_sources_with_rejects,
                                        load_with_rejects)

D = dt.date
STORE = schemas.STAR["dim_store"]


def stores(spark, **change):
    row = {"store_key": 1, "store_id": 1, "store_name": "s" * 100, "city": "c", "region": "r",
           "opening_date": D(2000, 1, 1), **change}
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in STORE.fields])
    return spark.createDataFrame([tuple(row[f.name] for f in STORE.fields)] * 2, nullable)


@pytest.mark.parametrize("change, rule", [
    ({"city": None}, "city is null"), ({"store_id": None}, "store_id is null"),
    ({"store_name": "s" * 101}, "store_name has more than 100 characters")])
def test_a_violation_fails_the_layer(spark, tmp_path, change, rule):
    with pytest.raises(ConstraintViolation) as failure:
        write_layer(spark, {"dim_store": lambda: stores(spark, **change)}, str(tmp_path), "star")
    assert failure.value.counts == {rule: 2} and failure.value.table == "dim_store"


def test_rows_that_fit_are_written(spark, tmp_path):
    written, rows = write_layer(spark, {"dim_store": lambda: stores(spark, city="é" * 80)},
                                str(tmp_path), "star")
    assert rows == {"dim_store": 2} and written["dim_store"].count() == 2


def test_rules_are_made_from_the_schema(spark, tmp_path):
    assert "valid_to is null" not in violations(schemas.STAR["dim_customer"])
    assert "is_current is neither 0 nor 1" in violations(schemas.STAR["dim_customer"])
    assert not any("null" in r for r in violations(schemas.STAGING["stg_customers"]))
    flag = T.StructType([T.StructField("is_returned", T.IntegerType())])
    df = spark.createDataFrame([(0,), (1,), (None,), (2,)], flag)
    with pytest.raises(ConstraintViolation, match=r"neither 0 nor 1 \(1 rows\)"):
        write_checked(df, "t", flag, lambda d: d.write.parquet(str(tmp_path / "t")))


def test_a_change_batch_that_breaks_a_rule_fails(spark, tmp_path):
    schema = schemas.STAR["dim_customer"]
    dim = spark.createDataFrame([(1, 1, "a", "x", 1, D(2000, 1, 1), D(2000, 1, 1), None, 1)], schema)
    dealt = deal_dimension(dim, str(tmp_path / "dim"), folders=2)
    changes = spark.createDataFrame([(1, D(2001, 1, 1), None)],
                                    "customer_id bigint, change_date date, city string")
    with pytest.raises(ConstraintViolation, match="city is null"):
        apply_to_folders(spark, dealt, changes, str(tmp_path / "after"), schema)


def test_fingerprints(spark):
    fields = T.StructType.fromDDL("a bigint, b string, c string").fields
    rows = [(i, str(i % 7), None if i % 3 else "x") for i in range(200)]

    def of(rows, ddl="a bigint, b string, c string"):
        return spark.createDataFrame(rows, ddl).agg(fingerprint(fields)).first()[0]

    assert of(rows) == of(rows[::-1]) == of(rows, "a int, b string, c string")
    assert of(rows) != of([*rows[:-1], (199, "changed", None)])
    assert of([(1, None, "x")]) != of([(1, "x", None)])
    assert of([]) is None


CUSTOMERS = schemas.SOURCE["customers"]
HEADER = "customer_id,full_name,city,signup_date,loyalty_member\n"


def csv(tmp_path, lines, header=HEADER, name="customers"):
    os.makedirs(tmp_path / name, exist_ok=True)
    (tmp_path / name / "part.csv").write_text(header + "".join(f"{x}\n" for x in lines))
    return str(tmp_path / name)


BAD = ["x,n,c,2000-01-01,1", "2,n,c,2000-13-01,0", "3,n,c,2000,7", "4,,c,2000-01-01,0",
       "5,n,c,2000-01-01", f"6,{'n' * 101},c,2000-01-01,1", "7,n,c,2000-01-01,0,9"]


def test_rejects_are_named(spark, tmp_path):
    path = csv(tmp_path, ["1,n,c,2000-01-01,1", *BAD, '8,"a, b",,2001-02-03,0'])
    got = load_with_rejects(spark, path, CUSTOMERS, str(tmp_path / "out"), max_rejects=7)
    assert (got.n_rows, got.n_rejects) == (2, 7)
    assert got.rows.dtypes == [(f.name, f.dataType.simpleString()) for f in CUSTOMERS.fields]
    assert sorted(map(tuple, got.rows.collect())) == [
        (1, "n", "c", D(2000, 1, 1), 1), (8, "a, b", None, D(2001, 2, 3), 0)]
    reasons = sorted(tuple(r.reasons) for r in got.rejects.collect())
    assert reasons == sorted([
        ("customer_id is not a bigint",), ("signup_date is not a date",),
        ("signup_date is not a date", "loyalty_member is neither 0 nor 1"), ("full_name is null",),
        ("wrong number of fields",), ("full_name has more than 100 characters",),
        ("wrong number of fields",)])
    rows = {r.record for r in got.rejects.collect()}
    assert "5,n,c,2000-01-01" in rows and any('"customer_id":"x"' in r for r in rows)
    assert all(r.file.endswith("part.csv") for r in got.rejects.collect())


def test_limits(spark, tmp_path):
    path = csv(tmp_path, ["1,n,c,2000-01-01,1", *BAD])
    with pytest.raises(TooManyRejects, match="7 of 8 rows.*customer_id is not a bigint"):
        load_with_rejects(spark, path, CUSTOMERS, str(tmp_path / "a"), max_rejects=6)
    assert load_with_rejects(spark, path, CUSTOMERS, str(tmp_path / "b"), max_share=0.9).n_rejects == 7


def test_clean_empty_and_all_bad_loads(spark, tmp_path):
    clean = load_with_rejects(spark, csv(tmp_path, ["1,n,c,2000-01-01,1"]), CUSTOMERS, str(tmp_path / "a"))
    assert (clean.n_rows, clean.rejects.count()) == (1, 0)
    empty = load_with_rejects(spark, csv(tmp_path, [], name="e"), CUSTOMERS, str(tmp_path / "b"))
    assert (empty.n_rows, empty.n_rejects, empty.rows.count()) == (0, 0, 0)
    bad = load_with_rejects(spark, csv(tmp_path, BAD, name="f"), CUSTOMERS, str(tmp_path / "c"), max_rejects=7)
    assert (bad.rows.count(), bad.n_rejects) == (0, 7)


def test_a_wrong_header_fails(spark, tmp_path):
    path = csv(tmp_path, ["1,n,c,2000-01-01,1"], "id,full_name,city,signup_date,loyalty_member\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_with_rejects(spark, path, CUSTOMERS, str(tmp_path / "out"))


def test_decimals_and_json(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType(), False),
                           T.StructField("price", T.DecimalType(10, 2))])
    os.makedirs(tmp_path / "j")
    (tmp_path / "j" / "a.json").write_text(
        '{"id": 1, "price": 1.50}\n{"id": 2, "price": 1.505}\n{"id": 3}\n{"id": \n{"id": 4, "price": 1e9}\n')
    got = load_with_rejects(spark, str(tmp_path / "j"), schema, str(tmp_path / "out"), "json", max_rejects=3)
    assert sorted(r.id for r in got.rows.collect()) == [1, 3]
    assert sorted(tuple(r.reasons) for r in got.rejects.collect()) == [
        ("not a JSON object",), ("price is not a decimal(10,2)",), ("price is not a decimal(10,2)",)]


def test_all_source_tables(spark, tmp_path):
    for name, schema in schemas.SOURCE.items():
        csv(tmp_path, [], ",".join(schema.names) + "\n", name)
    csv(tmp_path, ["1,toys", "2,"], "category_id,category_name\n", "categories")
    got = load_sources_with_rejects(spark, str(tmp_path), str(tmp_path / "out"), max_rejects=1)
    assert set(got) == set(schemas.SOURCE)
    assert (got["categories"].n_rows, got["categories"].n_rejects) == (1, 1)
    assert [f.dataType for f in got["stores"].rows.schema] == [f.dataType for f in schemas.SOURCE["stores"]]
