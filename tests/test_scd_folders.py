"""SCD2 batches on a dimension in key folders."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strataform import schemas
from strataform.operators.scd import scd2_apply
from strataform.operators.scd_folders import apply_to_folders, deal_dimension, reopened
from strataform.plans import increments, warehouse
from strataform.sources.key_folders import (dealt_into, folder_number, split_folders,
                                            touched_folders)
from strataform.sources.published import published
from tests.conftest import SF_SMALL

D = dt.date
SCHEMA = schemas.STAR["dim_customer"]
CHANGES = "customer_id bigint, change_date date, city string"


def same(a, b):
    a = a.select(*b.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def dim(spark):
    rows = [(i, i * 10, f"n{i}", f"c{i % 5}", i % 2, D(2000, 1, 1), D(2000, 1, 1), None, 1)
            for i in range(1, 201)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture()
def dealt(dim, tmp_path):
    return deal_dimension(dim, str(tmp_path / "dim"), folders=16)


def files(paths):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
            for p in paths for d, _, names in os.walk(p) for f in names if f.endswith(".parquet")}


def test_two_batches_equal_the_whole_dimension(spark, dim, dealt, tmp_path):
    first = spark.createDataFrame([(10, D(2001, 1, 1), "x"), (10, D(2001, 5, 1), "y"),
                                   (70, D(2001, 2, 1), "z"), (5, D(2001, 1, 1), "nobody"),
                                   (None, D(2001, 1, 1), "null")], CHANGES)
    second = spark.createDataFrame([(70, D(2002, 1, 1), "v"), (900, D(2002, 1, 1), "w")], CHANGES)
    want = scd2_apply(dim, first)
    before = files(dealt.paths)
    one = apply_to_folders(spark, dealt, first, str(tmp_path / "one"), SCHEMA)
    assert one.max_key == 203 and same(one.read(spark, SCHEMA), want)
    touched, kept = split_folders(dealt.paths, set(one.touched))
    assert 1 <= len(touched) <= 8 and set(kept) <= set(one.paths)
    assert not set(touched) & set(one.paths)
    assert files(dealt.paths) == before
    two = apply_to_folders(spark, reopened(one.paths, one.max_key), second, str(tmp_path / "two"), SCHEMA)
    assert same(two.read(spark, SCHEMA), scd2_apply(want, second))
    assert len({folder_number(p) for p in two.written}) <= 2


def test_untouched_folders_are_not_read(spark, dealt, tmp_path):
    """With the files of all other folders gone, the batch still succeeds."""
    changes = spark.createDataFrame([(10, D(2001, 1, 1), "x")], CHANGES)
    touched = touched_folders(changes, "customer_id", 16)
    _, others = split_folders(dealt.paths, touched)
    for f in files(others):
        open(f, "w").close()  # no Parquet file any more: reading it would fail
    after = apply_to_folders(spark, dealt, changes, str(tmp_path / "one"), SCHEMA)
    assert after.touched == touched and len(after.written) == 2  # current and closed
    row = spark.read.parquet(*after.written).where("customer_id = 10 and is_current = 1").first()
    assert (row.city, row.customer_key) == ("x", 201)


def test_empty_batch_and_unknown_keys(spark, dim, dealt, tmp_path):
    none = spark.createDataFrame([], CHANGES)
    assert apply_to_folders(spark, dealt, none, str(tmp_path / "none"), SCHEMA).paths == dealt.paths
    unknown = spark.createDataFrame([(5, D(2001, 1, 1), "x")], CHANGES)
    after = apply_to_folders(spark, dealt, unknown, str(tmp_path / "unknown"), SCHEMA)
    assert same(after.read(spark, SCHEMA), dim) and after.max_key == 200


def test_empty_dimension(spark, dim, tmp_path):
    empty = deal_dimension(dim.where("false"), str(tmp_path / "dim"), folders=4)
    assert (empty.paths, empty.max_key) == ([], 0)
    changes = spark.createDataFrame([(10, D(2001, 1, 1), "x")], CHANGES)
    assert apply_to_folders(spark, empty, changes, str(tmp_path / "x"), SCHEMA).paths == []


def test_folder_names():
    assert folder_number("/a/key_folder_64=7") == folder_number("/a/key_folder_64=7_1/") == (64, 7)
    assert folder_number("/a/is_current=1") is None
    assert dealt_into(["/a/key_folder_8=1", "/b/key_folder_8=2"]) == 8
    assert dealt_into(["/a/dim_customer"]) is None and dealt_into([]) is None
    with pytest.raises(ValueError):
        dealt_into(["/a/key_folder_8=1", "/b/key_folder_4=2"])
    with pytest.raises(ValueError):
        reopened(["/a/dim_customer"], 1)


def test_published_batches(spark, tmp_path):
    """Two batches on a published warehouse: the second leaves most folders alone."""
    root = str(tmp_path)
    none = spark.createDataFrame([], CHANGES)
    warehouse.run_build(spark, SF_SMALL, root, changes=none)
    initial = increments.published_star(spark, root)["dim_customer"]
    ids = [r[0] for r in initial.select("customer_id").orderBy("customer_id").limit(3).collect()]
    a = spark.createDataFrame([(ids[0], D(2003, 1, 1), "A"), (ids[1], D(2003, 1, 1), "B")], CHANGES)
    b = spark.createDataFrame([(ids[0], D(2004, 1, 1), "C")], CHANGES)
    want = scd2_apply(scd2_apply(initial, a), b)
    increments.apply_batch(spark, root, a)
    between = published(spark, root)
    increments.apply_batch(spark, root, b)
    now = published(spark, root)
    assert same(increments.published_star(spark, root)["dim_customer"], want)
    old, new = between["tables"]["star/dim_customer"], now["tables"]["star/dim_customer"]
    assert len({folder_number(p) for p in set(old) - set(new)}) == 1
    assert len({folder_number(p) for p in set(new) - set(old)}) == 1
    assert now["state"]["max_customer_key"] == want.agg(F.max("customer_key")).first()[0]
