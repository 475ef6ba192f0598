"""Change sets between two extracts, and a dimension brought to an extract."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataform import schemas
from strataform.operators.change_set import apply_snapshot, snapshot_changes, update_batch
from strataform.operators.scd import scd2_apply

D = dt.date
PEOPLE = "customer_id bigint, full_name string, city string, loyalty_member int, signup_date date"
COLUMNS = ["full_name", "city", "loyalty_member", "signup_date"]


def people(spark, rows):
    return spark.createDataFrame([(i, n, c, 1, D(2000, 1, i % 28 + 1)) for i, n, c in rows], PEOPLE)


def test_changes(spark):
    before = people(spark, [(1, "a", "x"), (2, "b", "x"), (3, "c", None), (4, "d", "x"), (5, "e", None)])
    after = people(spark, [(1, "a", "x"), (2, "b", "y"), (3, "c", None), (5, "E", "z"), (6, "f", None)])
    got = {r.customer_id: (r.change, r.city, r.changed) for r in snapshot_changes(
        before.withColumn("change", F.lit("clash")), after, "customer_id", COLUMNS).collect()}
    assert got == {2: ("update", "y", ["city"]), 4: ("delete", "x", []),
                   5: ("update", "z", ["full_name", "city"]), 6: ("insert", None, [])}


def test_empty_snapshots(spark):
    some, none = people(spark, [(1, "a", "x")]), people(spark, [])
    assert snapshot_changes(none, none, "customer_id", COLUMNS).count() == 0
    assert [r.change for r in snapshot_changes(none, some, "customer_id", COLUMNS).collect()] == ["insert"]
    assert [r.change for r in snapshot_changes(some, none, "customer_id", COLUMNS).collect()] == ["delete"]


@pytest.mark.parametrize("rows", [[(1, "a", "x"), (1, "a", "x")], [(None, "a", "x")]])
def test_null_and_repeated_keys_fail(spark, rows):
    one = spark.createDataFrame([(i, n, c, 1, D(2000, 1, 1)) for i, n, c in rows], PEOPLE)
    with pytest.raises(Exception, match="null or stands twice"):
        snapshot_changes(people(spark, [(1, "a", "x")]), one, "customer_id", COLUMNS).collect()


def test_batch_through_scd2_equals_the_one_by_hand(spark):
    before = people(spark, [(1, "a", "x"), (2, "b", "x"), (3, "c", "x")])
    after = people(spark, [(1, "a", "y"), (2, "B", "x"), (3, "c", None)])
    dim = spark.createDataFrame([(i, i, n, "x", 1, D(2000, 1, 1), D(2000, 1, 1), None, 1)
                                 for i, n in ((1, "a"), (2, "b"), (3, "c"))], schemas.STAR["dim_customer"])
    on = D(2001, 1, 1)
    batch = update_batch(snapshot_changes(before, after, "customer_id", COLUMNS), "customer_id", ["city"], on)
    by_hand = spark.createDataFrame([(1, on, "y"), (3, on, None)],
                                    "customer_id bigint, change_date date, city string")
    assert sorted(map(tuple, scd2_apply(dim, batch).collect()), key=str) == \
        sorted(map(tuple, scd2_apply(dim, by_hand).collect()), key=str)


def plain(dim, snapshot, on):
    """The dimension after the snapshot, key by key."""
    out, current = [], {}
    for row in dim:
        if row[8] == 1:
            current[row[1]] = row
    now = {r[0]: r for r in snapshot}
    for row in dim:
        open_ = row[8] == 1
        ends = open_ and (row[1] not in now or now[row[1]][2] != row[3])
        out.append((*row[:7], on - dt.timedelta(1), 0) if ends else row)
    top = max((r[0] for r in dim), default=0)
    for k in sorted(set(now) - set(current)):
        top += 1
        _, name, city, loyal, signup = now[k]
        out.append((top, k, name, city, loyal, signup, signup, None, 1))
    for k in sorted(set(now) & set(current)):
        if now[k][2] != current[k][3]:
            top += 1
            out.append((top, k, *current[k][2:3], now[k][2], *current[k][4:6], on, None, 1))
    return sorted(out, key=str)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 12), st.sampled_from("xyz"), st.booleans()), max_size=10,
                unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(1, 12), st.sampled_from("xyz")), max_size=10,
                unique_by=lambda t: t[0]))
def test_apply_snapshot(spark, held, later):
    start, on = D(2000, 1, 1), D(2002, 1, 1)
    dim = [(n + 1, k, f"n{k}", c, 1, start, start, None if cur else D(2001, 1, 1), int(cur))
           for n, (k, c, cur) in enumerate(held)]
    snapshot = [(k, f"n{k}", c, 1, start) for k, c in later]
    got = apply_snapshot(spark.createDataFrame(dim, schemas.STAR["dim_customer"]),
                         spark.createDataFrame(snapshot, PEOPLE), on)
    assert sorted(map(tuple, got.collect()), key=str) == plain(dim, snapshot, on)


def test_kept_when_deleted_are_not_closed(spark):
    dim = spark.createDataFrame([(1, 1, "a", "x", 1, D(2000, 1, 1), D(2000, 1, 1), None, 1)],
                                schemas.STAR["dim_customer"])
    none = people(spark, [])
    kept = apply_snapshot(dim, none, D(2001, 1, 1), close_deleted=False)
    assert [r.is_current for r in kept.collect()] == [1]
    assert [r.is_current for r in apply_snapshot(dim, none, D(2001, 1, 1)).collect()] == [0]
