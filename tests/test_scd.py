"""SCD2 batch semantics (closing, chaining, replays, unknown keys) and SCD1 upserts."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strataform import schemas
from strataform.operators.scd import history_of, scd1_upsert, scd2_apply, version_history

D = dt.date


def _dim(spark, rows):
    return spark.createDataFrame(rows, schemas.STAR["dim_customer"])


def _initial(spark):
    return _dim(spark, [
        (1, 1, "Ann", "Nantes", 1, D(2022, 4, 25), D(2022, 4, 25), None, 1),
        (2, 2, "Bob", "Lyon", 0, D(2021, 1, 1), D(2021, 1, 1), None, 1),
        (3, 3, "Cy", "Lille", 0, D(2020, 5, 5), D(2020, 5, 5), None, 1),
    ])


def _changes(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, change_date date, city string")


def _rows(df, customer_id):
    return sorted((r["customer_key"], r["city"], r["valid_from"], r["valid_to"], r["is_current"])
                  for r in df.where(f"customer_id = {customer_id}").collect())


def test_single_change_closes_and_opens(spark):
    out = scd2_apply(_initial(spark), _changes(spark, [(1, D(2024, 7, 1), "Paris")]))
    assert _rows(out, 1) == [
        (1, "Nantes", D(2022, 4, 25), D(2024, 6, 30), 0),
        (4, "Paris", D(2024, 7, 1), None, 1),
    ]
    assert _rows(out, 2) == [(2, "Lyon", D(2021, 1, 1), None, 1)]
    assert out.count() == 4


def test_unchanged_city_still_opens_a_version_unless_skipped(spark):
    batch = _changes(spark, [(2, D(2024, 1, 1), "Lyon")])
    assert len(_rows(scd2_apply(_initial(spark), batch), 2)) == 2
    assert len(_rows(scd2_apply(_initial(spark), batch, skip_unchanged=True), 2)) == 1


def test_unknown_customer_has_no_effect(spark):
    out = scd2_apply(_initial(spark), _changes(spark, [(99, D(2024, 1, 1), "Nice")]))
    assert out.count() == 3
    assert out.where("customer_id = 99").count() == 0


def test_replaying_the_same_change_gives_a_third_version(spark):
    batch = _changes(spark, [(1, D(2024, 7, 1), "Paris")])
    once = scd2_apply(_initial(spark), batch)
    twice = scd2_apply(once, batch)
    rows = _rows(twice, 1)
    assert len(rows) == 3
    assert sum(r[4] for r in rows) == 1
    assert rows[-1][1:] == ("Paris", D(2024, 7, 1), None, 1)


def test_several_changes_in_one_batch_are_chained(spark):
    batch = _changes(spark, [(1, D(2024, 9, 1), "Nice"), (1, D(2024, 7, 1), "Paris"),
                             (3, D(2023, 1, 1), "Metz")])
    out = scd2_apply(_initial(spark), batch)
    assert _rows(out, 1) == [
        (1, "Nantes", D(2022, 4, 25), D(2024, 6, 30), 0),
        (4, "Paris", D(2024, 7, 1), D(2024, 8, 31), 0),
        (5, "Nice", D(2024, 9, 1), None, 1),
    ]
    assert _rows(out, 3)[-1] == (6, "Metz", D(2023, 1, 1), None, 1)


def test_customer_with_only_closed_versions_gets_a_new_one(spark):
    dim = _dim(spark, [(1, 1, "Ann", "Nantes", 1, D(2022, 1, 1), D(2022, 1, 1), D(2023, 1, 1), 0)])
    out = scd2_apply(dim, _changes(spark, [(1, D(2024, 1, 1), "Paris")]))
    assert _rows(out, 1) == [
        (1, "Nantes", D(2022, 1, 1), D(2023, 1, 1), 0),
        (2, "Paris", D(2024, 1, 1), None, 1),
    ]


def test_late_changes_apply_by_default_and_can_be_rejected(spark):
    batch = _changes(spark, [(1, D(2020, 1, 1), "Paris")])
    applied = _rows(scd2_apply(_initial(spark), batch), 1)
    assert applied[0][3] == D(2019, 12, 31)  # closed before it started, as the source does
    rejected = _rows(scd2_apply(_initial(spark), batch, late="reject"), 1)
    assert rejected == [(1, "Nantes", D(2022, 4, 25), None, 1)]


def test_version_history_numbers_versions(spark):
    out = scd2_apply(_initial(spark), _changes(spark, [(1, D(2024, 7, 1), "Paris")]))
    hist = {(r["customer_id"], r["version_no"]): r["city"] for r in version_history(out).collect()}
    assert hist[(1, 1)] == "Nantes" and hist[(1, 2)] == "Paris" and hist[(2, 1)] == "Lyon"


def test_scd1_upsert_keeps_keys_and_appends_new(spark):
    dim = spark.createDataFrame([(1, 10, "A", "X", "R", D(2020, 1, 1)),
                                 (2, 20, "B", "Y", "R", D(2020, 1, 1))], schemas.STAR["dim_store"])
    updates = spark.createDataFrame([(20, "B2", "Y", "R", D(2021, 1, 1)),
                                     (30, "C", "Z", "S", D(2022, 1, 1))],
                                    "store_id long, store_name string, city string, region string, "
                                    "opening_date date")
    out = {r["store_id"]: r for r in scd1_upsert(dim, updates, natural_key="store_id",
                                                 surrogate_key="store_key").collect()}
    assert out[10]["store_name"] == "A" and out[10]["store_key"] == 1
    assert out[20]["store_name"] == "B2" and out[20]["store_key"] == 2
    assert out[30]["store_key"] == 3


change_lists = st.lists(
    st.tuples(st.integers(1, 4), st.integers(0, 400), st.sampled_from(["Paris", "Lyon", "Nice"])),
    min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes=change_lists)
def test_scd2_invariants(spark, changes):
    start = D(2023, 1, 1)
    rows = [(cid, start + dt.timedelta(days=off), city) for cid, off, city in changes]
    # distinct dates per customer keep the order total
    seen, batch = set(), []
    for cid, d, city in rows:
        if (cid, d) not in seen:
            seen.add((cid, d))
            batch.append((cid, d, city))
    before = _initial(spark)
    out = scd2_apply(before, _changes(spark, batch)).collect()
    known = [b for b in batch if b[0] in (1, 2, 3)]
    assert len(out) == 3 + len(known)
    by_id = {}
    for r in out:
        by_id.setdefault(r["customer_id"], []).append(r)
    for cid, versions in by_id.items():
        assert sum(v["is_current"] for v in versions) == 1
        if not any(b[0] == cid for b in known):
            assert len(versions) == 1
            continue
        latest = max((b for b in known if b[0] == cid), key=lambda b: b[1])
        current = [v for v in versions if v["is_current"] == 1][0]
        assert current["city"] == latest[2] and current["valid_from"] == latest[1]
        new = sorted((v for v in versions if v["customer_key"] > 3), key=lambda v: v["valid_from"])
        for a, b in zip(new, new[1:]):
            assert a["valid_to"] == b["valid_from"] - dt.timedelta(days=1)
    keys = [r["customer_key"] for r in out]
    assert sorted(keys) == list(range(1, len(out) + 1))


def test_empty_change_batch_changes_nothing(spark):
    out = scd2_apply(_initial(spark), _changes(spark, []))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, _initial(spark).collect()))


def test_scd2_on_another_dimension(spark):
    """Any key and tracked columns: a product's cost history."""
    products = spark.createDataFrame([
        (1, 10, "Lamp", "Home", D(2023, 1, 1), None, 1, 6.0),
        (2, 11, "Desk", "Office", D(2023, 1, 1), None, 1, 80.0),
    ], "product_key long, product_id long, product_name string, category_name string, "
       "valid_from date, valid_to date, is_current int, unit_cost double")
    changes = spark.createDataFrame([(10, D(2024, 5, 1), 7.5)],
                                    "product_id long, change_date date, unit_cost double")
    out = scd2_apply(products, changes, natural_key="product_id", surrogate_key="product_key",
                     tracked=["unit_cost"])
    lamp = sorted((r["product_key"], r["unit_cost"], r["valid_to"], r["is_current"])
                  for r in out.where("product_id = 10").collect())
    assert lamp == [(1, 6.0, D(2024, 4, 30), 0), (3, 7.5, None, 1)]


def test_skip_unchanged_compares_with_the_value_before_each_change(spark):
    batch = _changes(spark, [(2, D(2024, 1, 1), "Lyon"), (2, D(2024, 2, 1), "Nice"),
                             (2, D(2024, 3, 1), "Nice"), (2, D(2024, 4, 1), "Lyon")])
    rows = _rows(scd2_apply(_initial(spark), batch, skip_unchanged=True), 2)
    assert [(r[1], r[2], r[3], r[4]) for r in rows] == [
        ("Lyon", D(2021, 1, 1), D(2024, 1, 31), 0),
        ("Nice", D(2024, 2, 1), D(2024, 3, 31), 0),
        ("Lyon", D(2024, 4, 1), None, 1),
    ]


def test_history_of_one_customer_oldest_first(spark):
    out = scd2_apply(_initial(spark), _changes(spark, [(1, D(2024, 7, 1), "Paris")]))
    assert [r["city"] for r in history_of(out, 1).collect()] == ["Nantes", "Paris"]
