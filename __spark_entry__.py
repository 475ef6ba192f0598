"""

Every query reads the driver tables under ``sf_dir`` (whole tables) and
derives the warehouse layers from them with Spark; see ``strataform``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The package and the SQL statements live next to this file; make them
# importable when this file is loaded by path from another directory.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import sql_oracle  # noqa: E402
from strataform import schemas  # noqa: E402
from strataform.operators.change_set import apply_snapshot, snapshot_changes  # noqa: E402
from strataform.operators.dimensions import dim_customer_initial  # noqa: E402
from strataform.operators.facts import fact_sales  # noqa: E402
from strataform.operators.late_returns import with_late_returns  # noqa: E402
from strataform.operators.scd import scd1_upsert, scd2_apply, version_history  # noqa: E402
from strataform.operators.scd_folders import apply_to_folders, deal_dimension  # noqa: E402
from strataform.operators.text_equality import one_spelling  # noqa: E402
from strataform.plans import marts, partials  # noqa: E402
from strataform.plans.quality import fact_orphans, run_checks, side_by_side  # noqa: E402
from strataform.plans.warehouse import derive_warehouse, row_count_report  # noqa: E402
from strataform.session import scratch_path, written_once  # noqa: E402
from strataform.sources.lazy import LazyTables  # noqa: E402

# The training-data operators and the pipeline are optional: without their
# folders every other query still works.
try:
    import corpus_pipeline
    import strataform.llm.oracle as llm_oracle
    import strataform.llm.queries as llm_queries
except ImportError:  # also where a package only they need is not installed
    corpus_pipeline = llm_oracle = llm_queries = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"


def _wh(spark: SparkSession, sf_dir: str):
    return derive_warehouse(spark, sf_dir)


def _staging(table: str) -> Callable[[SparkSession, str], DataFrame]:
    cols = [f.name for f in schemas.SOURCE[table].fields] + ["_source_table"]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _wh(spark, sf_dir).staging[f"stg_{table}"].select(*cols)
    return run


def _star(table: str, after: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = _wh(spark, sf_dir)
        return (wh.star_after if after else wh.star)[table]
    return run


def _mart(name: str, after: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = _wh(spark, sf_dir)
        return marts.MARTS[name](wh.star_after if after else wh.star)
    return run


def q_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wh(spark, sf_dir).star["fact_sales"].drop("fact_id")


def q_fact_sales_heavy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact, with the lines of orders that hold more than a 64th of all
    lines spread for the join to their header."""
    wh = _wh(spark, sf_dir)
    stg, star = wh.staging, wh.star
    return fact_sales(stg["stg_sales_order_items"], stg["stg_sales_orders"],
                      stg["stg_product_returns"], star["dim_customer"], star["dim_product"],
                      star["dim_store"], star["dim_employee"], with_fact_id=False, heavy_parts=64)


def q_fact_sales_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact with the customer version valid on the order date (after the
    change batch); orders placed before signup stay unresolved."""
    wh = _wh(spark, sf_dir)
    stg, star = wh.staging, wh.star_after
    return fact_sales(stg["stg_sales_order_items"], stg["stg_sales_orders"],
                      stg["stg_product_returns"], star["dim_customer"], star["dim_product"],
                      star["dim_store"], star["dim_employee"], key_mode="as_of",
                      with_fact_id=False)


def q_fact_sales_as_of_open_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same, with each customer's first version also covering earlier dates."""
    wh = _wh(spark, sf_dir)
    stg, star = wh.staging, wh.star_after
    return fact_sales(stg["stg_sales_order_items"], stg["stg_sales_orders"],
                      stg["stg_product_returns"], star["dim_customer"], star["dim_product"],
                      star["dim_store"], star["dim_employee"], key_mode="as_of",
                      open_first_version=True, with_fact_id=False)


def q_customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wh(spark, sf_dir).changes


def q_customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_history(_wh(spark, sf_dir).star_after["dim_customer"])


def q_top_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_product(_wh(spark, sf_dir).star)


def q_row_count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    return row_count_report(wh.staging, wh.star_after)


def q_dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    # Several checks read the staged lines: a written copy spares each its joins.
    items = "stg_sales_order_items"
    staging = LazyTables({name: (lambda name=name: written_once(
        lambda: wh.staging[name], spark, name) if name == items else wh.staging[name])
        for name in wh.staging})
    return run_checks(wh.source, staging, wh.star_after, wh.changes)


def q_dq_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_orphans(_wh(spark, sf_dir).star_after)


def q_dq_revenue_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = _wh(spark, sf_dir)
    items, fact = wh.staging["stg_sales_order_items"], wh.star["fact_sales"]
    staged = items.agg(F.round(F.sum(F.col("quantity") * F.col("unit_price_paid")), 2)
                       .cast(schemas.SUM_MONEY).alias("staged_revenue"))
    loaded = fact.agg(
        F.round(F.sum("line_revenue"), 2).cast(schemas.SUM_MONEY).alias("fact_revenue"),
        F.round(F.sum(F.when(F.col("is_returned") == 0, F.col("line_revenue"))), 2)
        .cast(schemas.SUM_MONEY).alias("fact_revenue_kept"),
        F.count(F.when(F.col("line_margin")
                       != F.round(F.col("line_revenue") - F.col("line_cost"), 2), 1))
        .alias("margin_mismatches"))
    return side_by_side([staged, loaded])


def q_dq_multiple_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _wh(spark, sf_dir).star_after["dim_customer"]
    return (dim.groupBy("customer_id").agg(F.sum("is_current").cast("bigint")
                                           .alias("current_versions"))
            .where(F.col("current_versions") > 1))


def _yearly_moves(wh) -> DataFrame:
    """In every year with orders, a customer moves to the city of the store of the
    year's last order, on its date."""
    orders = wh.staging["stg_sales_orders"].where("customer_id is not null")
    last = orders.groupBy("customer_id", F.year("order_date").alias("y")).agg(
        F.max_by(F.struct("order_date", "store_id"), F.struct("order_date", "order_id")).alias("o"))
    moves = last.select("customer_id", F.col("o.order_date").alias("change_date"),
                        F.col("o.store_id").alias("store_id"))
    return moves.join(wh.staging["stg_stores"].select("store_id", "city"), "store_id").select(
        "customer_id", "change_date", "city")


def q_dim_customer_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The initial customers after a batch with several changes a customer: the
    yearly moves."""
    wh = _wh(spark, sf_dir)
    return scd2_apply(wh.star["dim_customer"], _yearly_moves(wh))


def q_dim_customer_key_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers dealt into key folders, after two batches that replace the
    folders they touch: the yearly moves before the last year with orders, then
    those of the last year."""
    wh = _wh(spark, sf_dir)
    schema = schemas.STAR["dim_customer"]

    def build() -> DataFrame:
        moves = _yearly_moves(wh)
        last = wh.staging["stg_sales_orders"].agg(F.max(F.year("order_date"))).first()[0]
        in_last = F.year("change_date") == F.lit(last)
        dealt = deal_dimension(wh.star["dim_customer"], scratch_path(spark, "dealt"), folders=16)
        for batch in (moves.where(~in_last), moves.where(in_last)):
            dealt = apply_to_folders(spark, dealt, batch, scratch_path(spark, "batch"), schema)
        return dealt.read(spark, schema)

    return written_once(build, spark, "key_folders")


def _two_extracts(spark: SparkSession, sf_dir: str):
    """Customers on file (signed up by September), a later extract of the customers
    that order, with the cities they live in then, and the day of that extract."""
    wh = _wh(spark, sf_dir)
    customers, orders = wh.staging["stg_customers"], wh.staging["stg_sales_orders"]
    columns = ["customer_id", "full_name", "city", "loyalty_member", "signup_date"]
    moved = wh.changes.select("customer_id", F.col("city").alias("new_city"))
    later = customers.join(orders.select("customer_id").distinct(), "customer_id", "left_semi").join(
        moved, "customer_id", "left").withColumn("city", F.coalesce("new_city", "city"))
    on = orders.agg(F.date_add(F.max("order_date"), 1)).first()[0]
    return customers.where(F.month("signup_date") <= 9), later.select(*columns), on


def q_customer_change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts, updates and deletes between two extracts of the customers."""
    before, after, _ = _two_extracts(spark, sf_dir)
    found = snapshot_changes(before, after, "customer_id",
                             ["full_name", "city", "loyalty_member", "signup_date"])
    return found.withColumn("changed", F.array_join("changed", ","))


def q_dim_customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers on file brought to the state of the later extract."""
    before, after, on = _two_extracts(spark, sf_dir)
    return written_once(lambda: apply_snapshot(dim_customer_initial(before), after, on), spark,
                        "snapshot")


def _spelled(wh) -> DataFrame:
    """Customers whose city is not spelled alike everywhere."""
    dim = wh.star["dim_customer"]
    return dim.withColumn("city", F.when(F.col("loyalty_member") == 1, F.lower("city"))
                          .otherwise(F.col("city")))


def q_geography_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The geography mart with every spelling of a city apart (bytes compared)."""
    wh = _wh(spark, sf_dir)
    return marts.mart_customer_geography({**wh.star, "dim_customer": _spelled(wh)})


def q_geography_any_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The geography mart with cities equal that differ in case or accents only."""
    wh = _wh(spark, sf_dir)
    return marts.mart_customer_geography({**wh.star, "dim_customer": one_spelling(_spelled(wh), ["city"])})


def _ordered(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The published mart read in its documented order, with the place in it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return marts.ordered_mart(_wh(spark, sf_dir).star, name)
    return run


def _two_batches(spark: SparkSession, sf_dir: str):
    """The fact loaded in two batches of orders, split at the middle date.  All
    returns come with the second batch; those of first-batch lines are late."""
    wh = _wh(spark, sf_dir)
    if "batches" not in wh.kept:
        stg, star = wh.staging, wh.star
        orders, returns = stg["stg_sales_orders"], stg["stg_product_returns"]
        middle = orders.agg(F.percentile_approx("order_date", 0.5)).first()[0]

        def load(batch: DataFrame, known: DataFrame) -> DataFrame:
            return fact_sales(stg["stg_sales_order_items"], batch, known, star["dim_customer"],
                              star["dim_product"], star["dim_store"], star["dim_employee"],
                              headers_last=True)

        early = F.col("order_date") <= F.lit(middle)
        tables = LazyTables({
            "first": lambda: written_once(lambda: with_late_returns(load(
                orders.where(early), returns.where("false")), returns), spark, "first_batch"),
            "second": lambda: written_once(lambda: load(orders.where(~early), returns), spark,
                                           "second_batch"),
            **{name: (lambda name=name: written_once(lambda: partials.merged(name, [
                partials.partial_tables(tables[batch], star["dim_customer"])[name]
                for batch in ("first", "second")]), spark, name)) for name in partials.PARTIALS},
        })
        wh.kept["batches"] = tables
    return wh.kept["batches"], wh.star


def q_fact_sales_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of two batches with late returns; equals one load of everything."""
    tables, _ = _two_batches(spark, sf_dir)
    return tables["first"].unionByName(tables["second"]).drop("fact_id")


def _mart_two_batches(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The mart from the merged partial aggregates of the two batches."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables, star = _two_batches(spark, sf_dir)
        return partials.marts_from(tables, star)[name]
    return run


def q_scd1_upsert_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD1 batch derived from the data: each store's opening date becomes the
    date of its first sale, and every region gets an online store."""
    wh = _wh(spark, sf_dir)
    stores, orders = wh.staging["stg_stores"], wh.staging["stg_sales_orders"]
    first_sale = orders.groupBy("store_id").agg(F.min("order_date").alias("opening_date"))
    updates = stores.drop("opening_date").join(first_sale, "store_id").select(
        "store_id", "store_name", "city", "region", "opening_date")
    online = stores.join(first_sale.withColumnRenamed("opening_date", "first"), "store_id").groupBy(
        "region").agg(F.max("store_id").alias("largest"), F.min("first").alias("opening_date")).select(
        (F.col("largest") + 1000).alias("store_id"),
        F.concat(F.lit("Online "), "region").alias("store_name"), F.lit("Online").alias("city"),
        "region", "opening_date")
    return scd1_upsert(wh.star["dim_store"], updates.unionByName(online), natural_key="store_id",
                       surrogate_key="store_key")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly revenue by store over the warehouse built from sf0.001."""
    return marts.mart_monthly_revenue(derive_warehouse(spark, FLAGSHIP_DIR).star)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for table in schemas.SOURCE:
        q[f"stg_{table}"] = _staging(table)
    q["dim_date"] = _star("dim_date")
    q["dim_store"] = _star("dim_store")
    q["dim_employee"] = _star("dim_employee")
    q["dim_product"] = _star("dim_product")
    q["dim_customer_initial"] = _star("dim_customer")
    q["customer_city_changes"] = q_customer_changes
    q["dim_customer_scd2"] = _star("dim_customer", after=True)
    q["customer_history"] = q_customer_history
    q["fact_sales"] = q_fact_sales
    q["fact_sales_heavy_orders"] = q_fact_sales_heavy_orders
    q["fact_sales_as_of"] = q_fact_sales_as_of
    q["fact_sales_as_of_open_first"] = q_fact_sales_as_of_open_first
    for name in marts.MARTS:
        q[name] = _mart(name)
    q["mart_customer_geography_after_scd2"] = _mart("mart_customer_geography", after=True)
    q["mart_customer_cohorts_after_scd2"] = _mart("mart_customer_cohorts", after=True)
    for name in marts.MART_ORDER:
        q[f"{name}_ordered"] = _ordered(name)
    q["fact_sales_two_batches"] = q_fact_sales_two_batches
    for name in marts.MARTS:
        q[f"{name}_two_batches"] = _mart_two_batches(name)
    q["dim_customer_replay"] = q_dim_customer_replay
    q["dim_customer_key_folders"] = q_dim_customer_key_folders
    q["customer_change_set"] = q_customer_change_set
    q["dim_customer_snapshot"] = q_dim_customer_snapshot
    q["mart_customer_geography_spellings"] = q_geography_spellings
    q["mart_customer_geography_any_case"] = q_geography_any_case
    q["top_product"] = q_top_product
    q["row_count_report"] = q_row_count_report
    q["dq_checks"] = q_dq_checks
    q["dq_orphan_keys"] = q_dq_orphan_keys
    q["dq_revenue_reconciliation"] = q_dq_revenue_reconciliation
    q["dq_multiple_current"] = q_dq_multiple_current
    q["scd1_upsert_store"] = q_scd1_upsert_store
    if llm_queries is not None:
        q.update(llm_queries.queries())
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    statements = sql_oracle.oracle_statements()
    # Two batches give what one load gives.
    for name in ("fact_sales", *marts.MARTS):
        statements[f"{name}_two_batches"] = statements[name]
    if llm_oracle is not None:
        statements = {**statements, **llm_oracle.oracle_sql()}
        if corpus_pipeline.ORACLE_SQL is not None:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: statements[name] for name in queries() if name in statements}
