"""Further batches on a published warehouse: changes of customers, and sales.

``append_sales`` keeps the fact in one folder for each sales month and the partial
aggregates of the marts beside it (``partials``).  A batch writes

* its new lines, in new folders of their months;
* the months in which lines sold before are returned now: those months are read,
  marked and written again, every other folder stays as it is;
* the partials of the months touched: months with new lines only are merged from
  the stored partials and the new rows, rewritten months are computed again.

The marts are made from partials and dimensions, so no step of an ordinary batch
scans the whole fact but for the ids and dates of its lines, which decide whether
a line is loaded already and where a late return belongs.  The first batch on a
warehouse that ``run_build`` wrote deals its fact by month once.

``apply_batch`` keeps the customers in folders by a hash of their id
(``operators.scd_folders``): a batch of changes reads and replaces the folders of
the customers it names, and no others.  The first such batch deals them once, into
``spark.strataform.key_folders`` folders (64 unless set).

Every batch adds to the published staging and writes its own audit: steps, checks
and row counts.  Everything is published as one version; a batch that fails, or
that started from a version another writer has followed already, changes nothing
(``sources.published``).
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.constraints import write_checked
from ..operators.facts import fact_sales
from ..operators.late_returns import returns_per_line, with_late_returns
from ..operators.scd_folders import apply_to_folders, deal_dimension, reopened
from ..session import apply_required_conf, local_table, scratch_scope
from ..sources.io import table_path, write_table
from ..sources.key_folders import dealt_into, split_folders
from ..sources.published import (folders_of, folders_outside, month_of, new_run, publish_tables,
                                 published, read_folders, write_months)
from .marts import MARTS, publish_marts
from .partials import (MONTH, PARTIALS, by_kind, marts_from, merged, partial_schema, partial_tables,
                       sales_month)
from .quality import CHECK_SCHEMA, failed_batch
from .warehouse import AUDIT_SCHEMA, row_count_report, write_layer

STAGED = ("stg_sales_order_items", "stg_sales_orders", "stg_product_returns")


class Batch:
    """One batch: the version it started from, its run folder, and its audit."""

    def __init__(self, spark: SparkSession, root: str):
        apply_required_conf(spark)
        self.spark, self.root, self.run = spark, root, new_run(root)
        self.base = published(spark, root)
        self.tables: dict[str, list[str]] = dict(self.base["tables"])
        self.state: dict[str, int] = dict(self.base.get("state", {}))
        self.steps: list[tuple] = []
        self.checks: list[tuple] = []

    def path(self, layer: str, table: str) -> str:
        return table_path(self.run, layer, table)

    def read(self, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        return read_folders(self.spark, self.tables[f"{layer}/{table}"], schema)

    def star(self) -> dict[str, DataFrame]:
        return {name: self.read("star", name, schema) for name, schema in schemas.STAR.items()}

    @contextmanager
    def step(self, name: str, description: str, layer: str):
        """Time a step; the number of rows it puts in the list is recorded."""
        t0, rows = time.perf_counter(), []
        try:
            yield rows
        except Exception as failure:
            self.steps.append((name, description, layer, 0, None,
                               round(time.perf_counter() - t0, 3), f"FAILED: {failure}"))
            self._write_steps()
            raise
        self.steps.append((name, description, layer, len(rows), sum(rows) if rows else None,
                           round(time.perf_counter() - t0, 3), "OK"))

    def check(self, check_id: str, description: str, violations: int) -> None:
        self.checks.append((check_id, description, int(violations), violations == 0))

    def _write_steps(self) -> None:
        write_table(local_table(self.spark, self.steps, AUDIT_SCHEMA).coalesce(1),
                    self.path("audit", "steps"))

    def finish(self) -> None:
        """Write the audit, stop at failed checks, else publish all tables."""
        spark = self.spark
        staging = {"stg_sales_order_items": self.read("staging", "stg_sales_order_items")}
        write_table(local_table(spark, self.checks, CHECK_SCHEMA).coalesce(1),
                    self.path("audit", "checks"))
        write_table(row_count_report(staging, self.star()), self.path("audit", "row_counts"))
        self._write_steps()
        failed = [c[0] for c in self.checks if not c[3]]
        if failed:
            raise RuntimeError(f"data-quality checks failed: {', '.join(failed)}")
        for name in ("steps", "checks", "row_counts"):
            self.tables[f"audit/{name}"] = [self.path("audit", name)]
        publish_tables(spark, self.root, self.run, self.tables, after=self.base["version"],
                       state=self.state)
        publish_marts(self.star())


def published_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The star schema last published under ``root``."""
    tables = published(spark, root)["tables"]
    return {name: read_folders(spark, tables[f"star/{name}"], schema)
            for name, schema in schemas.STAR.items()}


def _write_partials(batch: Batch, tables: Mapping[str, DataFrame], replaced: set[int],
                    layer: str = "partials") -> int:
    """Write partials by month in place of those of the months ``replaced``."""
    for name in PARTIALS:
        written = write_months(tables[name], batch.path(layer, name), F.col(MONTH))
        kept = folders_outside(batch.tables.get(f"partials/{name}", []), replaced)
        batch.tables[f"partials/{name}"] = kept + written
    return len(PARTIALS)


def _stored_partials(batch: Batch, months: set[int] | None = None) -> dict[str, DataFrame]:
    out = {}
    for name in PARTIALS:
        folders = batch.tables[f"partials/{name}"]
        out[name] = read_folders(batch.spark, folders if months is None else folders_of(
            folders, months), partial_schema(name))
    return out


def _write_marts(batch: Batch) -> None:
    """The marts from partials and dimensions; without partials, from the fact."""
    star = batch.star()
    if f"partials/{PARTIALS[0]}" in batch.tables:
        made = marts_from(_stored_partials(batch), star)
    else:
        made = {name: build(star) for name, build in MARTS.items()}
    with batch.step("marts", "make the marts", "marts") as rows:
        _, written = write_layer(batch.spark, {n: (lambda n=n: made[n]) for n in made}, batch.run,
                                 "marts")
        rows.extend(written.values())
    for name in made:
        batch.tables[f"marts/{name}"] = [batch.path("marts", name)]


def _deal_by_month(batch: Batch) -> None:
    """Once for a warehouse: the fact in month folders, and its partials."""
    folders = batch.tables["star/fact_sales"]
    if f"partials/{PARTIALS[0]}" in batch.tables:
        return
    with batch.step("months", "deal the fact by month, make its partials", "star") as rows:
        if any(month_of(f) is None for f in folders):
            batch.tables["star/fact_sales"] = write_months(
                batch.star()["fact_sales"], batch.path("star", "fact_by_month"), sales_month())
        star = batch.star()
        rows.append(_write_partials(
            batch, partial_tables(star["fact_sales"], star["dim_customer"]), set(),
            "partials_of_load"))


def _dealt_customers(batch: Batch):
    """The customers in key folders; dealt now if no batch has done so yet."""
    folders = batch.tables["star/dim_customer"]
    if dealt_into(folders) is None:
        number = int(batch.spark.conf.get("spark.strataform.key_folders", "64"))
        with batch.step("deal", "deal the customers into key folders", "star") as rows:
            dealt = deal_dimension(batch.star()["dim_customer"],
                                   batch.path("star", "dim_customer_dealt"), folders=number)
            rows.append(batch.spark.read.schema(schemas.STAR["dim_customer"]).parquet(
                *dealt.paths).count())
        batch.tables["star/dim_customer"] = dealt.paths
        return dealt
    return reopened(folders, batch.state["max_customer_key"])


def apply_batch(spark: SparkSession, root: str, changes: DataFrame) -> None:
    """Apply a further SCD2 batch to the published customers.

    The folders of the changed customers and the marts are written to a new run
    folder, checked, and published together; the batch is added to the log of
    changes.
    """
    schema = schemas.STAR["dim_customer"]
    with scratch_scope(spark):
        batch = Batch(spark, root)
        dealt = _dealt_customers(batch)
        with batch.step("changes", "log the changes", "audit") as rows:
            logged, n = write_layer(spark, {"customer_changes": lambda: changes}, batch.run, "audit")
            rows.extend(n.values())
        log = logged["customer_changes"]
        with batch.step("scd2", "apply the changes to the folders they touch", "star") as rows:
            after = apply_to_folders(spark, dealt, log, batch.path("star", "dim_customer"), schema)
            old, _ = split_folders(dealt.paths, set(after.touched))
            written = read_folders(spark, list(after.written), schema)
            rows.append(written.count())
        failed = failed_batch(read_folders(spark, old, schema), written, log)
        batch.check("B10", "customer versions follow the changes", len(failed))
        if failed:
            raise RuntimeError(f"data-quality checks failed: {', '.join(failed)}")
        batch.tables["star/dim_customer"] = after.paths
        batch.state["max_customer_key"] = after.max_key
        batch.tables["audit/customer_changes"] = [*batch.tables["audit/customer_changes"],
                                                  batch.path("audit", "customer_changes")]
        _write_marts(batch)
        batch.finish()


def append_sales(spark: SparkSession, root: str, items: DataFrame, orders: DataFrame,
                 returns: DataFrame) -> int:
    """Append staged sales to the published warehouse; the number of rows the fact
    has gained for the new lines.

    ``returns`` may be of new lines or of lines loaded before.  A line whose keys
    do not resolve, that the fact already holds, or whose day the calendar lacks,
    and a return of an unknown line, fail the batch.
    """
    with scratch_scope(spark):
        batch = Batch(spark, root)
        _deal_by_month(batch)
        return _append(batch, {"stg_sales_order_items": items, "stg_sales_orders": orders,
                               "stg_product_returns": returns})


def _append(batch: Batch, staged: Mapping[str, DataFrame]) -> int:
    spark, star = batch.spark, batch.star()
    with batch.step("extract", "add the batch to staging", "staging") as rows:
        written, n = write_layer(spark, {name: (lambda name=name: staged[name])
                                         for name in STAGED}, batch.run, "staging")
        rows.extend(n.values())
    items, orders, returns = (written[name] for name in STAGED)
    for name in STAGED:
        batch.tables[f"staging/{name}"] = [*batch.tables[f"staging/{name}"],
                                           batch.path("staging", name)]
    old = star["fact_sales"]
    largest = old.agg(F.max("fact_id")).first()[0]
    schema = schemas.STAR["fact_sales"]
    with batch.step("fact", "load the new lines", "star") as rows:
        lines = fact_sales(
            items, orders, returns, star["dim_customer"], star["dim_product"], star["dim_store"],
            star["dim_employee"], fact_id_start=0 if largest is None else largest + 1)
        new_folders = write_checked(lines, "fact_sales", schema, lambda df: write_months(
            df, batch.path("star", "fact_sales"), sales_month()))
        added = read_folders(spark, new_folders, schema)
        n_added, last = added.agg(F.count(F.lit(1)), F.max("fact_id")).first()
        rows.append(n_added)
    lost = items.join(added, "order_item_id", "left_anti").limit(1).count()
    known = old.select("order_item_id").join(
        added.select("order_item_id").distinct(), "order_item_id", "left_semi").limit(1).count()
    days = added.join(star["dim_date"], "date_key", "left_anti").limit(1).count()
    if lost or known or days:
        raise RuntimeError("unresolved lines" if lost else
                           "lines already loaded" if known else "days outside the calendar")

    # Returns of lines sold before: which months hold them?
    late = returns.where(F.col("order_item_id").isNotNull()).join(
        items.select("order_item_id"), "order_item_id", "left_anti")
    wanted = returns_per_line(late).select("order_item_id")
    placed = old.select("order_item_id", sales_month().alias(MONTH)).join(
        wanted, "order_item_id", "left_semi").distinct()
    n_wanted = wanted.count()
    per_month = placed.groupBy(MONTH).count().collect()  # one row a month
    if sum(r["count"] for r in per_month) != n_wanted:
        raise RuntimeError("returns of unknown lines")
    rewritten = {r[MONTH] for r in per_month}
    old_folders = batch.tables["star/fact_sales"]
    marked_folders: list[str] = []
    if rewritten:
        with batch.step("returns", "mark returned lines of earlier batches", "star") as rows:
            before = read_folders(spark, folders_of(old_folders, rewritten), schema)
            start = max(x for x in (last, largest, -1) if x is not None) + 1
            marked_folders = write_checked(
                with_late_returns(before, late, start), "fact_sales", schema,
                lambda df: write_months(df, batch.path("star", "fact_returned"), sales_month()))
            rows.append(read_folders(spark, marked_folders, schema).count())
    batch.tables["star/fact_sales"] = [*folders_outside(old_folders, rewritten), *marked_folders,
                                       *new_folders]

    with batch.step("partials", "merge the partials of the months touched", "partials") as rows:
        grown = {month_of(f) for f in new_folders}
        touched = read_folders(spark, [*marked_folders, *new_folders], schema)
        fresh = partial_tables(touched, star["dim_customer"])
        stored = _stored_partials(batch, grown - rewritten)
        both = {name: merged(name, [fresh[name], stored[name]]) for name in PARTIALS}
        rows.append(_write_partials(batch, both, grown | rewritten))
    _write_marts(batch)
    _check_append(batch, items, added, touched, late, rewritten)
    batch.finish()
    return n_added


def _check_append(batch: Batch, items: DataFrame, added: DataFrame, touched: DataFrame,
                  late: DataFrame, rewritten: set[int]) -> None:
    """Checks of an append: over the batch, the rows written, and the partials."""
    sold = items.agg(F.sum(F.round(F.col("quantity") * F.col("unit_price_paid"), 2)),
                     F.count(F.lit(1))).first()
    once = added.dropDuplicates(["order_item_id"]).agg(F.sum("line_revenue"), F.count(F.lit(1))).first()
    batch.check("B04", "one line of the fact per staged line of the batch", abs(sold[1] - once[1]))
    batch.check("B08", "staged revenue of the batch equals its fact rows",
                (sold[0] or 0) != (once[0] or 0))
    unmarked = touched.where("is_returned = 0").join(
        returns_per_line(late), "order_item_id", "left_semi").limit(1).count()
    batch.check("B13", "no line returned in the batch is still kept", unmarked)
    kept = touched.where((F.col("is_returned") == 0) & sales_month().isin(*rewritten)).agg(
        F.sum("line_revenue")).first()[0] if rewritten else None
    partial = by_kind(_stored_partials(batch))["by_store"]
    of_months = partial.where(F.col(MONTH).isin(*rewritten)).agg(F.sum("revenue")).first()[0] \
        if rewritten else None
    batch.check("B15", "partials of rewritten months equal their rows", (kept or 0) != (of_months or 0))
    monthly = batch.read("marts", "mart_monthly_revenue").agg(F.sum("total_revenue")).first()[0]
    total = partial.agg(F.sum("revenue")).first()[0]
    batch.check("B16", "monthly mart revenue equals the partials", (monthly or 0) != (total or 0))
