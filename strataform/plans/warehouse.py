"""The layered build: source -> staging -> star schema -> SCD2 batch -> marts.

Ways to run it:

* ``derive_warehouse`` gives every layer as DataFrames over the driver tables,
  each table built when it is first asked for; used by the registered queries.
* ``run_build`` is the audited job, over the driver tables or given source
  tables: each step writes its layer as Parquet under a new run folder of
  ``out_root`` and the next step reads what was written (a lineage cut that also
  survives lost executors), stops at the first failure, and returns an audit
  table ``(step, description, layer, tables, rows, seconds, status)`` that is
  also written to ``audit/steps``.  Only when all checks pass does
  ``out_root`` publish the new run (``sources.published``).
* ``plans.increments`` takes a published warehouse one step on: a further SCD2
  batch, further sales; what does not change is not rewritten.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import dimensions as dims
from ..operators.constraints import fingerprint, raise_violations, rule_counts
from ..operators.facts import fact_sales
from ..operators.scd import scd2_apply
from ..operators.staging import extract
from ..session import (apply_required_conf, local_table, scratch_scope, scratch_table,
                       written_once)
from ..sources import driver_tables
from ..sources.io import conform, table_path, write_bucketed_table, write_table
from ..sources.lazy import LazyTables, once
from ..sources.published import new_run, publish_tables
from .marts import MARTS, publish_marts
from .quality import CHECK_SCHEMA, evaluate_checks

Builder = Callable[[], DataFrame]

AUDIT_SCHEMA = T.StructType([
    T.StructField("step", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("layer", T.StringType(), True),
    T.StructField("tables", T.IntegerType(), False),
    T.StructField("rows", T.LongType(), True),
    T.StructField("seconds", T.DoubleType(), False),
    T.StructField("status", T.StringType(), False),
])


@dataclass
class Warehouse:
    """Tables by name, each built when it is first asked for."""

    source: Mapping[str, DataFrame]
    staging: Mapping[str, DataFrame]
    star: Mapping[str, DataFrame]         # after the initial load
    star_after: Mapping[str, DataFrame]   # after the change batch
    _changes: Callable[[], DataFrame]
    kept: dict = field(default_factory=dict)  # what callers derive once and keep

    @property
    def changes(self) -> DataFrame:
        """The SCD2 change batch."""
        return self._changes()


def customer_city_changes(tables: dict[str, DataFrame]) -> DataFrame:
    """Change batch derived from the data: a customer moves to the city of the
    store of their latest order, effective on that order's date, when that
    city differs from the one on file.

    ``tables`` holds ``sales_orders``, ``stores`` and ``customers`` (source
    tables or their staged copies, which hold the same rows; staged copies
    are cheaper to read than re-deriving the source).  The latest order per
    customer is a map-side ``max_by``, so a customer with many orders is
    reduced before the shuffle.
    """
    o = tables["sales_orders"].where(F.col("customer_id").isNotNull())
    last = o.groupBy("customer_id").agg(F.max_by(
        F.struct("order_date", "store_id"), F.struct("order_date", "order_id")).alias("_last"))
    stores = tables["stores"].select("store_id", F.col("city").alias("store_city"))
    cust = tables["customers"].select("customer_id", F.col("city").alias("home_city"))
    moves = (last.select("customer_id", F.col("_last.order_date").alias("change_date"),
                         F.col("_last.store_id").alias("store_id"))
             .join(stores, "store_id").join(cust, "customer_id")
             .where(~F.col("store_city").eqNullSafe(F.col("home_city"))))
    return moves.select("customer_id", "change_date", F.col("store_city").alias("city"))


def star_builders(spark: SparkSession, staging: Mapping[str, DataFrame],
                  key_mode: str = "current",
                  calendar: tuple[dt.date, dt.date] | None = None) -> Mapping[str, DataFrame]:
    """Dimensions and fact from the staging layer, each on first use.

    A numbered dimension is written once, so that no reader numbers it again.
    """
    def keyed(name: str, build: Builder) -> Builder:
        return lambda: written_once(build, spark, name)

    tables = LazyTables({
        "dim_date": lambda: dims.dim_date_for_orders(spark, staging["stg_sales_orders"], calendar),
        "dim_store": keyed("dim_store", lambda: dims.dim_store(staging["stg_stores"])),
        "dim_employee": keyed("dim_employee", lambda: dims.dim_employee(
            staging["stg_employees"], tables["dim_store"])),
        "dim_product": keyed("dim_product", lambda: dims.dim_product(
            staging["stg_products"], staging["stg_categories"])),
        "dim_customer": keyed("dim_customer", lambda: dims.dim_customer_initial(
            staging["stg_customers"])),
        "fact_sales": keyed("fact_sales", lambda: fact_sales(
            staging["stg_sales_order_items"], staging["stg_sales_orders"],
            staging["stg_product_returns"], tables["dim_customer"], tables["dim_product"],
            tables["dim_store"], tables["dim_employee"], key_mode=key_mode, headers_last=True)),
    })
    return tables


def after_changes(star: Mapping[str, DataFrame], changes: Callable[[], DataFrame],
                  spark: SparkSession) -> Mapping[str, DataFrame]:
    """The incremental SCD2 step: only ``dim_customer`` changes; facts keep
    the keys they were loaded with."""
    builders = {name: (lambda name=name: star[name]) for name in star}
    builders["dim_customer"] = lambda: written_once(
        lambda: scd2_apply(star["dim_customer"], changes()), spark, "dim_customer_v2")
    return LazyTables(builders)


def _staged(staging: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """Staged copies under their source names (same rows and columns)."""
    return LazyTables({name[len("stg_"):]: (lambda name=name: staging[name]) for name in staging})


_CACHE: dict[tuple, Warehouse] = {}
_CACHE_LOCK = threading.Lock()


def _files_now(spark: SparkSession, sf_dir: str) -> tuple:
    """What identifies the input files: their number and a sum over path,
    size and time of change (their contents are not read)."""
    paths = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in driver_tables.DRIVER_TABLES]
    files = spark.read.format("binaryFile").load(paths)
    row = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64(
        "path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return tuple(row)


def derive_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All layers over the driver tables in ``sf_dir``, built on first use.

    Kept per application and as long as the input files stay the same.
    """
    apply_required_conf(spark)
    cache_key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _files_now(spark, sf_dir))
    with _CACHE_LOCK:
        if cache_key not in _CACHE:
            _CACHE[cache_key] = _derive(spark, sf_dir)
        return _CACHE[cache_key]


def _derive(spark: SparkSession, sf_dir: str) -> Warehouse:
    source = driver_tables.source_tables(spark, sf_dir)
    staging = LazyTables({f"stg_{name}": (lambda name=name: extract(source[name], name))
                          for name in source})
    star = star_builders(spark, staging)
    changes = once(lambda: scratch_table(customer_city_changes(_staged(staging)), "changes"))
    return Warehouse(source, staging, star, after_changes(star, changes, spark), changes)


def row_count_report(staging: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """Row counts by layer: staged items, fact, customer versions, calendar."""
    def count(df: DataFrame, layer: str, table: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count")
    return (count(staging["stg_sales_order_items"], "staging", "stg_sales_order_items")
            .unionByName(count(star["fact_sales"], "star", "fact_sales"))
            .unionByName(count(star["dim_customer"], "star", "dim_customer"))
            .unionByName(count(star["dim_date"], "star", "dim_date")))


# --------------------------------------------------------------------------
# Audited layered job
# --------------------------------------------------------------------------


# Staged tables bucketed on the key of the fact's largest join.
BUCKETED = {"stg_sales_order_items": "order_id", "stg_sales_orders": "order_id"}

# Tables stored in one folder per value of a column.  Customer versions are
# split by ``is_current``: loads and the geography mart read current
# versions only, and partition pruning skips the closed history.
PARTITIONED = {"dim_customer": ["is_current"], "dim_customer_v2": ["is_current"]}

# Declared schema of tables whose name differs from their declaration.
DECLARED_AS = {"dim_customer_v2": "dim_customer"}


def build_database(spark: SparkSession, root: str) -> str:
    """Catalog database of one build (bucketed tables are registered there);
    its location is inside the build folder."""
    name = "strataform_" + hashlib.sha1(root.encode()).hexdigest()[:12]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{table_path(root, '_catalog', name)}'")
    return name


def _source_fields(staged: str) -> list[T.StructField]:
    """The columns a staged table has from its source table."""
    return schemas.SOURCE[staged[len("stg_"):]].fields


def write_layer(spark: SparkSession, builders: dict[str, Builder], root: str, layer: str,
                parallel: bool = True, bucketed: dict[str, str] | None = None,
                max_keys: dict[str, int] | None = None,
                contents: dict[str, object] | None = None) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Build and write each table of a layer; return the written tables (read
    back by their declared schema) and their row counts.

    Tables of one layer are independent, so they are built and written from
    a small thread pool: their Spark jobs run side by side and fill the
    cluster instead of queueing one after another.  Row counts come from an
    ``Observation`` on the write itself, not from a second job; for star
    tables the largest surrogate key is observed too and stored in
    ``max_keys`` when given.  The same pass counts rows that break the declared
    constraints of the table; any such row fails the layer.  With ``contents``
    given, staged tables get their fingerprint over the source columns there.
    """
    bucketed = bucketed or {}
    buckets = int(spark.conf.get("spark.strataform.buckets",
                                 spark.conf.get("spark.sql.shuffle.partitions")))
    database = build_database(spark, root) if bucketed else None

    def one(name: str) -> tuple[str, DataFrame, int]:
        # Scratch tables of the build are not needed once its table is written.
        with scratch_scope(spark):
            return write(name)

    def write(name: str) -> tuple[str, DataFrame, int]:
        obs = Observation(f"{layer}.{name}")
        path = table_path(root, layer, name)
        df = builders[name]()
        declared_as = DECLARED_AS.get(name, name)
        key = schemas.STAR_KEYS[declared_as][0] if declared_as in schemas.STAR_KEYS else None
        metrics = [F.count(F.lit(1)).alias("rows")]
        if key is not None and key in df.columns:
            metrics.append(F.max(key).alias("max_key"))
        if declared_as in schemas.ALL:
            metrics.extend(rule_counts(schemas.ALL[declared_as]))
        if contents is not None and name in schemas.STAGING:
            metrics.append(fingerprint(_source_fields(name)).alias("contents"))
        df = df.observe(obs, *metrics)
        if name in bucketed:
            table = f"{database}.{name}"
            write_bucketed_table(df, path, table, bucketed[name], buckets)
            written = conform(spark.table(table), schemas.ALL[name])
        else:
            write_table(df, path, partition_by=PARTITIONED.get(name, ()))
            # Read back with the writer's own schema: no inference job.
            written = spark.read.schema(df.schema).parquet(path)
            declared = schemas.ALL.get(DECLARED_AS.get(name, name))
            if declared is not None:
                written = conform(written, declared)
        observed = obs.get
        raise_violations(name, observed)
        if contents is not None and "contents" in observed:
            contents[name] = observed["contents"]
        if max_keys is not None and observed.get("max_key") is not None:
            max_keys[name] = int(observed["max_key"])
        return name, written, int(observed["rows"])

    names = list(builders)
    if parallel and len(names) > 1:
        with ThreadPoolExecutor(max_workers=min(8, len(names))) as pool:
            results = list(pool.map(one, names))
    else:
        results = [one(n) for n in names]
    return {n: df for n, df, _ in results}, {n: rows for n, _, rows in results}


def run_build(spark: SparkSession, sf_dir: str | None, out_root: str,
              changes: DataFrame | None = None,
              sources: Mapping[str, DataFrame] | None = None,
              calendar: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Run every layer in order with timings; stop at the first failure.

    The operational tables are ``sources`` (the eight tables by name, for
    example ``load_source_tables``), or derived from the driver tables in
    ``sf_dir``; staging is the first layer written.  ``calendar`` is the first
    and last day of ``dim_date``.
    """
    apply_required_conf(spark)
    with scratch_scope(spark):
        return _build(spark, sf_dir, out_root, new_run(out_root), changes, sources, calendar)


def _build(spark: SparkSession, sf_dir: str | None, root: str, out_root: str,
           changes: DataFrame | None, sources: Mapping[str, DataFrame] | None,
           calendar: tuple[dt.date, dt.date] | None) -> DataFrame:
    tables: dict[str, list[str]] = {}
    audit: list[tuple] = []
    state: dict[str, dict[str, DataFrame]] = {}
    batch: list[DataFrame] = []
    known: dict[str, object] = {}
    max_keys: dict[str, int] = {}

    def step_source():
        if sources is not None:
            missing = set(schemas.SOURCE) - set(sources)
            if missing:
                raise ValueError(f"missing source tables: {', '.join(sorted(missing))}")
            state["source"] = sources
        else:
            state["source"] = driver_tables.source_tables_now(spark, sf_dir)
        return "source", len(schemas.SOURCE), None

    def step_extract():
        src = state["source"]
        # Rows read from each source table are observed in the same job that
        # writes its staging copy (checks Q01-Q03 compare the two counts), and so
        # are fingerprints of their contents.
        names = list(schemas.SOURCE)
        read_obs = {name: Observation(f"source.{name}") for name in names}
        builders = {f"stg_{name}": (lambda name=name: extract(
            src[name].observe(read_obs[name], F.count(F.lit(1)).alias("n"),
                              fingerprint(schemas.SOURCE[name].fields).alias("contents")), name))
            for name in names}
        contents: dict[str, object] = {}
        state["staging"], rows = write_layer(spark, builders, out_root, "staging",
                                             bucketed=BUCKETED, contents=contents)
        differing = [name for name in names
                     if contents[f"stg_{name}"] != read_obs[name].get["contents"]]
        if differing:
            raise RuntimeError(f"staging differs from the source: {', '.join(differing)}")
        for name, short in (("sales_orders", "src_orders"), ("sales_order_items", "src_items"),
                            ("customers", "src_customers")):
            known[f"{short}.n"] = read_obs[name].get["n"]
        return "staging", len(rows), sum(rows.values())

    def step_dimensions():
        stg = state["staging"]
        store, rows = write_layer(
            spark, {"dim_store": lambda: dims.dim_store(stg["stg_stores"])}, out_root, "star",
            max_keys=max_keys)
        builders = {
            "dim_date": lambda: dims.dim_date_for_orders(spark, stg["stg_sales_orders"], calendar),
            "dim_employee": lambda: dims.dim_employee(stg["stg_employees"], store["dim_store"]),
            "dim_product": lambda: dims.dim_product(stg["stg_products"], stg["stg_categories"]),
            "dim_customer": lambda: dims.dim_customer_initial(stg["stg_customers"]),
        }
        others, more = write_layer(spark, builders, out_root, "star", max_keys=max_keys)
        state["initial"], rows = {**store, **others}, {**rows, **more}
        return "star", len(rows), sum(rows.values())

    def step_fact():
        # Facts take keys from the initial dimensions (the change batch runs
        # at the same time and does not re-key facts).
        stg, star = state["staging"], state["initial"]
        parts = spark.conf.get("spark.strataform.heavyParts", None)
        builders = {"fact_sales": lambda: fact_sales(
            stg["stg_sales_order_items"], stg["stg_sales_orders"], stg["stg_product_returns"],
            star["dim_customer"], star["dim_product"], star["dim_store"], star["dim_employee"],
            heavy_parts=int(parts) if parts else None)}
        written, rows = write_layer(spark, builders, out_root, "star")
        state["fact"] = written
        return "star", 1, rows["fact_sales"]

    def step_changes():
        # The change batch is kept as a table: it is the audit trail of what
        # was applied, and later steps read it instead of re-deriving it.
        incoming = (changes if changes is not None
                    else customer_city_changes(_staged(state["staging"])))
        logged, rows = write_layer(spark, {"customer_changes": lambda: incoming}, out_root,
                                   "audit")
        batch.append(logged["customer_changes"])
        return "audit", 1, rows["customer_changes"]

    def step_scd2():
        # Never overwrite the folder being read: the new version gets its own.
        dim = state["initial"]["dim_customer"]
        builders = {"dim_customer_v2": lambda: scd2_apply(
            dim, batch[0], max_key=max_keys.get("dim_customer"))}
        written, rows = write_layer(spark, builders, out_root, "star")
        state["changed"] = {"dim_customer": written["dim_customer_v2"]}
        return "star", 1, rows["dim_customer_v2"]

    def finish_load():
        state["star"] = {**state["initial"], **state["fact"], **state["changed"]}

    def step_marts():
        builders = {name: (lambda build=build: build(state["star"])) for name, build in MARTS.items()}
        state["marts"], rows = write_layer(spark, builders, out_root, "marts")
        return "marts", len(rows), sum(rows.values())

    def step_checks():
        # Source row counts were observed during the extract: not recounted.
        results = evaluate_checks(None, state["staging"], state["star"], batch[0],
                                  state["marts"], known)
        builders = {
            "checks": lambda: local_table(spark, results, CHECK_SCHEMA),
            "row_counts": lambda: row_count_report(state["staging"], state["star"]),
        }
        _, rows = write_layer(spark, builders, out_root, "audit")
        failed = [r[0] for r in results if not r[3]]
        if failed:
            raise RuntimeError(f"data-quality checks failed: {', '.join(failed)}")
        return "audit", len(rows), sum(rows.values())

    # Stages run in order; the steps of one stage are independent and run side
    # by side (the change batch needs only staging; the fact load and the
    # SCD2 batch both start from the initial dimensions).
    stages = [
        [("source", "read the operational tables (derived from the driver tables)",
          step_source)],
        [("extract", "copy the operational tables to staging", step_extract)],
        [("dimensions", "number and write the dimensions", step_dimensions),
         ("changes", "derive and log the customer change batch", step_changes)],
        [("fact", "resolve the keys of every order line", step_fact),
         ("scd2", "apply the change batch to the customers", step_scd2)],
        [("marts", "build the analytical marts", step_marts)],
        [("checks", "cross-layer data-quality checks and row counts", step_checks)],
    ]

    def timed(step):
        name, description, run = step
        t0 = time.perf_counter()
        try:
            layer, n_tables, rows = run()
            return (name, description, layer, n_tables, rows,
                    round(time.perf_counter() - t0, 3), "OK"), None
        except Exception as exc:  # fail fast, but keep the audit row
            return (name, description, None, 0, None,
                    round(time.perf_counter() - t0, 3), f"FAILED: {exc}"), exc

    failure = None
    started = time.perf_counter()
    for stage in stages:
        if len(stage) == 1:
            results = [timed(stage[0])]
        else:
            with ThreadPoolExecutor(max_workers=len(stage)) as pool:
                results = list(pool.map(timed, stage))
        for row, exc in results:
            audit.append(row)
            failure = failure or exc
        if failure is not None:
            break
        if stage[0][0] == "fact":
            finish_load()
    audit.append(("total", "whole build", None, sum(a[3] for a in audit),
                  sum(a[4] or 0 for a in audit if a[2] is not None),
                  round(time.perf_counter() - started, 3), "FAILED" if failure else "OK"))
    audit_df = local_table(spark, audit, AUDIT_SCHEMA)
    write_table(audit_df.coalesce(1), table_path(out_root, "audit", "steps"))
    if failure is not None:
        raise failure
    layers = {"staging": state["staging"], "star": state["star"], "marts": state["marts"]}
    for layer, found in layers.items():
        for name in found:
            stored = "dim_customer_v2" if (layer, name) == ("star", "dim_customer") else name
            tables[f"{layer}/{name}"] = [table_path(out_root, layer, stored)]
    for name in ("customer_changes", "checks", "row_counts", "steps"):
        tables[f"audit/{name}"] = [table_path(out_root, "audit", name)]
    publish_tables(spark, root, out_root, tables)
    # The marts as views that follow the star schema just published.
    publish_marts(state["star"])
    return audit_df
