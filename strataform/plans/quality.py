"""Cross-layer data-quality checks as Spark jobs.

``run_checks`` returns one row per check: ``check_id, description,
violations, passed``.  Every check is reduced to scalar measures: one job
profiles every staged and star table at once (rows, duplicate keys, NULL
cells, row-level rules), the others are small aggregates (anti-joins on
pre-aggregated keys, mart totals, SCD2 expectations).  The jobs are
submitted together from a thread pool so they run side by side; only their
small results (one row, or one row per profiled table) reach the driver,
where the check table is assembled.  (A single plan holding every measure
is slower: planning it dominates.)

Checks (ids follow the order of the original test script, extended):

Q01-Q03 rows read from the source equal rows written to staging (orders,
        items, customers)
Q04     one fact row per staged order item
Q05-Q07 no fact row with an unresolved date, customer, product key
Q07b/c  same for store and employee keys (declared, untested in the source)
Q08     staged revenue equals fact revenue to the cent
Q09     line margin = revenue - cost on every fact row
Q10-Q13 each changed customer: 1 + (applied changes) versions, exactly one
        current, current version carries the last change's city, the
        original version (smallest key; a late change can start before it)
        keeps the staged city
Q14     no closed version without ``valid_to`` (all customers)
Q15     no customer has two current versions
Q16     monthly mart revenue equals non-returned fact revenue
Q17     product mart has one row per (category, product name) sold
Q18     top product of the mart is the top product computed from the fact
Q19a-c  star primary keys unique, declared NOT NULL columns filled, employee
        store key resolves
Q19d    staged primary keys unique (also catches an order with 100 or more
        lines, whose derived order-item ids would collide)
Q19e    staged foreign keys resolve (NULL keys allowed)
Q19f    declared NOT NULL source columns are filled in staging
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import local_table
from .marts import mart_monthly_revenue, mart_product_performance

CHECK_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("violations", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])

Metrics = dict[str, object]


def side_by_side(frames: list[DataFrame]) -> DataFrame:
    """Columns of several one-row aggregates in one row, without a join: the
    values are stacked as text (exact for numbers), pivoted back and cast to
    their original types."""
    types = {c: t for f in frames for c, t in f.dtypes}
    long = None
    for f in frames:
        pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
                 for c in f.columns]
        part = f.select(F.inline(F.array(*pairs)))
        long = part if long is None else long.unionByName(part)
    wide = long.groupBy().pivot("metric", list(types)).agg(F.first("value"))
    return wide.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose ``key`` has no match in ``parent``, counted.

    NULL keys are not orphans (a nullable foreign key).  The child is first
    reduced to (key, rows) map-side, so the anti-join moves one row per
    distinct key instead of one per fact row.
    """
    per_key = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.join(parent.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def fact_orphans(star: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with an unresolved key, by foreign key, in one pass of the fact.

    The fact becomes (foreign key, key) pairs, counted map-side; the few
    distinct pairs left are compared with all dimensions' keys at once.
    """
    keys = list(schemas.FACT_FOREIGN_KEYS)
    pairs = star["fact_sales"].select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("foreign_key"), F.col(k).cast("bigint").alias("k"))
        for k in keys]))).where("k is not null").groupBy("foreign_key", "k").agg(
        F.count(F.lit(1)).alias("n"))
    known = None
    for k, dim in schemas.FACT_FOREIGN_KEYS.items():
        part = star[dim].select(F.lit(k).alias("foreign_key"), F.col(k).cast("bigint").alias("k"),
                                F.lit(True).alias("known"))
        known = part if known is None else known.unionByName(part)
    return pairs.join(known.distinct(), ["foreign_key", "k"], "left").groupBy("foreign_key").agg(
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("unresolved"))


def item_differences(items: DataFrame, fact: DataFrame) -> DataFrame:
    """Order items lost, doubled or unknown in the fact, added up per item id."""
    both = items.select("order_item_id", F.lit(1).alias("d")).unionByName(
        fact.select("order_item_id", F.lit(-1).alias("d")))
    return both.groupBy("order_item_id").agg(F.abs(F.sum("d")).alias("d")).agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("differences"))


def failed_batch(before: DataFrame, after: DataFrame, changes: DataFrame) -> list[str]:
    """Checks of a further SCD2 batch that fail: each changed customer gained one
    version a change (Q10), has one current version (Q11) with the last new
    city (Q12), and kept the versions it had (Q13); Q14 and Q15 as in the build."""
    order = F.struct("change_date", "city")
    had = before.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_before"))
    wanted = changes.join(had, "customer_id").groupBy("customer_id", "n_before").agg(
        F.count(F.lit(1)).alias("n_changes"), F.max_by("city", order).alias("last_city"))
    seen = after.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_current").alias("n_current"),
        F.max(F.when(F.col("is_current") == 1, F.col("city"))).alias("city"),
        F.count(F.when((F.col("is_current") == 0) & F.col("valid_to").isNull(), 1)).alias("open"))
    kept = ["customer_key", "customer_id", "city", "valid_from"]
    lost = before.select(*kept).join(after.select(*kept), kept, "left_anti").limit(1).count()
    row = seen.join(wanted, "customer_id", "left").agg(
        F.count(F.when(F.col("n") != F.col("n_before") + F.col("n_changes"), 1)).alias("Q10"),
        F.count(F.when(F.col("n_changes").isNotNull() & (F.col("n_current") != 1), 1)).alias("Q11"),
        F.count(F.when(F.col("n_changes").isNotNull()
                       & ~F.col("city").eqNullSafe(F.col("last_city")), 1)).alias("Q12"),
        F.sum("open").alias("Q14"), F.count(F.when(F.col("n_current") > 1, 1)).alias("Q15")).first()
    return sorted([c for c, n in row.asDict().items() if n] + ["Q13"] * bool(lost))


def combined_profiles(tables: dict[str, tuple[DataFrame, list[str], list[str], dict]]) -> DataFrame:
    """Profiles of many tables in one job: one row per table with ``n`` rows,
    ``dup`` duplicate rows of the key, ``nulls`` NULL cells in the required
    columns and the named row-level ``extras`` summed.

    ``tables`` maps a name to (frame, key of one or two columns, required columns,
    {measure: row-level expression}).  The tables are stacked twice: as (table, NULL
    cells, measures) rows that are added up per table before any shuffle, and as
    bare (table, key) rows, which alone are shuffled to find keys that come twice.
    """
    names, measures = list(tables), sorted({m for _, _, _, extra in tables.values() for m in extra})
    values, keys = [], []
    for i, (df, key, required, extra) in enumerate(tables.values()):
        nulls = sum((F.col(c).isNull().cast("int") for c in required), F.lit(0))
        values.append(df.select(
            F.lit(i).alias("_t"), nulls.alias("_nulls"),
            *[(extra[m] if m in extra else F.lit(None)).cast("decimal(38,2)").alias(m)
              for m in measures]))
        keys.append(df.select(
            F.lit(i).alias("_t"), F.col(key[0]).cast("bigint").alias("_k"),
            (F.col(key[1]).cast("string") if len(key) > 1 else F.lit(None).cast("string"))
            .alias("_k2")))
    totals = reduce(DataFrame.unionByName, values).groupBy("_t").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_nulls").alias("nulls"),
        *[F.sum(m).alias(m) for m in measures])
    repeats = reduce(DataFrame.unionByName, keys).groupBy("_t", "_k", "_k2").agg(
        F.count(F.lit(1)).alias("_n")).groupBy("_t").agg(F.sum(F.col("_n") - 1).alias("dup"))
    # A row for every table, so that an empty one has a profile too.
    every = totals.sparkSession.range(1).select(
        F.posexplode(F.array(*map(F.lit, names))).alias("_t", "t"))
    # One row a table on each side.
    return every.join(F.broadcast(totals), "_t", "left").join(
        F.broadcast(repeats), "_t", "left").select(
        "t", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n", "dup", "nulls")],
        *measures)


def _required(table: str) -> list[str]:
    return [f.name for f in schemas.STAR[table].fields if not f.nullable]


def _top_product(products: DataFrame) -> DataFrame:
    return products.orderBy(F.desc("total_revenue"), "category_name", "product_name").limit(1)


def _top_product_from_fact(star: dict[str, DataFrame]) -> DataFrame:
    """Best-selling (category, product name) by revenue, straight from the fact."""
    by_key = star["fact_sales"].groupBy("product_key").agg(F.sum("line_revenue").alias("r"))
    by_name = by_key.join(
        star["dim_product"].select("product_key", "category_name", "product_name"), "product_key"
    ).groupBy("category_name", "product_name").agg(F.sum("r").alias("total_revenue"))
    return _top_product(by_name)


def scd2_measures(dim_c: DataFrame, changes: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Per changed customer expectations, counted as violating customers."""
    order = F.struct("change_date", *[c for c in changes.columns if c == "change_seq"], "city")
    expected = changes.join(dim_c.select("customer_id"), "customer_id", "left_semi") \
        .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_changes"),
                                    F.max_by("city", order).alias("last_city"))
    observed = dim_c.join(expected.select("customer_id"), "customer_id", "left_semi") \
        .groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("n_versions"),
            F.sum("is_current").alias("n_current"),
            F.max(F.when(F.col("is_current") == 1, F.col("city"))).alias("current_city"),
            F.min_by("city", F.col("customer_key")).alias("first_city"))
    staged = stg_customers.select("customer_id", F.col("city").alias("staged_city"))
    both = expected.join(observed, "customer_id", "left").join(staged, "customer_id", "left")
    return both.agg(
        F.count(F.when(F.coalesce(F.col("n_versions"), F.lit(0)) != F.col("n_changes") + 1, 1))
        .alias("scd2_version_count"),
        F.count(F.when(F.coalesce(F.col("n_current"), F.lit(0)) != 1, 1)).alias("scd2_one_current"),
        F.count(F.when(~F.col("current_city").eqNullSafe(F.col("last_city")), 1))
        .alias("scd2_new_city"),
        F.count(F.when(~F.col("first_city").eqNullSafe(F.col("staged_city")), 1))
        .alias("scd2_old_city"))


def measure_jobs(source: dict[str, DataFrame] | None, staging: dict[str, DataFrame],
                 star: dict[str, DataFrame], changes: DataFrame | None = None,
                 marts: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """One small aggregate per group of measures (name prefix -> one-row frame,
    or a function building it)."""
    fact, dim_c = star["fact_sales"], star["dim_customer"]
    marts = marts or {}
    monthly = marts.get("mart_monthly_revenue")
    monthly = mart_monthly_revenue(star) if monthly is None else monthly
    products = marts.get("mart_product_performance")
    products = mart_product_performance(star) if products is None else products
    count = F.count(F.lit(1))
    jobs = {}
    # Every staged and star table profiled in one job (rows, duplicate keys,
    # NULL cells) with the row-level rules of the fact and the customers.
    profiled = {}
    for table, keys in schemas.SOURCE_KEYS.items():
        extra = {}
        if table == "sales_order_items":
            extra = {"revenue": F.col("quantity") * F.col("unit_price_paid")}
        required = [f.name for f in schemas.SOURCE[table].fields if not f.nullable]
        profiled[f"stg_{table}"] = (staging[f"stg_{table}"], keys, required, extra)
    star_extra = {
        "fact_sales": {
            "revenue": F.col("line_revenue"),
            "revenue_kept": F.when(F.col("is_returned") == 0, F.col("line_revenue")),
            "margin_mismatch": (F.col("line_margin") != F.round(
                F.col("line_revenue") - F.col("line_cost"), 2)).cast("int"),
        },
        "dim_customer": {
            "closed_without_end": ((F.col("is_current") == 0)
                                   & F.col("valid_to").isNull()).cast("int"),
        },
    }
    for table in schemas.STAR_KEYS:
        key, natural = schemas.STAR_KEYS[table]
        # The fact's generated id is unique by construction: its natural key counts.
        first = natural if table == "fact_sales" else [key]
        profiled[table] = (star[table], first, _required(table), star_extra.get(table, {}))
    profiled["dim_customer_natural"] = (
        dim_c, schemas.STAR_KEYS["dim_customer"][1], [], {})
    jobs["profiles"] = lambda: combined_profiles(profiled)
    for child, col, parent in schemas.SOURCE_FOREIGN_KEYS:
        jobs[f"stgfk_{child}_{col}"] = (lambda c=child, k=col, p=parent: orphan_rows(
            staging[f"stg_{c}"], staging[f"stg_{p}"], k))
    jobs.update({
        "orphan_employee_store": orphan_rows(star["dim_employee"], star["dim_store"], "store_key"),
        "multi_current": dim_c.groupBy("customer_id").agg(F.sum("is_current").alias("c")).agg(
            F.count(F.when(F.col("c") > 1, 1)).alias("n")),
        "mart": monthly.agg(F.round(F.sum("total_revenue"), 2).alias("revenue")),
        "product_mart": products.agg(count.alias("n")),
        "products_sold": fact.select("product_key").distinct().join(
            star["dim_product"].select("product_key", "category_name", "product_name"),
            "product_key").select("category_name", "product_name").distinct().agg(count.alias("n")),
        "top_mart": _top_product(products).select("category_name", "product_name"),
        "top_fact": _top_product_from_fact(star).select("category_name", "product_name"),
    })
    if source is not None:
        jobs["src_orders"] = source["sales_orders"].agg(count.alias("n"))
        jobs["src_items"] = source["sales_order_items"].agg(count.alias("n"))
        jobs["src_customers"] = source["customers"].agg(count.alias("n"))
    jobs["orphans"] = lambda: fact_orphans(star).agg(*[
        F.max(F.when(F.col("foreign_key") == fk, F.col("unresolved"))).alias(fk)
        for fk in schemas.FACT_FOREIGN_KEYS])
    jobs["item"] = lambda: item_differences(staging["stg_sales_order_items"], fact)
    if changes is not None:
        jobs["scd2"] = lambda: scd2_measures(dim_c, changes, staging["stg_customers"])
    return jobs


def collect_measures(jobs: dict[str, DataFrame], workers: int = 8) -> Metrics:
    """Run the measure jobs side by side; ``prefix.column`` -> scalar.

    A job may also be given as a function returning its DataFrame, so that
    building (and analysing) it happens in the worker thread too.
    """
    def one(name: str) -> list[tuple[str, dict]]:
        job = jobs[name]
        df = job() if callable(job) else job
        if "t" in df.columns:  # one row per profiled table (bounded by the table count)
            return [(r["t"], r.asDict()) for r in df.collect()]
        row = df.first()
        return [(name, {} if row is None else row.asDict())]

    with ThreadPoolExecutor(max_workers=workers) as pool:
        results = [item for items in pool.map(one, list(jobs)) for item in items]
    return {f"{name}.{col}": value for name, row in results for col, value in row.items()}


def _num(v) -> Decimal:
    return Decimal(0) if v is None else Decimal(v)


def _check_specs(with_changes: bool) -> list[tuple[str, str, Callable[[Metrics], int]]]:
    def diff(a: str, b: str) -> Callable[[Metrics], int]:
        return lambda m: int(abs(_num(m[a]) - _num(m[b])))

    def differs(a: str, b: str) -> Callable[[Metrics], int]:
        return lambda m: 0 if m[a] == m[b] else 1

    def value(a: str) -> Callable[[Metrics], int]:
        return lambda m: int(_num(m[a]))

    def total(measure: str, tables, prefix: str = "") -> Callable[[Metrics], int]:
        return lambda m: sum(int(_num(m[f"{prefix}{t}.{measure}"])) for t in tables)

    def same_top(m: Metrics) -> int:
        mart = (m.get("top_mart.category_name"), m.get("top_mart.product_name"))
        fact = (m.get("top_fact.category_name"), m.get("top_fact.product_name"))
        return 0 if mart == fact else 1

    specs = [
        ("Q01", "staged orders equal source orders", diff("stg_sales_orders.n", "src_orders.n")),
        ("Q02", "staged order items equal source items",
         diff("stg_sales_order_items.n", "src_items.n")),
        ("Q03", "staged customers equal source customers",
         diff("stg_customers.n", "src_customers.n")),
        ("Q04", "one fact row per staged order item",
         value("item.differences")),
        ("Q05", "no fact row with an unresolved date_key", value("orphans.date_key")),
        ("Q06", "no fact row with an unresolved customer_key", value("orphans.customer_key")),
        ("Q07", "no fact row with an unresolved product_key", value("orphans.product_key")),
        ("Q07b", "no fact row with an unresolved store_key", value("orphans.store_key")),
        ("Q07c", "no fact row with an unresolved employee_key", value("orphans.employee_key")),
        ("Q08", "staged revenue equals fact revenue to the cent",
         differs("stg_sales_order_items.revenue", "fact_sales.revenue")),
        ("Q09", "line_margin equals line_revenue minus line_cost",
         value("fact_sales.margin_mismatch")),
        ("Q14", "every closed customer version has a valid_to",
         value("dim_customer.closed_without_end")),
        ("Q15", "no customer has two current versions", value("multi_current.n")),
        ("Q16", "monthly mart revenue equals non-returned fact revenue",
         differs("mart.revenue", "fact_sales.revenue_kept")),
        ("Q17", "product mart has one row per product name sold",
         diff("product_mart.n", "products_sold.n")),
        ("Q18", "top product of the mart is the top product of the fact", same_top),
        ("Q19a", "star primary keys are unique", total("dup", [*schemas.STAR_KEYS, "dim_customer_natural"])),
        ("Q19b", "declared NOT NULL star columns are filled", total("nulls", schemas.STAR_KEYS)),
        ("Q19c", "every employee's store_key resolves", value("orphan_employee_store.n")),
        ("Q19d", "staged primary keys are unique",
         total("dup", schemas.SOURCE_KEYS, prefix="stg_")),
        ("Q19e", "staged foreign keys resolve",
         lambda m: sum(int(_num(m[f"stgfk_{c}_{k}.n"]))
                       for c, k, _ in schemas.SOURCE_FOREIGN_KEYS)),
        ("Q19f", "declared NOT NULL source columns are filled in staging",
         total("nulls", schemas.SOURCE_KEYS, prefix="stg_")),
    ]
    if with_changes:
        specs[11:11] = [
            ("Q10", "each changed customer has 1 + its changes versions",
             value("scd2.scd2_version_count")),
            ("Q11", "each changed customer has exactly one current version",
             value("scd2.scd2_one_current")),
            ("Q12", "current version shows the last new city", value("scd2.scd2_new_city")),
            ("Q13", "original version keeps the staged city", value("scd2.scd2_old_city")),
        ]
    return specs


def check_rows(measures: Metrics, with_changes: bool) -> list[tuple]:
    rows = []
    for cid, desc, rule in _check_specs(with_changes):
        violations = rule(measures)
        rows.append((cid, desc, violations, violations == 0))
    return rows


def evaluate_checks(source: dict[str, DataFrame] | None, staging: dict[str, DataFrame],
                    star: dict[str, DataFrame], changes: DataFrame | None = None,
                    marts: dict[str, DataFrame] | None = None,
                    known: Metrics | None = None) -> list[tuple]:
    """Check rows ``(check_id, description, violations, passed)``.

    ``known`` holds measures already observed elsewhere (for example the
    source row counts observed while extracting); they are not recomputed.
    """
    jobs = measure_jobs(source, staging, star, changes, marts)
    known = dict(known or {})
    for name in [n for n in jobs if any(k.startswith(f"{n}.") for k in known)]:
        del jobs[name]
    measures = {**collect_measures(jobs), **known}
    return check_rows(measures, changes is not None)


def run_checks(source: dict[str, DataFrame] | None, staging: dict[str, DataFrame],
               star: dict[str, DataFrame], changes: DataFrame | None = None,
               marts: dict[str, DataFrame] | None = None,
               known: Metrics | None = None) -> DataFrame:
    """One row per check: ``check_id, description, violations, passed``."""
    rows = evaluate_checks(source, staging, star, changes, marts, known)
    return local_table(staging["stg_customers"].sparkSession, rows, CHECK_SCHEMA)
