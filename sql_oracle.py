"""Independent SQL statements of every registered query, for DuckDB.

Each statement is built from the layer definitions below (common table
expressions over the driver tables), written directly from the documented
semantics rather than from the Spark code.  Conventions that make the two
engines comparable:

* integer sums are cast to BIGINT, money sums to DECIMAL(22,2);
* percentages are rounded half away from zero with exact integer arithmetic
  (DuckDB divides decimals as doubles), then returned as DOUBLE;
* calendar fields are cast to INTEGER; DuckDB counts Sunday as weekday 0;
* surrogate keys are ``row_number()`` in natural-key order; new SCD2 versions
  take ``max(key) + row_number()``;
* ``_loaded_at`` and ``fact_id`` are left out (load time, non-dense id).
"""

from __future__ import annotations

# Fixed values shared with the source derivation (strataform.sources.driver_tables).
ROLES_SQL = "['Sales Assistant', 'Senior Assistant', 'Floor Lead', 'Branch Manager']"

SOURCE_CTES = f"""
src_stores AS (
    SELECT CAST(n.n_nationkey AS BIGINT) AS store_id, n.n_name AS store_name, n.n_name AS city,
           r.r_name AS region, DATE '1990-01-01' AS opening_date
    FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
),
src_employees AS (
    SELECT CAST(s_suppkey AS BIGINT) AS employee_id, s_name AS full_name,
           CAST(s_nationkey AS BIGINT) AS store_id,
           CAST(DATE '1990-01-01' + CAST(((s_suppkey % 1461) + 1461) % 1461 AS INTEGER) AS DATE) AS hire_date,
           ({ROLES_SQL})[CAST(((s_suppkey % 4) + 4) % 4 AS INTEGER) + 1] AS role
    FROM supplier
),
src_categories AS (
    SELECT CAST(row_number() OVER (ORDER BY category_name) AS BIGINT) AS category_id, category_name
    FROM (SELECT DISTINCT p_type AS category_name FROM part) t
),
src_products AS (
    SELECT CAST(p.p_partkey AS BIGINT) AS product_id, p.p_name AS product_name, c.category_id,
           CAST(round(CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(2,2)), 2) AS DECIMAL(10,2)) AS unit_cost,
           CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price
    FROM part p JOIN src_categories c ON c.category_name = p.p_type
),
src_customers AS (
    SELECT CAST(c.c_custkey AS BIGINT) AS customer_id, c.c_name AS full_name, n.n_name AS city,
           CAST(DATE '1995-01-01' + CAST(((c.c_custkey % 365) + 365) % 365 AS INTEGER) AS DATE) AS signup_date,
           CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS loyalty_member
    FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
),
src_lines AS (
    SELECT li.*,
           row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount,
                                       l_returnflag, l_shipdate) AS order_item_id
    FROM lineitem li
),
src_sales_order_items AS (
    SELECT CAST(x.order_item_id AS BIGINT) AS order_item_id, CAST(x.l_orderkey AS BIGINT) AS order_id,
           CAST(x.l_partkey AS BIGINT) AS product_id, CAST(x.l_quantity AS INTEGER) AS quantity,
           CAST(round(CAST(p.p_retailprice AS DECIMAL(10,2)) * (1 - CAST(x.l_discount AS DECIMAL(5,2))), 2) AS DECIMAL(10,2)) AS unit_price_paid,
           CAST(CAST(x.l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS discount_pct
    FROM src_lines x JOIN part p ON p.p_partkey = x.l_partkey
),
src_product_returns AS (
    SELECT CAST(order_item_id AS BIGINT) AS return_id, CAST(order_item_id AS BIGINT) AS order_item_id,
           CAST(l_shipdate AS DATE) AS return_date, CAST(NULL AS VARCHAR) AS reason
    FROM src_lines WHERE l_returnflag = 'R'
),
src_sales_orders AS (
    SELECT CAST(o.o_orderkey AS BIGINT) AS order_id, CAST(o.o_custkey AS BIGINT) AS customer_id,
           CAST(s.s_nationkey AS BIGINT) AS store_id, CAST(s.s_suppkey AS BIGINT) AS employee_id,
           CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderpriority AS payment_method
    FROM orders o
    LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS employee_id FROM lineitem GROUP BY l_orderkey) seller
      ON seller.l_orderkey = o.o_orderkey
    JOIN supplier s
      ON s.s_suppkey = coalesce(seller.employee_id, (SELECT min(s_suppkey) FROM supplier))
)"""

SOURCE_NAMES = ["stores", "employees", "categories", "products", "customers", "sales_orders",
                "sales_order_items", "product_returns"]

STAGING_CTES = ",\n".join(
    f"stg_{t} AS (SELECT *, '{t}' AS _source_table FROM src_{t})" for t in SOURCE_NAMES)

STAR_CTES = """
calendar_bounds AS (
    SELECT make_date(CAST(year(min(order_date)) AS INTEGER), 1, 1) AS lo,
           make_date(CAST(year(max(order_date)) AS INTEGER), 12, 31) AS hi
    FROM stg_sales_orders
),
calendar_days AS (
    SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
    FROM calendar_bounds
),
dim_date AS (
    SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
           dayname(d) AS day_of_week, CAST(day(d) AS INTEGER) AS day_of_month,
           CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
           CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
    FROM calendar_days
),
dim_store AS (
    SELECT CAST(row_number() OVER (ORDER BY store_id) AS BIGINT) AS store_key,
           store_id, store_name, city, region, opening_date
    FROM stg_stores
),
dim_employee AS (
    SELECT CAST(row_number() OVER (ORDER BY e.employee_id) AS BIGINT) AS employee_key,
           e.employee_id, e.full_name, e.role, s.store_key, e.hire_date
    FROM stg_employees e JOIN dim_store s ON s.store_id = e.store_id
),
dim_product AS (
    SELECT CAST(row_number() OVER (ORDER BY p.product_id) AS BIGINT) AS product_key,
           p.product_id, p.product_name, c.category_name, p.unit_cost, p.unit_price
    FROM stg_products p JOIN stg_categories c ON c.category_id = p.category_id
),
dim_customer_initial AS (
    SELECT CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_key,
           customer_id, full_name, city, loyalty_member, signup_date,
           signup_date AS valid_from, CAST(NULL AS DATE) AS valid_to, 1 AS is_current
    FROM stg_customers
),
order_headers AS (
    SELECT order_id, customer_id, store_id, employee_id, order_date,
           CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS INTEGER) AS date_key
    FROM stg_sales_orders
),
returned_lines AS (
    SELECT order_item_id, return_id FROM stg_product_returns
),
fact_lines AS (
    SELECT h.date_key, h.customer_id, h.order_date, p.product_key, s.store_key, e.employee_key,
           i.order_id, i.order_item_id, i.quantity, i.unit_price_paid, i.discount_pct,
           CAST(round(i.quantity * i.unit_price_paid, 2) AS DECIMAL(12,2)) AS line_revenue,
           CAST(round(i.quantity * p.unit_cost, 2) AS DECIMAL(12,2)) AS line_cost,
           CAST(round(i.quantity * i.unit_price_paid - i.quantity * p.unit_cost, 2) AS DECIMAL(12,2)) AS line_margin,
           CASE WHEN r.return_id IS NULL THEN 0 ELSE 1 END AS is_returned
    FROM stg_sales_order_items i
    JOIN order_headers h ON h.order_id = i.order_id
    JOIN dim_product p ON p.product_id = i.product_id
    JOIN dim_store s ON s.store_id = h.store_id
    JOIN dim_employee e ON e.employee_id = h.employee_id
    LEFT JOIN returned_lines r ON r.order_item_id = i.order_item_id
),
fact_sales AS (
    SELECT f.date_key, c.customer_key, f.product_key, f.store_key, f.employee_key, f.order_id,
           f.order_item_id, f.quantity, f.unit_price_paid, f.discount_pct, f.line_revenue,
           f.line_cost, f.line_margin, f.is_returned
    FROM fact_lines f
    JOIN dim_customer_initial c ON c.customer_id = f.customer_id AND c.is_current = 1
),
last_orders AS (
    SELECT customer_id, order_date AS change_date, store_id
    FROM src_sales_orders WHERE customer_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1
),
customer_changes AS (
    SELECT lo.customer_id, lo.change_date, st.city
    FROM last_orders lo
    JOIN src_stores st ON st.store_id = lo.store_id
    JOIN src_customers cu ON cu.customer_id = lo.customer_id
    WHERE st.city IS DISTINCT FROM cu.city
),
applied_changes AS (
    SELECT customer_id, change_date, city, 0 AS change_seq FROM customer_changes
    WHERE customer_id IN (SELECT customer_id FROM dim_customer_initial)
),
change_chain AS (
    SELECT customer_id, change_date, city,
           lead(change_date) OVER (PARTITION BY customer_id ORDER BY change_date, change_seq) AS next_date,
           row_number() OVER (ORDER BY customer_id, change_date, change_seq) AS new_rank
    FROM applied_changes
),
latest_version AS (
    SELECT * FROM dim_customer_initial
    WHERE customer_id IN (SELECT customer_id FROM applied_changes)
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY valid_from DESC, customer_key DESC) = 1
),
first_change AS (
    SELECT customer_id, min(change_date) AS first_date FROM applied_changes GROUP BY customer_id
),
dim_customer_scd2 AS (
    SELECT d.customer_key, d.customer_id, d.full_name, d.city, d.loyalty_member, d.signup_date,
           d.valid_from,
           CASE WHEN d.is_current = 1 AND f.first_date IS NOT NULL
                THEN CAST(f.first_date - 1 AS DATE) ELSE d.valid_to END AS valid_to,
           CASE WHEN d.is_current = 1 AND f.first_date IS NOT NULL THEN 0 ELSE d.is_current END AS is_current
    FROM dim_customer_initial d LEFT JOIN first_change f ON f.customer_id = d.customer_id
    UNION ALL
    SELECT CAST((SELECT max(customer_key) FROM dim_customer_initial) + c.new_rank AS BIGINT),
           c.customer_id, l.full_name, c.city, l.loyalty_member, l.signup_date, c.change_date,
           CAST(c.next_date - 1 AS DATE), CASE WHEN c.next_date IS NULL THEN 1 ELSE 0 END
    FROM change_chain c JOIN latest_version l ON l.customer_id = c.customer_id
),
usable_versions AS MATERIALIZED (
    SELECT * FROM dim_customer_scd2 WHERE valid_to IS NULL OR valid_to >= valid_from
),
as_of_match AS MATERIALIZED (
    SELECT h.order_id, h.order_date, v.customer_key, v.valid_to
    FROM order_headers h
    JOIN usable_versions v ON v.customer_id = h.customer_id AND v.valid_from <= h.order_date
    QUALIFY row_number() OVER (PARTITION BY h.order_id ORDER BY v.valid_from DESC, v.customer_key DESC) = 1
),
usable_versions_open AS (
    SELECT v.*,
           CASE WHEN v.valid_from = min(v.valid_from) OVER (PARTITION BY v.customer_id)
                THEN NULL ELSE v.valid_from END AS start_from
    FROM usable_versions v
),
as_of_open_match AS MATERIALIZED (
    SELECT h.order_id, h.order_date, v.customer_key, v.valid_to
    FROM order_headers h
    JOIN usable_versions_open v
      ON v.customer_id = h.customer_id AND (v.start_from IS NULL OR v.start_from <= h.order_date)
    QUALIFY row_number() OVER (PARTITION BY h.order_id
                               ORDER BY v.start_from DESC NULLS LAST, v.customer_key DESC) = 1
),
fact_sales_as_of_open AS (
    SELECT f.date_key, m.customer_key, f.product_key, f.store_key, f.employee_key, f.order_id,
           f.order_item_id, f.quantity, f.unit_price_paid, f.discount_pct, f.line_revenue,
           f.line_cost, f.line_margin, f.is_returned
    FROM fact_lines f
    JOIN as_of_open_match m ON m.order_id = f.order_id
    WHERE m.valid_to IS NULL OR f.order_date <= m.valid_to
),
fact_sales_as_of AS (
    SELECT f.date_key, m.customer_key, f.product_key, f.store_key, f.employee_key, f.order_id,
           f.order_item_id, f.quantity, f.unit_price_paid, f.discount_pct, f.line_revenue,
           f.line_cost, f.line_margin, f.is_returned
    FROM fact_lines f
    JOIN as_of_match m ON m.order_id = f.order_id
    WHERE m.valid_to IS NULL OR f.order_date <= m.valid_to
)"""


def pct_sql(num: str, den: str, digits: int, num_scale: int = 0, den_scale: int = 0) -> str:
    """``ROUND(num * 100.0 / den, digits)`` exactly, half away from zero, as DOUBLE.

    ``num`` and ``den`` are decimal or integer expressions with the given
    scales; they are scaled to integers (HUGEINT) first.
    """
    n = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT)"
    d = f"CAST(({den}) * {10 ** den_scale} AS HUGEINT)"
    factor = 10 ** (digits + 2 + den_scale - num_scale)
    # den_scale >= num_scale is assumed for these call sites (factor integral)
    return (f"(CASE WHEN ({d}) IS NULL OR ({d}) = 0 OR ({n}) IS NULL THEN NULL ELSE "
            f"sign({n}) * sign({d}) * ((abs({n}) * {2 * factor} + abs({d})) // (2 * abs({d})))"
            f" / {10.0 ** digits} END)")


def _marts(star_customer: str, fact: str = "fact_sales") -> dict[str, str]:
    money = "CAST(sum({}) AS DECIMAL(22,2))".format
    return {
        "mart_monthly_revenue": f"""
SELECT year, month_number, month_name, store_name, region, num_orders, total_revenue, total_margin,
       {pct_sql('total_margin', 'total_revenue', 1, 2, 2)} AS margin_pct
FROM (
    SELECT d.year, d.month_number, d.month_name, s.store_name, s.region,
           count(DISTINCT f.order_id) AS num_orders,
           {money('f.line_revenue')} AS total_revenue, {money('f.line_margin')} AS total_margin
    FROM {fact} f JOIN dim_date d ON d.date_key = f.date_key
    JOIN dim_store s ON s.store_key = f.store_key
    WHERE f.is_returned = 0
    GROUP BY d.year, d.month_number, d.month_name, s.store_name, s.region
) m""",
        "mart_customer_cohorts": f"""
SELECT strftime(c.signup_date, '%Y-%m') AS cohort_month, d.year AS order_year,
       d.month_number AS order_month, count(DISTINCT c.customer_id) AS active_customers,
       {money('f.line_revenue')} AS cohort_revenue
FROM {fact} f JOIN {star_customer} c ON c.customer_key = f.customer_key
JOIN dim_date d ON d.date_key = f.date_key
WHERE f.is_returned = 0
GROUP BY 1, 2, 3""",
        "mart_product_performance": f"""
SELECT category_name, product_name, units_sold, total_revenue, total_margin,
       {pct_sql('total_margin', 'total_revenue', 1, 2, 2)} AS margin_pct,
       units_returned, {pct_sql('units_returned', 'line_count', 2)} AS return_rate_pct
FROM (
    SELECT p.category_name, p.product_name, CAST(sum(f.quantity) AS BIGINT) AS units_sold,
           {money('f.line_revenue')} AS total_revenue, {money('f.line_margin')} AS total_margin,
           CAST(sum(f.is_returned) AS BIGINT) AS units_returned, count(*) AS line_count
    FROM {fact} f JOIN dim_product p ON p.product_key = f.product_key
    GROUP BY p.category_name, p.product_name
) m""",
        "mart_employee_performance": f"""
SELECT employee_name, role, store_name, orders_handled, total_sales,
       CAST(rank() OVER (ORDER BY total_sales DESC) AS INTEGER) AS sales_rank
FROM (
    SELECT e.full_name AS employee_name, e.role, s.store_name,
           count(DISTINCT f.order_id) AS orders_handled, {money('f.line_revenue')} AS total_sales
    FROM {fact} f JOIN dim_employee e ON e.employee_key = f.employee_key
    JOIN dim_store s ON s.store_key = e.store_key
    WHERE f.is_returned = 0
    GROUP BY e.full_name, e.role, s.store_name
) m""",
        "mart_customer_geography": f"""
SELECT c.city, count(DISTINCT c.customer_id) AS num_customers, {money('f.line_revenue')} AS total_revenue
FROM {star_customer} c
LEFT JOIN {fact} f ON f.customer_key = c.customer_key AND f.is_returned = 0
WHERE c.is_current = 1
GROUP BY c.city""",
    }


def _with(body: str, extra: str = "") -> str:
    """``body`` over the layers; ``extra`` are further (recursive) expressions."""
    start, more = ("WITH RECURSIVE", f",{extra}") if extra else ("WITH", "")
    return f"{start} {SOURCE_CTES},\n{STAGING_CTES},\n{STAR_CTES}{more}\n{body}"


STG_COLS = {
    "stores": "store_id, store_name, city, region, opening_date",
    "employees": "employee_id, full_name, store_id, hire_date, role",
    "categories": "category_id, category_name",
    "products": "product_id, product_name, category_id, unit_cost, unit_price",
    "customers": "customer_id, full_name, city, signup_date, loyalty_member",
    "sales_orders": "order_id, customer_id, store_id, employee_id, order_date, payment_method",
    "sales_order_items": "order_item_id, order_id, product_id, quantity, unit_price_paid, discount_pct",
    "product_returns": "return_id, order_item_id, return_date, reason",
}

STAGED_KEYS = {
    "stores": "store_id", "employees": "employee_id", "categories": "category_id",
    "products": "product_id", "customers": "customer_id", "sales_orders": "order_id",
    "sales_order_items": "order_item_id", "product_returns": "return_id",
}

STAGED_FOREIGN_KEYS = [
    ("employees", "store_id", "stores"), ("products", "category_id", "categories"),
    ("sales_orders", "customer_id", "customers"), ("sales_orders", "store_id", "stores"),
    ("sales_orders", "employee_id", "employees"), ("sales_order_items", "order_id", "sales_orders"),
    ("sales_order_items", "product_id", "products"),
    ("product_returns", "order_item_id", "sales_order_items"),
]

# Columns declared NOT NULL in the operational tables.
STAGED_REQUIRED = {
    "stores": ["store_id", "store_name", "city", "region", "opening_date"],
    "employees": ["employee_id", "full_name", "store_id", "hire_date", "role"],
    "categories": ["category_id", "category_name"],
    "products": ["product_id", "product_name", "category_id", "unit_cost", "unit_price"],
    "customers": ["customer_id", "full_name", "signup_date", "loyalty_member"],
    "sales_orders": ["order_id", "store_id", "employee_id", "order_date", "payment_method"],
    "sales_order_items": ["order_item_id", "order_id", "product_id", "quantity",
                          "unit_price_paid", "discount_pct"],
    "product_returns": ["return_id", "order_item_id", "return_date"],
}

FACT_COLS = ("date_key, customer_key, product_key, store_key, employee_key, order_id, order_item_id, "
             "quantity, unit_price_paid, discount_pct, line_revenue, line_cost, line_margin, is_returned")


def _checks_sql() -> str:
    """Violations of every data-quality check, computed from the layer CTEs."""
    star_tables = {
        "dim_date": ("date_key", ["date_key", "full_date", "day_of_week", "day_of_month",
                                  "month_number", "month_name", "quarter", "year", "is_weekend"]),
        "dim_store": ("store_key", ["store_key", "store_id", "store_name", "city", "region",
                                    "opening_date"]),
        "dim_employee": ("employee_key", ["employee_key", "employee_id", "full_name", "role",
                                          "store_key", "hire_date"]),
        "dim_product": ("product_key", ["product_key", "product_id", "product_name",
                                        "category_name", "unit_cost", "unit_price"]),
        "dim_customer_scd2": ("customer_key", ["customer_key", "customer_id", "full_name", "city",
                                               "loyalty_member", "signup_date", "valid_from",
                                               "is_current"]),
        "fact_sales": ("order_item_id", [c.strip() for c in FACT_COLS.split(",")]),
    }
    dup_terms, null_terms = [
        "(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM dim_customer_scd2 "
        "GROUP BY customer_id, valid_from HAVING count(*) > 1) t)"], []
    for table, (key, required) in star_tables.items():
        if key:
            dup_terms.append(f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {table} "
                             f"GROUP BY {key} HAVING count(*) > 1) t)")
        nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in required)
        null_terms.append(f"(SELECT {nulls} FROM {table})")

    def orphan(col: str, dim: str) -> str:
        return (f"(SELECT count(*) FROM fact_sales f WHERE f.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {dim} d WHERE d.{col} = f.{col}))")

    marts = _marts("dim_customer_scd2")
    checks = [
        ("Q01", "staged orders equal source orders",
         "abs((SELECT count(*) FROM stg_sales_orders) - (SELECT count(*) FROM src_sales_orders))"),
        ("Q02", "staged order items equal source items",
         "abs((SELECT count(*) FROM stg_sales_order_items) - (SELECT count(*) FROM src_sales_order_items))"),
        ("Q03", "staged customers equal source customers",
         "abs((SELECT count(*) FROM stg_customers) - (SELECT count(*) FROM src_customers))"),
        ("Q04", "one fact row per staged order item",
         "(SELECT coalesce(sum(abs(coalesce(s.n, 0) - coalesce(f.n, 0))), 0) FROM "
         "(SELECT order_item_id, count(*) AS n FROM stg_sales_order_items GROUP BY 1) s FULL JOIN "
         "(SELECT order_item_id, count(*) AS n FROM fact_sales GROUP BY 1) f USING (order_item_id))"),
        ("Q05", "no fact row with an unresolved date_key", orphan("date_key", "dim_date")),
        ("Q06", "no fact row with an unresolved customer_key",
         orphan("customer_key", "dim_customer_scd2")),
        ("Q07", "no fact row with an unresolved product_key", orphan("product_key", "dim_product")),
        ("Q07b", "no fact row with an unresolved store_key", orphan("store_key", "dim_store")),
        ("Q07c", "no fact row with an unresolved employee_key",
         orphan("employee_key", "dim_employee")),
        ("Q08", "staged revenue equals fact revenue to the cent",
         "CASE WHEN (SELECT round(sum(quantity * unit_price_paid), 2) FROM stg_sales_order_items) "
         "IS NOT DISTINCT FROM (SELECT round(sum(line_revenue), 2) FROM fact_sales) THEN 0 ELSE 1 END"),
        ("Q09", "line_margin equals line_revenue minus line_cost",
         "(SELECT count(*) FROM fact_sales WHERE line_margin <> round(line_revenue - line_cost, 2))"),
        ("Q10", "each changed customer has 1 + its changes versions",
         "(SELECT count(*) FROM (SELECT a.customer_id, count(*) AS n FROM applied_changes a "
         "GROUP BY a.customer_id) e WHERE (SELECT count(*) FROM dim_customer_scd2 d "
         "WHERE d.customer_id = e.customer_id) <> e.n + 1)"),
        ("Q11", "each changed customer has exactly one current version",
         "(SELECT count(*) FROM (SELECT DISTINCT customer_id FROM applied_changes) e WHERE "
         "(SELECT coalesce(sum(is_current), 0) FROM dim_customer_scd2 d "
         "WHERE d.customer_id = e.customer_id) <> 1)"),
        ("Q12", "current version shows the last new city",
         "(SELECT count(*) FROM (SELECT customer_id, city FROM applied_changes QUALIFY row_number() "
         "OVER (PARTITION BY customer_id ORDER BY change_date DESC, change_seq DESC) = 1) e WHERE "
         "(SELECT max(city) FROM dim_customer_scd2 d WHERE d.customer_id = e.customer_id "
         "AND d.is_current = 1) IS DISTINCT FROM e.city)"),
        ("Q13", "original version keeps the staged city",
         "(SELECT count(*) FROM (SELECT DISTINCT customer_id FROM applied_changes) e WHERE "
         "(SELECT d.city FROM dim_customer_scd2 d WHERE d.customer_id = e.customer_id "
         "ORDER BY d.customer_key LIMIT 1) IS DISTINCT FROM "
         "(SELECT s.city FROM stg_customers s WHERE s.customer_id = e.customer_id))"),
        ("Q14", "every closed customer version has a valid_to",
         "(SELECT count(*) FROM dim_customer_scd2 WHERE is_current = 0 AND valid_to IS NULL)"),
        ("Q15", "no customer has two current versions",
         "(SELECT count(*) FROM (SELECT customer_id FROM dim_customer_scd2 GROUP BY customer_id "
         "HAVING sum(is_current) > 1) t)"),
        ("Q16", "monthly mart revenue equals non-returned fact revenue",
         f"CASE WHEN (SELECT round(sum(total_revenue), 2) FROM ({marts['mart_monthly_revenue']}) m) "
         "IS NOT DISTINCT FROM (SELECT round(sum(line_revenue), 2) FROM fact_sales "
         "WHERE is_returned = 0) THEN 0 ELSE 1 END"),
        ("Q17", "product mart has one row per product name sold",
         f"abs((SELECT count(*) FROM ({marts['mart_product_performance']}) m) - (SELECT count(*) FROM "
         "(SELECT DISTINCT p.category_name, p.product_name FROM fact_sales f JOIN dim_product p "
         "ON p.product_key = f.product_key) t))"),
        ("Q18", "top product of the mart is the top product of the fact",
         f"CASE WHEN (SELECT category_name || '|' || product_name FROM ({marts['mart_product_performance']}) m "
         "ORDER BY total_revenue DESC, category_name, product_name LIMIT 1) = "
         "(SELECT p.category_name || '|' || p.product_name FROM fact_sales f JOIN dim_product p "
         "ON p.product_key = f.product_key GROUP BY p.category_name, p.product_name "
         "ORDER BY sum(f.line_revenue) DESC, p.category_name, p.product_name LIMIT 1) "
         "THEN 0 ELSE 1 END"),
        ("Q19a", "star primary keys are unique", " + ".join(dup_terms)),
        ("Q19b", "declared NOT NULL star columns are filled", " + ".join(null_terms)),
        ("Q19c", "every employee's store_key resolves",
         "(SELECT count(*) FROM dim_employee e WHERE e.store_key IS NOT NULL AND NOT EXISTS "
         "(SELECT 1 FROM dim_store s WHERE s.store_key = e.store_key))"),
        ("Q19d", "staged primary keys are unique", " + ".join(
            f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM stg_{t} "
            f"GROUP BY {key} HAVING count(*) > 1) d)" for t, key in STAGED_KEYS.items())),
        ("Q19e", "staged foreign keys resolve", " + ".join(
            f"(SELECT count(*) FROM stg_{child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM stg_{parent} p WHERE p.{col} = c.{col}))"
            for child, col, parent in STAGED_FOREIGN_KEYS)),
        ("Q19f", "declared NOT NULL source columns are filled in staging", " + ".join(
            f"(SELECT {' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in cols)} "
            f"FROM stg_{t})" for t, cols in STAGED_REQUIRED.items())),
    ]
    rows = "\nUNION ALL\n".join(
        f"SELECT '{cid}' AS check_id, '{desc.replace(chr(39), chr(39) * 2)}' AS description, "
        f"CAST({expr} AS BIGINT) AS violations"
        for cid, desc, expr in checks)
    return f"SELECT check_id, description, violations, violations = 0 AS passed FROM (\n{rows}\n) c"


def oracle_statements() -> dict[str, str]:
    out: dict[str, str] = {}
    for t, cols in STG_COLS.items():
        out[f"stg_{t}"] = _with(f"SELECT {cols}, _source_table FROM stg_{t}")
    out["dim_date"] = _with("SELECT * FROM dim_date")
    out["dim_store"] = _with("SELECT * FROM dim_store")
    out["dim_employee"] = _with("SELECT * FROM dim_employee")
    out["dim_product"] = _with("SELECT * FROM dim_product")
    out["dim_customer_initial"] = _with("SELECT * FROM dim_customer_initial")
    out["customer_city_changes"] = _with("SELECT customer_id, change_date, city FROM customer_changes")
    out["dim_customer_scd2"] = _with("SELECT * FROM dim_customer_scd2")
    out["customer_history"] = _with("""
SELECT customer_key, customer_id, full_name, city, valid_from, valid_to, is_current,
       row_number() OVER (PARTITION BY customer_id ORDER BY valid_from, customer_key) AS version_no
FROM dim_customer_scd2""")
    out["fact_sales"] = _with(f"SELECT {FACT_COLS} FROM fact_sales")
    out["fact_sales_heavy_orders"] = out["fact_sales"]
    out["fact_sales_as_of"] = _with(f"SELECT {FACT_COLS} FROM fact_sales_as_of")
    out["fact_sales_as_of_open_first"] = _with(f"SELECT {FACT_COLS} FROM fact_sales_as_of_open")
    for name, body in _marts("dim_customer_initial").items():
        out[name] = _with(body)
    out["mart_customer_geography_after_scd2"] = _with(
        _marts("dim_customer_scd2")["mart_customer_geography"])
    out["mart_customer_cohorts_after_scd2"] = _with(
        _marts("dim_customer_scd2")["mart_customer_cohorts"])
    out["top_product"] = _with(f"""
SELECT category_name, product_name, total_revenue
FROM ({_marts('dim_customer_initial')['mart_product_performance']}) m
ORDER BY total_revenue DESC, category_name, product_name LIMIT 1""")
    out["row_count_report"] = _with("""
SELECT 'staging' AS layer, 'stg_sales_order_items' AS table_name, count(*) AS row_count FROM stg_sales_order_items
UNION ALL SELECT 'star', 'fact_sales', count(*) FROM fact_sales
UNION ALL SELECT 'star', 'dim_customer', count(*) FROM dim_customer_scd2
UNION ALL SELECT 'star', 'dim_date', count(*) FROM dim_date""")
    out["dq_checks"] = _with(_checks_sql())
    out["dq_orphan_keys"] = _with("""
SELECT 'date_key' AS foreign_key, count(*) FILTER (WHERE d.date_key IS NULL) AS unresolved
FROM fact_sales f LEFT JOIN dim_date d ON d.date_key = f.date_key
UNION ALL SELECT 'customer_key', count(*) FILTER (WHERE c.customer_key IS NULL)
FROM fact_sales f LEFT JOIN dim_customer_scd2 c ON c.customer_key = f.customer_key
UNION ALL SELECT 'product_key', count(*) FILTER (WHERE p.product_key IS NULL)
FROM fact_sales f LEFT JOIN dim_product p ON p.product_key = f.product_key
UNION ALL SELECT 'store_key', count(*) FILTER (WHERE s.store_key IS NULL)
FROM fact_sales f LEFT JOIN dim_store s ON s.store_key = f.store_key
UNION ALL SELECT 'employee_key', count(*) FILTER (WHERE e.employee_key IS NULL)
FROM fact_sales f LEFT JOIN dim_employee e ON e.employee_key = f.employee_key""")
    out["dq_revenue_reconciliation"] = _with("""
SELECT CAST((SELECT round(sum(quantity * unit_price_paid), 2) FROM stg_sales_order_items) AS DECIMAL(22,2)) AS staged_revenue,
       CAST((SELECT round(sum(line_revenue), 2) FROM fact_sales) AS DECIMAL(22,2)) AS fact_revenue,
       CAST((SELECT round(sum(line_revenue), 2) FROM fact_sales WHERE is_returned = 0) AS DECIMAL(22,2)) AS fact_revenue_kept,
       (SELECT count(*) FROM fact_sales WHERE line_margin <> round(line_revenue - line_cost, 2)) AS margin_mismatches""")
    out["dq_multiple_current"] = _with("""
SELECT customer_id, CAST(sum(is_current) AS BIGINT) AS current_versions
FROM dim_customer_scd2 GROUP BY customer_id HAVING sum(is_current) > 1""")
    out["scd1_upsert_store"] = _with("""
SELECT d.store_key, d.store_id,
       coalesce(u.store_name, d.store_name) AS store_name, coalesce(u.city, d.city) AS city,
       coalesce(u.region, d.region) AS region,
       CASE WHEN u.store_id IS NULL THEN d.opening_date ELSE u.opening_date END AS opening_date
FROM dim_store d
LEFT JOIN (SELECT s.store_id, s.store_name, s.city, s.region, m.first_sale AS opening_date
           FROM stg_stores s JOIN (SELECT store_id, min(order_date) AS first_sale
                                   FROM stg_sales_orders GROUP BY store_id) m
             ON m.store_id = s.store_id) u ON u.store_id = d.store_id
UNION ALL
SELECT (SELECT max(store_key) FROM dim_store) + row_number() OVER (ORDER BY max(s.store_id)),
       max(s.store_id) + 1000, 'Online ' || s.region, 'Online', s.region, min(o.order_date)
FROM stg_stores s JOIN stg_sales_orders o ON o.store_id = s.store_id
GROUP BY s.region""")
    # One event after the other: each closes the version before it.
    events = """
events AS (
    SELECT o.customer_id, o.order_date AS change_date, s.city,
           row_number() OVER (PARTITION BY o.customer_id ORDER BY o.order_date) AS step
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, year(order_date)
                                       ORDER BY order_date DESC, order_id DESC) AS latest
          FROM stg_sales_orders WHERE customer_id IS NOT NULL) o
    JOIN stg_stores s ON s.store_id = o.store_id
    WHERE o.latest = 1
),
replay AS (
    SELECT customer_key, customer_id, full_name, city, loyalty_member, signup_date, valid_from,
           CAST(0 AS BIGINT) AS step
    FROM dim_customer_initial
    UNION ALL
    SELECT r.customer_key, r.customer_id, r.full_name, e.city, r.loyalty_member, r.signup_date,
           e.change_date, e.step
    FROM replay r JOIN events e ON e.customer_id = r.customer_id AND e.step = r.step + 1
)"""
    versions = """
SELECT CASE WHEN step = 0 THEN customer_key ELSE
         (SELECT max(customer_key) FROM dim_customer_initial)
         + row_number() OVER (PARTITION BY step > 0 ORDER BY {order}customer_id, step) END AS customer_key,
       customer_id, full_name, city, loyalty_member, signup_date, valid_from,
       CAST((SELECT n.valid_from FROM replay n
             WHERE n.customer_id = r.customer_id AND n.step = r.step + 1) - 1 AS DATE) AS valid_to,
       CASE WHEN EXISTS (SELECT 1 FROM replay n WHERE n.customer_id = r.customer_id
                         AND n.step = r.step + 1) THEN 0 ELSE 1 END AS is_current
FROM replay r"""
    out["dim_customer_replay"] = _with(versions.format(order=""), extra=events)
    # The same versions; the last year's batch comes second, so its keys do too.
    last_year = "year(valid_from) = (SELECT max(year(order_date)) FROM stg_sales_orders), "
    out["dim_customer_key_folders"] = _with(versions.format(order=last_year), extra=events)
    extracts = """
extract_day AS (SELECT CAST(max(order_date) + 1 AS DATE) AS d FROM stg_sales_orders),
on_file AS (SELECT * FROM stg_customers WHERE month(signup_date) <= 9),
later AS (
    SELECT c.customer_id, c.full_name, coalesce(m.city, c.city) AS city, c.loyalty_member, c.signup_date
    FROM stg_customers c LEFT JOIN customer_changes m ON m.customer_id = c.customer_id
    WHERE c.customer_id IN (SELECT customer_id FROM stg_sales_orders)
)"""
    out["customer_change_set"] = _with("""
SELECT l.customer_id, 'insert' AS change, l.full_name, l.city, l.loyalty_member, l.signup_date,
       '' AS changed
FROM later l WHERE NOT EXISTS (SELECT 1 FROM on_file o WHERE o.customer_id = l.customer_id)
UNION ALL
SELECT o.customer_id, 'delete', o.full_name, o.city, o.loyalty_member, o.signup_date, ''
FROM on_file o WHERE NOT EXISTS (SELECT 1 FROM later l WHERE l.customer_id = o.customer_id)
UNION ALL
SELECT l.customer_id, 'update', l.full_name, l.city, l.loyalty_member, l.signup_date, 'city'
FROM later l JOIN on_file o ON o.customer_id = l.customer_id
WHERE l.city IS DISTINCT FROM o.city""", extra=extracts)
    out["dim_customer_snapshot"] = _with("""
SELECT CAST(b.customer_key AS BIGINT) AS customer_key, b.customer_id, b.full_name, b.city, b.loyalty_member,
       b.signup_date, b.signup_date AS valid_from,
       CAST(CASE WHEN l.customer_id IS NULL OR l.city IS DISTINCT FROM b.city
                 THEN (SELECT d FROM extract_day) - 1 END AS DATE) AS valid_to,
       CASE WHEN l.customer_id IS NULL OR l.city IS DISTINCT FROM b.city THEN 0 ELSE 1 END AS is_current
FROM (SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_key FROM on_file) b
LEFT JOIN later l ON l.customer_id = b.customer_id
UNION ALL
SELECT (SELECT count(*) FROM on_file) + row_number() OVER (ORDER BY added DESC, customer_id),
       customer_id, full_name, city, loyalty_member, signup_date,
       CASE WHEN added THEN signup_date ELSE (SELECT d FROM extract_day) END, NULL, 1
FROM (SELECT l.*, o.customer_id IS NULL AS added
      FROM later l LEFT JOIN on_file o ON o.customer_id = l.customer_id
      WHERE o.customer_id IS NULL OR l.city IS DISTINCT FROM o.city) n""", extra=extracts)
    # Members' cities in lower case: apart by bytes, together by letters.
    spelled = """
dim_customer_spelled AS (
    SELECT * REPLACE (CASE WHEN loyalty_member = 1 THEN lower(city) ELSE city END AS city)
    FROM dim_customer_initial
)"""
    merged = spelled + """,
dim_customer_merged AS (
    SELECT * REPLACE (min(city) OVER (PARTITION BY lower(strip_accents(city))) AS city)
    FROM dim_customer_spelled
)"""
    out["mart_customer_geography_spellings"] = _with(
        _marts("dim_customer_spelled")["mart_customer_geography"], extra=spelled)
    out["mart_customer_geography_any_case"] = _with(
        _marts("dim_customer_merged")["mart_customer_geography"], extra=merged)
    orders = {
        "mart_monthly_revenue": "year, month_number",
        "mart_customer_cohorts": "cohort_month, order_year, order_month",
        "mart_product_performance": "total_revenue DESC NULLS LAST",
        "mart_employee_performance": "sales_rank",
        "mart_customer_geography": "total_revenue DESC NULLS LAST",
    }
    for name, body in _marts("dim_customer_initial").items():
        out[f"{name}_ordered"] = _with(
            f"SELECT *, rank() OVER (ORDER BY {orders[name]}) AS position FROM ({body}) m")
    return out
