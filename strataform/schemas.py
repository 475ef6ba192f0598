"""Declared schemas of the three stored layers.

Source tables carry the declared nullability of the operational system;
staging copies are all-nullable plus two lineage columns; the star schema is
non-null except ``dim_customer.valid_to``.  Ids and surrogate keys are 64-bit.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
DATE = T.DateType()
TS = T.TimestampType()
MONEY = T.DecimalType(10, 2)      # price per unit
PERCENT = T.DecimalType(5, 2)     # discount percent
LINE_MONEY = T.DecimalType(12, 2)  # money per order line
SUM_MONEY = T.DecimalType(22, 2)   # sum of line money


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SOURCE = {
    "stores": _struct(("store_id", LONG, False), ("store_name", STR, False), ("city", STR, False),
                      ("region", STR, False), ("opening_date", DATE, False)),
    "employees": _struct(("employee_id", LONG, False), ("full_name", STR, False),
                         ("store_id", LONG, False), ("hire_date", DATE, False),
                         ("role", STR, False)),
    "categories": _struct(("category_id", LONG, False), ("category_name", STR, False)),
    "products": _struct(("product_id", LONG, False), ("product_name", STR, False),
                        ("category_id", LONG, False), ("unit_cost", MONEY, False),
                        ("unit_price", MONEY, False)),
    "customers": _struct(("customer_id", LONG, False), ("full_name", STR, False),
                         ("city", STR, True), ("signup_date", DATE, False),
                         ("loyalty_member", INT, False)),
    "sales_orders": _struct(("order_id", LONG, False), ("customer_id", LONG, True),
                            ("store_id", LONG, False), ("employee_id", LONG, False),
                            ("order_date", DATE, False), ("payment_method", STR, False)),
    "sales_order_items": _struct(("order_item_id", LONG, False), ("order_id", LONG, False),
                                 ("product_id", LONG, False), ("quantity", INT, False),
                                 ("unit_price_paid", MONEY, False),
                                 ("discount_pct", PERCENT, False)),
    "product_returns": _struct(("return_id", LONG, False), ("order_item_id", LONG, False),
                               ("return_date", DATE, False), ("reason", STR, True)),
}

# Declared lengths of text columns, in characters, by column name.
TEXT_LENGTHS = {
    "store_name": 100, "city": 80, "region": 50, "full_name": 100, "role": 50,
    "category_name": 80, "product_name": 120, "payment_method": 30, "reason": 100,
    "day_of_week": 10, "month_name": 10, "_source_table": 50,
}

# Columns that hold 0 or 1.
FLAGS = {"loyalty_member", "is_weekend", "is_current", "is_returned"}

# Primary keys of the source tables (enforced as checks, not by storage).
SOURCE_KEYS = {
    "stores": ["store_id"], "employees": ["employee_id"], "categories": ["category_id"],
    "products": ["product_id"], "customers": ["customer_id"], "sales_orders": ["order_id"],
    "sales_order_items": ["order_item_id"], "product_returns": ["return_id"],
}

# Foreign keys of the source tables: (child table, column, parent table);
# the parent's key column has the same name.  NULL child keys are allowed.
SOURCE_FOREIGN_KEYS = [
    ("employees", "store_id", "stores"),
    ("products", "category_id", "categories"),
    ("sales_orders", "customer_id", "customers"),
    ("sales_orders", "store_id", "stores"),
    ("sales_orders", "employee_id", "employees"),
    ("sales_order_items", "order_id", "sales_orders"),
    ("sales_order_items", "product_id", "products"),
    ("product_returns", "order_item_id", "sales_order_items"),
]

LINEAGE_FIELDS = [T.StructField("_source_table", STR, True), T.StructField("_loaded_at", TS, True)]

STAGING = {
    f"stg_{name}": T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields] + LINEAGE_FIELDS)
    for name, schema in SOURCE.items()
}

STAR = {
    "dim_date": _struct(("date_key", INT, False), ("full_date", DATE, False),
                        ("day_of_week", STR, False), ("day_of_month", INT, False),
                        ("month_number", INT, False), ("month_name", STR, False),
                        ("quarter", INT, False), ("year", INT, False),
                        ("is_weekend", INT, False)),
    "dim_store": _struct(("store_key", LONG, False), ("store_id", LONG, False),
                         ("store_name", STR, False), ("city", STR, False),
                         ("region", STR, False), ("opening_date", DATE, False)),
    "dim_employee": _struct(("employee_key", LONG, False), ("employee_id", LONG, False),
                            ("full_name", STR, False), ("role", STR, False),
                            ("store_key", LONG, False), ("hire_date", DATE, False)),
    "dim_product": _struct(("product_key", LONG, False), ("product_id", LONG, False),
                           ("product_name", STR, False), ("category_name", STR, False),
                           ("unit_cost", MONEY, False), ("unit_price", MONEY, False)),
    "dim_customer": _struct(("customer_key", LONG, False), ("customer_id", LONG, False),
                            ("full_name", STR, False), ("city", STR, False),
                            ("loyalty_member", INT, False), ("signup_date", DATE, False),
                            ("valid_from", DATE, False), ("valid_to", DATE, True),
                            ("is_current", INT, False)),
    "fact_sales": _struct(("fact_id", LONG, False), ("date_key", INT, False),
                          ("customer_key", LONG, False), ("product_key", LONG, False),
                          ("store_key", LONG, False), ("employee_key", LONG, False),
                          ("order_id", LONG, False), ("order_item_id", LONG, False),
                          ("quantity", INT, False), ("unit_price_paid", MONEY, False),
                          ("discount_pct", PERCENT, False), ("line_revenue", LINE_MONEY, False),
                          ("line_cost", LINE_MONEY, False), ("line_margin", LINE_MONEY, False),
                          ("is_returned", INT, False)),
}

# Surrogate key, natural key and the foreign keys of the star schema.
STAR_KEYS = {
    "dim_date": ("date_key", ["date_key"]),
    "dim_store": ("store_key", ["store_id"]),
    "dim_employee": ("employee_key", ["employee_id"]),
    "dim_product": ("product_key", ["product_id"]),
    "dim_customer": ("customer_key", ["customer_id", "valid_from"]),
    "fact_sales": ("fact_id", ["order_item_id"]),
}

FACT_FOREIGN_KEYS = {
    "date_key": "dim_date", "customer_key": "dim_customer", "product_key": "dim_product",
    "store_key": "dim_store", "employee_key": "dim_employee",
}

ALL = {**SOURCE, **STAGING, **STAR}
