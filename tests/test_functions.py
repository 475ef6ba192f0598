"""Calendar and money expressions: day keys, names, exact decimal rounding."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strataform.functions.calendar import (date_key, date_key_to_date, day_name, is_weekend,
                                           month_bucket, month_name)
from strataform.functions.money import line_amount, line_margin, percent


def test_calendar_expressions(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2024, 12, 29),)], "d date")
    rows = df.select(date_key("d").alias("k"), day_name("d").alias("dn"),
                     month_name("d").alias("mn"), month_bucket("d").alias("mb"),
                     is_weekend("d").alias("we"),
                     date_key_to_date(date_key("d")).alias("back"), "d").collect()
    assert [(r.k, r.dn, r.mn, r.mb, r.we) for r in rows] == [
        (20240229, "Thursday", "February", "2024-02", 0),
        (20241229, "Sunday", "December", "2024-12", 1)]
    assert all(r.back == r.d for r in rows)


def test_percent_rounds_half_away_from_zero_in_decimal(spark):
    cases = [
        # numerator, denominator, digits, expected
        (Decimal("1.00"), Decimal("8.00"), 1, 12.5),       # exact
        (Decimal("1.00"), Decimal("16.00"), 1, 6.3),       # 6.25 -> 6.3
        (Decimal("29.00"), Decimal("20000.00"), 2, 0.15),  # 0.145 -> 0.15 (a double gives 0.14)
        (Decimal("-1.00"), Decimal("16.00"), 1, -6.3),     # negative margin
        (Decimal("5.00"), Decimal("0.00"), 1, None),       # zero revenue
        (None, Decimal("3.00"), 1, None),
    ]
    df = spark.createDataFrame([(a, b, d) for a, b, d, _ in cases],
                               "a decimal(22,2), b decimal(22,2), d int")
    got = [r.p for r in df.select(
        F.when(F.col("d") == 1, percent(F.col("a"), F.col("b"), 1))
        .otherwise(percent(F.col("a"), F.col("b"), 2)).alias("p")).collect()]
    assert got == [c[3] for c in cases]


def test_line_amounts_are_exact(spark):
    df = spark.createDataFrame([(3, Decimal("19.99"), Decimal("12.35"))],
                               "q int, price decimal(10,2), cost decimal(10,2)")
    r = df.select(line_amount("q", "price").alias("rev"), line_amount("q", "cost").alias("cost"),
                  line_margin("q", "price", "cost").alias("margin")).first()
    assert (r.rev, r.cost, r.margin) == (Decimal("59.97"), Decimal("37.05"), Decimal("22.92"))
