"""Texts that differ in case or accents only are one text."""

from strataform.operators.text_equality import one_spelling, spellings


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_spelling(spark):
    df = spark.createDataFrame(
        [(1, "paris", "x"), (2, "Paris", "X"), (3, "PARIS", None), (4, "Orléans", "x"),
         (5, "orleans", "x"), (6, None, "y"), (7, "", "y"), (8, "Paris ", "y")],
        "id int, city string, one string")
    assert rows(one_spelling(df, ["city"])) == rows(spark.createDataFrame(
        [(1, "PARIS", "x"), (2, "PARIS", "X"), (3, "PARIS", None), (4, "Orléans", "x"),
         (5, "Orléans", "x"), (6, None, "y"), (7, "", "y"), (8, "Paris ", "y")], df.schema))
    assert {r[2] for r in one_spelling(df, ["city", "one"]).collect()} == {"X", "y", None}
    assert df.dtypes == one_spelling(df, ["city", "one"]).dtypes


def test_case_only(spark):
    df = spark.createDataFrame([("é",), ("É",), ("e",)], "c string")
    assert rows(one_spelling(df, ["c"], "UNICODE_CI")) == [("e",), ("É",), ("É",)]
    assert rows(one_spelling(df, ["c"])) == [("e",)] * 3


def test_empty_and_clean(spark):
    none = spark.createDataFrame([], "c string")
    assert rows(one_spelling(none, ["c"])) == []
    clean = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    assert spellings(clean, "c").count() == 0 and rows(one_spelling(clean, ["c"])) == rows(clean)
