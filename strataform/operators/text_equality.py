"""Text equality of the source system: letters that differ in case or accents only
are equal.

Spark compares text by bytes.  ``one_spelling`` replaces every spelling of a text by
one of them, so that later joins and groups, partial aggregates and stored tables
need no collation of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Case and accents ignored; ``UNICODE_CI`` ignores case only.
SOURCE_COLLATION = "UNICODE_CI_AI"


def spellings(df: DataFrame, column: str, collation: str = SOURCE_COLLATION) -> DataFrame:
    """``spelling`` and ``one``: each text of the column that is not the smallest (by
    bytes) of those equal to it under ``collation``, with that smallest one.

    Texts are made distinct before they are compared, so a frequent text is one row.
    """
    texts = df.where(F.col(column).isNotNull()).select(F.col(column).alias("spelling")).distinct()
    keyed = texts.withColumn("_sf_equal", F.collate("spelling", collation))
    smallest = keyed.groupBy("_sf_equal").agg(F.min("spelling").alias("one"))
    return keyed.join(smallest, "_sf_equal").where("spelling <> one").select("spelling", "one")


def one_spelling(df: DataFrame, columns: Sequence[str], collation: str = SOURCE_COLLATION
                 ) -> DataFrame:
    """``df`` with the texts of ``columns`` in one spelling each: the smallest by
    bytes of all in the column that are equal under ``collation``.  Null stays null;
    other columns, their order and the number of rows stay as they are."""
    out = df
    for column in columns:
        found = spellings(df, column, collation).select(
            F.col("spelling").alias("_sf_spelling"), F.col("one").alias("_sf_one"))
        out = out.join(found, F.col(column) == F.col("_sf_spelling"), "left").select(*[
            F.coalesce("_sf_one", column).alias(column) if c == column else F.col(c)
            for c in df.columns])
    return out
