"""Readers and writers for the stored layers.

Every table is read with its declared schema (no inference) and written as
Parquet.  Layers live under one root folder: ``<root>/<layer>/<table>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """Scan a stored table (Parquet, CSV, JSON, ORC) with a declared schema.

    A bulk literal load becomes ``fmt='csv'`` with ``options={'header': 'true'}``;
    with ``schema`` given nothing is inferred, so the scan stays a single pass.
    Text formats are read strictly: a cell that does not fit its type, or a
    header that differs from the schema, fails the job.
    """
    strict = {"csv": {"mode": "FAILFAST", "enforceSchema": "false"},
              "json": {"mode": "FAILFAST"}}.get(fmt, {})
    reader = spark.read.format(fmt).options(**{**strict, **(options or {})})
    if schema is not None:
        # A declared schema also spares the footer-reading job of inference.
        reader = reader.schema(schema)
    df = reader.load(path)
    return conform(df, schema) if schema is not None else df


def load_source_tables(spark: SparkSession, folder: str, fmt: str = "parquet",
                       options: dict | None = None) -> dict[str, DataFrame]:
    """Bulk load of the eight operational tables from an export folder
    (``<folder>/<table>`` in Parquet, CSV, JSON or ORC), each read with its
    declared schema; CSV defaults to a header line."""
    from ..schemas import SOURCE

    opts = {"header": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    return {name: read_table(spark, f"{folder.rstrip('/')}/{name}", schema, fmt, opts)
            for name, schema in SOURCE.items()}


def read_jdbc(spark: SparkSession, url: str, table: str, schema: T.StructType,
              properties: dict | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Scan a live operational table over JDBC, split into parallel range reads.

    With ``partition_column``, its bounds and ``num_partitions``, each task reads
    one key range.  All four or none: without them the whole table is one
    task's read through one connection, right for small tables only.
    """
    split = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(x is None for x in split) and any(x is not None for x in split):
        raise ValueError("a split read needs partition_column, lower_bound, upper_bound "
                         "and num_partitions")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return conform(reader.load(), schema)


def conform(df: DataFrame, schema: T.StructType, defaults: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` onto a declared schema: order, names and types.

    Casts are ANSI casts, so a value that does not fit (text in a number
    column, overflow of a DECIMAL) fails the job instead of turning NULL.
    A column missing from ``df`` is an error unless it is named in ``defaults``;
    it then becomes a typed NULL.
    """
    present = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in present and f.name not in defaults]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    cols = []
    for field in schema.fields:
        if field.name in present:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write a layer table.  ``overwrite`` is the full refresh of a layer,
    ``append`` the incremental insert."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed_table(df: DataFrame, path: str, table: str, by: str, buckets: int) -> None:
    """Write a table hash-bucketed on ``by`` and register it.

    Tables bucketed the same way on a join key are joined without a shuffle:
    staged order lines and order headers are both bucketed on ``order_id``,
    the key of the largest join of the load.  Rows are dealt by the same hash
    before the write, so each bucket is one sorted file whatever the number of
    writing tasks.  Bucketed reads are not split by adaptive skew handling.
    """
    (df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
     .option("path", path).saveAsTable(table))


def register_bucketed_table(spark: SparkSession, table: str, path: str, schema: T.StructType,
                            by: str, buckets: int) -> DataFrame:
    """Attach the bucketing of files written by ``write_bucketed_table`` in an
    earlier session (the catalog entry, not the data, is recreated)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet "
              f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def publish(df: DataFrame, name: str) -> DataFrame:
    """Publish a DataFrame under a SQL name (``CREATE OR REPLACE VIEW``)."""
    df.createOrReplaceTempView(name)
    return df


def read_published(spark: SparkSession, name: str, order_by: Sequence = ()) -> DataFrame:
    """``SELECT * FROM name ORDER BY ...`` on a published view."""
    df = spark.table(name)
    return df.orderBy(*order_by) if order_by else df
