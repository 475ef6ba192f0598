"""Bulk loads that set bad rows aside.

``load_with_rejects`` parses a text export once, as text, and tries every cell
against the declared schema.  Rows that fit go to ``<out>/rejected=false`` with
their types; every other row goes to ``<out>/rejected=true`` as it stood, with the
reasons and the file it came from.  Both are written by the same pass.  A load with
more rejects than its limit fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.constraints import violations
from .io import conform

_CORRUPT, _FILE, _RECORD, _REASONS = "_sf_corrupt", "_sf_file", "_sf_record", "_sf_reasons"
_OPTIONS = {"csv": {"header": "true", "enforceSchema": "false"}, "json": {}}
_UNREADABLE = {"csv": "wrong number of fields", "json": "not a JSON object"}
REJECTS = T.StructType([T.StructField("record", T.StringType()),
                        T.StructField("reasons", T.ArrayType(T.StringType())),
                        T.StructField("file", T.StringType())])


class TooManyRejects(RuntimeError):
    """A load has more bad rows than its limit."""


@dataclass
class Loaded:
    """The rows that fit, the rejects (``record``, ``reasons``, ``file``), and how
    many there are of each."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


def _typed(field: T.StructField) -> Column:
    """The cell as its declared type; null where it does not fit."""
    cell = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return cell
    value = F.trim(cell).try_cast(field.dataType)
    if isinstance(field.dataType, T.DateType):  # whole dates only, no bare years
        return F.when(F.trim(cell).rlike(r"^\d{4}-\d{2}-\d{2}$"), value)
    if isinstance(field.dataType, T.DecimalType):  # no digits lost by rounding
        return F.when(value == F.trim(cell).try_cast(T.DecimalType(38, 18)), value)
    return value


def _reasons(schema: T.StructType, fmt: str) -> Column:
    """What is wrong with a row of typed cells in ``_typed`` and texts beside them;
    an empty list if nothing is."""
    unreadable = F.col(_CORRUPT).isNotNull()
    found = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        found.append(F.when(F.col(f"_cell_{field.name}").isNotNull() & F.col(field.name).isNull(),
                            F.lit(f"{field.name} is not a {kind}")))
    for rule, broken in violations(schema).items():
        name = rule.split(" ", 1)[0]
        # A cell of the wrong type is reported as that, not as missing too.
        unfit = F.col(f"_cell_{name}").isNotNull() & F.col(name).isNull()
        found.append(F.when(broken & ~unfit, F.lit(rule)))
    return F.when(unreadable, F.array(F.lit(_UNREADABLE[fmt]))).otherwise(
        F.array_compact(F.array(*found)))


def load_with_rejects(spark: SparkSession, path: str, schema: T.StructType, out: str,
                      fmt: str = "csv", options: dict | None = None, max_rejects: int = 0,
                      max_share: float = 0.0) -> Loaded:
    """Load a CSV or JSON-lines export; bad rows are set aside, not dropped.

    A row is rejected if it cannot be read (a wrong number of fields, broken JSON), a
    cell does not fit its type (a decimal with more digits than declared, a date
    that is not ``yyyy-mm-dd``), a required cell is empty, a text is too long, or a
    flag is neither 0 nor 1; all reasons of a readable row are listed.  A header that
    differs from the schema fails the load.  More than ``max_rejects`` rejects and
    more than ``max_share`` of all rows raise ``TooManyRejects``, after the write, so
    that the rejects can be looked at; ``out`` must not exist before.
    """
    if fmt not in _OPTIONS:
        raise ValueError("fmt must be 'csv' or 'json'")
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField(_CORRUPT, T.StringType())])
    read = spark.read.format(fmt).schema(text).options(**{
        **_OPTIONS[fmt], **(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    cells = read.load(path).select("*", F.col("_metadata.file_path").alias(_FILE))
    names = [f.name for f in schema.fields]
    typed = cells.select(*[_typed(f).alias(f.name) for f in schema.fields],
                         *[F.col(n).alias(f"_cell_{n}") for n in names], _CORRUPT, _FILE)
    judged = typed.withColumn(_REASONS, _reasons(schema, fmt))
    bad = F.size(_REASONS) > 0
    record = F.coalesce(_CORRUPT, F.to_json(
        F.struct(*[F.col(f"_cell_{n}").alias(n) for n in names]), {"ignoreNullFields": "false"}))
    observation = Observation(f"load.{path}")
    dealt = judged.select(
        *names, F.when(bad, record).alias(_RECORD), F.when(bad, F.col(_REASONS)).alias(_REASONS),
        F.when(bad, F.col(_FILE)).alias(_FILE), bad.alias("rejected"))
    (dealt.observe(observation, F.count_if(~F.col("rejected")).alias("rows"),
                   F.count_if("rejected").alias("rejects"))
     .write.partitionBy("rejected").parquet(out))
    seen = observation.get
    n_rows, n_rejects = int(seen["rows"]), int(seen["rejects"])
    # Read back by declared schemas; a kind without rows has no folder.
    stored = T.StructType(list(dealt.schema.fields[:-1]))

    def folder(rejected: str, n: int) -> DataFrame:
        if not n:
            return spark.createDataFrame([], stored)
        return spark.read.schema(stored).parquet(f"{out}/rejected={rejected}")

    rejects = folder("true", n_rejects).select(
        F.col(_RECORD).alias("record"), F.col(_REASONS).alias("reasons"), F.col(_FILE).alias("file"))
    if n_rejects > max(max_rejects, max_share * (n_rows + n_rejects)):
        kinds = rejects.select(F.explode("reasons").alias("r")).groupBy("r").count().collect()
        listed = "; ".join(f"{k['r']} ({k['count']})" for k in sorted(kinds, key=lambda k: k["r"]))
        raise TooManyRejects(f"{n_rejects} of {n_rows + n_rejects} rows of {path}: {listed}")
    return Loaded(conform(folder("false", n_rows), schema), rejects, n_rows, n_rejects)


def load_sources_with_rejects(spark: SparkSession, folder: str, out: str, fmt: str = "csv",
                              options: dict | None = None, max_rejects: int = 0,
                              max_share: float = 0.0) -> dict[str, Loaded]:
    """The eight operational tables from ``<folder>/<table>``, loaded into
    ``<out>/<table>``; ``max_rejects`` and ``max_share`` hold for each table."""
    return {name: load_with_rejects(spark, f"{folder.rstrip('/')}/{name}", schema,
                                    f"{out.rstrip('/')}/{name}", fmt, options, max_rejects, max_share)
            for name, schema in schemas.SOURCE.items()}
