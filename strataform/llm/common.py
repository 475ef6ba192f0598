"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataform.session import scratch_table

__all__ = ["read_table", "scratch_table", "held_out", "text_blocks", "texts_of",
           "partitions_for", "ship_package", "with_field", "ASCII_SPACE"]

#: The white space that separates words: space and \t \n \v \f \r.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str, remainder: int, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % folds == remainder, F.lit(False))


def partitions_for(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a text column, null as empty."""
    return pc.fill_null(column, "").to_pylist()


def text_blocks(column: pa.Array, max_bytes: int = 1 << 20
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``max_bytes`` of text, at least one row each.

    Gives (first row, last row + 1, UTF-8 bytes, offsets into them); null text
    counts as empty.  Bounds what a vectorised step holds at a time, except
    that one text is never cut.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + max_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last



_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks
    can import it where it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="strataform-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def with_field(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    """``schema`` with more fields behind it."""
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])
