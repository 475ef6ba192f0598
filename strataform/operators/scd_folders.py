"""SCD2 batches on a dimension in key folders: only touched folders are rewritten.

Every version of a key lies in the folder of the key, so a batch needs nothing of
the folders it has no key in: its changes are applied (``scd.scd2_apply``) to the
rows of the touched folders alone, which gives the rows the whole dimension would
have given, as long as new surrogate keys go on from the largest key of the whole
dimension.  That number is kept with the folders (``DealtDimension.max_key``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.key_folders import (dealt_into, split_folders, touched_folders, write_key_folders)
from ..sources.published import read_folders
from .constraints import write_checked
from .scd import scd2_apply


@dataclass
class DealtDimension:
    """Where a dealt dimension lies, in how many folders, and its largest key."""

    paths: list[str]
    folders: int
    max_key: int
    touched: frozenset[int] = frozenset()   # folders the last batch replaced
    written: tuple[str, ...] = ()           # their new paths

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        return read_folders(spark, self.paths, schema)


def deal_dimension(dim: DataFrame, path: str, *, folders: int, natural_key: str = "customer_id",
                   surrogate_key: str = "customer_key", apart: str = "is_current"
                   ) -> DealtDimension:
    """Write ``dim`` into key folders."""
    written = write_key_folders(dim, path, natural_key, folders, apart)
    last = read_folders(dim.sparkSession, written, dim.schema).agg(F.max(surrogate_key)).first()[0]
    return DealtDimension(written, folders, int(last or 0), written=tuple(written))


def reopened(paths: list[str], max_key: int) -> DealtDimension:
    """A dimension that was dealt before."""
    folders = dealt_into(paths)
    if folders is None:
        raise ValueError("not a table in key folders")
    return DealtDimension(list(paths), folders, max_key)


def apply_to_folders(spark: SparkSession, dealt: DealtDimension, changes: DataFrame, path: str,
                     schema: T.StructType, *, natural_key: str = "customer_id",
                     surrogate_key: str = "customer_key", apart: str = "is_current",
                     **options) -> DealtDimension:
    """Apply a change batch; the touched folders are written under ``path``.

    ``options`` go to ``scd2_apply``.  A batch without changes, or with changes of
    unknown keys in empty folders only, replaces nothing.  The old folders are left
    for readers of the version before.
    """
    touched = touched_folders(changes, natural_key, dealt.folders)
    old, kept = split_folders(dealt.paths, touched)
    if not old:
        return DealtDimension(dealt.paths, dealt.folders, dealt.max_key)
    after = scd2_apply(read_folders(spark, old, schema), changes, natural_key=natural_key,
                       surrogate_key=surrogate_key, max_key=dealt.max_key, **options)
    written = write_checked(after, "changed dimension", schema, lambda df: write_key_folders(
        df, path, natural_key, dealt.folders, apart))
    last = read_folders(spark, written, schema).agg(F.max(surrogate_key)).first()[0]
    return DealtDimension([*kept, *written], dealt.folders, max(dealt.max_key, int(last or 0)),
                          frozenset(touched), tuple(written))
