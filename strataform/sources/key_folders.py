"""Tables dealt into folders by a hash of their key.

A batch that changes some keys reads and replaces only the folders of those keys;
the files of every other folder stay as they are and are not opened.  The number of
folders is chosen when a table is first dealt and is part of the folder names, so a
later session deals alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .published import list_names

_FOLDER = re.compile(r"key_folder_(\d+)=(\d+)(?:_-?\d+)?/?$")


def key_folder(key: str, folders: int) -> Column:
    """The folder of a key (64-bit integer); a null key has one too."""
    return F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(folders)).cast("int")


def folder_number(path: str) -> tuple[int, int] | None:
    """(number of folders, folder) of a path, if it is such a folder."""
    found = _FOLDER.search(path)
    return (int(found.group(1)), int(found.group(2))) if found else None


def dealt_into(paths: Iterable[str]) -> int | None:
    """The number of folders the table of ``paths`` is dealt into; None if any of
    them is not a key folder."""
    numbers = {folder_number(p) for p in paths}
    counts = {n[0] if n else None for n in numbers}
    if len(counts) > 1 and None not in counts:
        raise ValueError(f"folders of several dealings: {sorted(counts)}")
    return counts.pop() if len(counts) == 1 else None


def write_key_folders(df: DataFrame, path: str, key: str, folders: int,
                      apart: str | None = None) -> list[str]:
    """Write ``df`` with one folder per key folder, or, with the integer column
    ``apart``, one per key folder and value of it; the folders written.

    The column stays in the files, so a filter on it skips the files of its other
    values by their statistics.  Large folders are dealt to several tasks.
    """
    name = f"key_folder_{folders}"
    number = key_folder(key, folders).cast("string")
    folder = number if apart is None else F.concat_ws("_", number, F.col(apart).cast("string"))
    (df.withColumn(name, folder).hint("rebalance", name).write.partitionBy(name).parquet(path))
    return [f"{path}/{n}" for n in sorted(list_names(df.sparkSession, path)) if folder_number(n)]


def touched_folders(changes: DataFrame, key: str, folders: int) -> set[int]:
    """The folders that hold the keys of ``changes`` (at most ``folders`` rows)."""
    rows = changes.select(key_folder(key, folders).alias("f")).distinct().collect()
    return {r["f"] for r in rows}


def split_folders(paths: Iterable[str], touched: set[int]) -> tuple[list[str], list[str]]:
    """(paths of the folders ``touched``, all others)."""
    inside, outside = [], []
    for p in paths:
        (inside if folder_number(p)[1] in touched else outside).append(p)
    return inside, outside
