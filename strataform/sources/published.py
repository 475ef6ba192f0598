"""The versions of a published warehouse.

A build or a further batch writes a new run folder and, once its checks pass, adds
the next numbered file to ``<root>/published``, which lists the folders of every
table.  Readers see the tables of one version, never a mixture, and a failed build
changes nothing for them.

A version file is renamed into place only if no other writer has taken that
number, so of two writers that started from one version the second fails
(``ConcurrentPublish``) and loses nothing of the first.  This needs a file system
whose rename refuses an existing target.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .io import conform

FOLDER = "published"
_NUMBERED = re.compile(r"(\d{12})\.json$")
#: Folders that hold the rows of one sales month.
MONTH_FOLDER = "month_folder"
_MONTH = re.compile(MONTH_FOLDER + r"=(\d+)/?$")


class ConcurrentPublish(RuntimeError):
    """Another writer has published since this one read the tables."""


def new_run(root: str) -> str:
    return f"{root.rstrip('/')}/runs/{uuid.uuid4().hex}"


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def last_version(spark: SparkSession, root: str) -> int:
    """The number of the last published version; 0 if nothing is published."""
    found = (_NUMBERED.match(n) for n in list_names(spark, f"{root.rstrip('/')}/{FOLDER}"))
    return max((int(m.group(1)) for m in found if m), default=0)


def publish_tables(spark: SparkSession, root: str, run: str, tables: dict[str, list[str]],
                   after: int | None = None, state: dict[str, int] | None = None) -> int:
    """Publish ``tables`` (``layer/table`` -> folders) as the version that follows
    ``after`` (the last one if not given); its number.  ``state`` holds numbers that
    later batches go on from."""
    number = (last_version(spark, root) if after is None else after) + 1
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(f"{root.rstrip('/')}/{FOLDER}/{number:012d}.json")
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    written = hadoop.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    text = json.dumps({"run": run, "tables": tables, "version": number,
                       "state": state or {}}, indent=1, sort_keys=True)
    out = fs.create(written, False)
    out.write(bytearray(text.encode()))
    out.close()
    never = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    never[0] = getattr(hadoop.Options.Rename, "NONE")
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(written, target, never)
    except Exception as failure:
        taken = fs.exists(target)
        fs.delete(written, False)
        if taken:
            raise ConcurrentPublish(f"version {number} is already published") from failure
        raise
    return number


def published(spark: SparkSession, root: str) -> dict:
    """``{"run": folder, "tables": {"layer/table": [folders]}, "version": n,
    "state": {name: number}}`` of the last published version."""
    number = last_version(spark, root)
    if not number:
        raise FileNotFoundError(f"nothing is published under {root}")
    path = f"{root.rstrip('/')}/{FOLDER}/{number:012d}.json"
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_folders(spark: SparkSession, folders: list[str], schema: T.StructType | None = None
                 ) -> DataFrame:
    """The rows of a table that lies in several folders."""
    if not folders:
        if schema is None:
            raise ValueError("no folder and no schema")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*folders)
    return conform(df, schema) if schema is not None else df


def published_table(spark: SparkSession, root: str, layer: str, table: str,
                    schema: T.StructType | None = None) -> DataFrame:
    return read_folders(spark, published(spark, root)["tables"][f"{layer}/{table}"], schema)


def month_of(folder: str) -> int | None:
    """The sales month a folder holds, if it holds one."""
    found = _MONTH.search(folder)
    return int(found.group(1)) if found else None


def write_months(df: DataFrame, path: str, month) -> list[str]:
    """Write ``df`` with one folder for each value of the column ``month``; the
    folders.  Rows are dealt by month, large months to several tasks."""
    spark = df.sparkSession
    (df.withColumn(MONTH_FOLDER, month).hint("rebalance", MONTH_FOLDER)
     .write.partitionBy(MONTH_FOLDER).parquet(path))
    return [f"{path}/{n}" for n in sorted(list_names(spark, path)) if month_of(n) is not None]


def folders_outside(folders: Iterable[str], months: set[int]) -> list[str]:
    return [f for f in folders if month_of(f) not in months]


def folders_of(folders: Iterable[str], months: set[int]) -> list[str]:
    return [f for f in folders if month_of(f) in months]
