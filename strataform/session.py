"""Spark session defaults and the shared checkpoint folder.

The library never creates a session behind the caller's back: every public
function takes the caller's ``SparkSession`` (or DataFrames bound to it).
``build_session`` is a convenience for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the warehouse relies on for correct results.
REQUIRED_CONF = {
    # Dates are stored without zone; keep casts and calendar functions stable.
    "spark.sql.session.timeZone": "UTC",
    # Overflow into DECIMAL(12,2) and bad casts must fail, as in strict SQL.
    "spark.sql.ansi.enabled": "true",
}

# Settings for scale: runtime re-planning, skew splitting, partition sizing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Dimensions are joined to the fact by hash join when the measured size of
    # their rows is under this bound; anything larger stays a shuffle join.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Small driver-built tables (audit rows) go to the JVM as Arrow batches.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Bytes of files up to which a table is sent to all tasks before its rows are
# measured.  The planner only knows the size of the files, and the rows of a
# table of keys and repeated names take some twenty-four times that in memory.
FILE_BROADCAST = 256 << 10


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "strataform", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    ``master`` defaults to ``local[$BENCH_CPUS]`` or ``local[*]``.  On a cluster
    pass ``master=None`` and let ``spark-submit`` decide.
    """
    if master is None:
        cpus = os.environ.get("BENCH_CPUS")
        master = f"local[{cpus}]" if cpus else "local[*]"
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g")))
    for key, value in {**SCALE_CONF, **REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the settings results depend on, on any session handed to us."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    bound_broadcasts(spark)


def bound_broadcasts(spark: SparkSession) -> None:
    """Send a table to all tasks by the size of its rows, not of its files.

    The session's bound then holds for what adaptive execution measures, and
    tables of more than ``FILE_BROADCAST`` bytes of files are shuffled until they
    are measured.  A lower bound, or -1 for none, is left as it is.
    """
    planned, measured = (f"spark.sql.{x}autoBroadcastJoinThreshold" for x in ("", "adaptive."))
    bound = spark.conf.get(planned)
    if spark.conf.get(measured, None) is None:
        spark.conf.set(measured, bound)
    if _size(bound) > FILE_BROADCAST:
        spark.conf.set(planned, str(FILE_BROADCAST))


def _size(setting: str) -> int:
    """Bytes of a size setting such as 10485760b, 32m or -1."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only where unset.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; it is read from the session.  Only a local-mode
    session (tests, the benchmark) without that setting gets a fresh folder
    under the system temp directory.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local context
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, object store) before running the warehouse on a cluster")
    folder = tempfile.mkdtemp(prefix="strataform-ckpt-")
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def local_table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A small table built on the driver (audit rows, check results), sent to
    the JVM as one Arrow batch instead of through Python worker processes."""
    import pandas as pd

    names = [f.name for f in schema.fields]
    return spark.createDataFrame(pd.DataFrame.from_records(rows, columns=names), schema)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the checkpoint folder, removed with the scopes it is in."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for scope in getattr(_SCOPES, "open", []):
        scope.append(path)
    return path


def scratch_table(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the checkpoint folder and
    read it back.

    One job (the upstream plan runs once), the result survives lost
    executors, and the planner sees real file sizes for later join choices.
    ``codec`` is the compression if not the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SCOPES = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables that this thread writes inside the block are removed at its
    end; nothing that still reads them may leave the block."""
    paths: list[str] = []
    held = getattr(_SCOPES, "open", [])
    _SCOPES.open = [*held, paths]
    try:
        yield
    finally:
        _SCOPES.open = held
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in paths:
            folder = hadoop.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def outside_scopes():
    """What this thread writes inside the block belongs to no scope: for tables
    that are kept for later readers."""
    held = getattr(_SCOPES, "open", [])
    _SCOPES.open = []
    try:
        yield
    finally:
        _SCOPES.open = held


def written_once(build: Callable[[], DataFrame], spark: SparkSession, label: str) -> DataFrame:
    """The result of ``build`` as a scratch table that is kept; scratch tables
    written on the way are removed.  Kept tables are long lists of keys and small
    numbers, which zstd packs closer."""
    with scratch_scope(spark):
        df = build()
        with outside_scopes():
            return scratch_table(df, label, "zstd")
