"""Command-line jobs (run with ``python -m strataform`` or ``spark-submit``).

    python -m strataform build --sf-dir DIR --out ROOT     build from the driver tables
    python -m strataform build --source-dir DIR --format csv --out ROOT
                                                           build from the eight source tables
    python -m strataform marts --out ROOT [--rows N]       print the published marts

On a cluster, submit with ``spark-submit --master ...`` and set
``spark.checkpoint.dir`` and ``spark.sql.shuffle.partitions`` there; the
session is taken from the submit configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import marts
from .plans.warehouse import run_build
from .session import apply_required_conf, build_session, ensure_checkpoint_dir
from .sources.io import load_source_tables
from .sources.published import published_table


def _session(local: bool) -> SparkSession:
    if local:
        return build_session()
    spark = SparkSession.builder.appName("strataform").getOrCreate()
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def main() -> None:
    ap = argparse.ArgumentParser(prog="strataform")
    sub = ap.add_subparsers(dest="command", required=True)
    build = sub.add_parser("build", help="run the audited layered build")
    origin = build.add_mutually_exclusive_group(required=True)
    origin.add_argument("--sf-dir", help="folder of the driver tables")
    origin.add_argument("--source-dir", help="folder with the eight source tables")
    build.add_argument("--format", default="parquet", help="format of the source tables")
    build.add_argument("--out", required=True, help="warehouse root (shared storage)")
    show = sub.add_parser("marts", help="print the marts of a built warehouse")
    show.add_argument("--out", required=True)
    show.add_argument("--rows", type=int, help="print only the first rows (default: all)")
    for p in (build, show):
        p.add_argument("--local", action="store_true", help="local session with defaults")
    args = ap.parse_args()
    spark = _session(args.local)
    if args.command == "build":
        sources = (load_source_tables(spark, args.source_dir, args.format)
                   if args.source_dir else None)
        run_build(spark, args.sf_dir, args.out, sources=sources).show(1000, truncate=False)
    else:
        for name in marts.MARTS:
            published_table(spark, args.out, "marts", name).createOrReplaceTempView(name)
            print(f"== {name}")
            mart = marts.read_mart(spark, name)
            # A mart has a row per month and store, product, seller or city.
            mart.show(mart.count() if args.rows is None else args.rows, truncate=False)



if __name__ == "__main__":
    main()
