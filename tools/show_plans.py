"""Print the physical plans of the fact load and of every mart.

    python tools/show_plans.py [--sf-dir DIR] [--full]

Builds the warehouse into a fresh folder (``run_build``), then explains the
fact load over the written staging layer and each mart over the written star
schema.  Without ``--full`` only the operator tree and the scan lines
(pushed filters, read schema, bucketing, partition filters) are printed.
"""

from __future__ import annotations

import argparse
import io
import os
import re
import sys
import tempfile
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strataform import build_session, schemas  # noqa: E402
from strataform.operators.facts import fact_sales  # noqa: E402
from strataform.plans import marts  # noqa: E402
from strataform.plans.warehouse import BUCKETED, build_database, run_build  # noqa: E402
from strataform.sources.io import conform, read_table, table_path  # noqa: E402
from strataform.sources.published import published  # noqa: E402

KEEP = re.compile(r"^(\s*[+:|-]|\(\d+\) |PushedFilters|ReadSchema|PartitionFilters|Bucketed|"
                  r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition))")


def explain(df, full: bool) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    if full:
        return text
    return "\n".join(line for line in text.splitlines() if KEEP.match(line.strip() and line))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--full", action="store_true")
    ap.add_argument("--broadcast-threshold", default=None,
                    help="e.g. 256k: only tables under this size are broadcast, which gives "
                         "the plan shapes of a large scale factor on small data")
    args = ap.parse_args()
    extra = {}
    if args.broadcast_threshold:
        extra = {"spark.sql.autoBroadcastJoinThreshold": args.broadcast_threshold,
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": args.broadcast_threshold}
    spark = build_session(shuffle_partitions=16, extra=extra)
    root = tempfile.mkdtemp(prefix="strataform-plans-")
    run_build(spark, args.sf_dir, root)
    root = published(spark, root)["run"]
    database = build_database(spark, root)
    stg = {}
    for name in schemas.STAGING:
        if name in BUCKETED:
            stg[name] = conform(spark.table(f"{database}.{name}"), schemas.STAGING[name])
        else:
            stg[name] = read_table(spark, table_path(root, "staging", name), schemas.STAGING[name])
    star = {n: read_table(spark, table_path(root, "star", n), schemas.STAR[n])
            for n in ("dim_date", "dim_store", "dim_employee", "dim_product", "fact_sales")}
    star["dim_customer"] = read_table(spark, table_path(root, "star", "dim_customer_v2"),
                                      schemas.STAR["dim_customer"])
    initial = read_table(spark, table_path(root, "star", "dim_customer"),
                         schemas.STAR["dim_customer"])
    print("## fact_sales load\n")
    print(explain(fact_sales(stg["stg_sales_order_items"], stg["stg_sales_orders"],
                             stg["stg_product_returns"], initial, star["dim_product"],
                             star["dim_store"], star["dim_employee"]), args.full))
    for name, build in marts.MARTS.items():
        print(f"\n## {name}\n")
        print(explain(build(star), args.full))
    spark.stop()


if __name__ == "__main__":
    main()
