"""Benchmark: full layered build plus each mart, at $BENCH_SF_DIR.

Runs on ``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "warehouse_build_and_marts", "value": <total sec>, "unit": "sec",
     "queries": {"build_<step>": sec, ..., "<mart>": sec, ...}, "sf": <scale>}

The audited build runs twice into fresh folders: first in a new JVM
(``cold_*``), then again in the same running session (``build_*``, warm - the
counterpart of timing steps against an already running database server).
``build_<step>`` are the steps of the audited job (each writes its layer as
Parquet and reads it back); the mart timings then run every mart over the
written star schema (after the SCD2 batch) and fully materialise the result.
``value`` = warm build + marts.  One tiny job runs before everything and is
reported as ``warmup_sec``.  Output goes to fresh folders under $BENCH_OUT
(default: the system temp folder).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from strataform import build_session  # noqa: E402
from strataform import schemas  # noqa: E402
from strataform.plans import marts  # noqa: E402
from strataform.plans.warehouse import run_build  # noqa: E402
from strataform.sources.io import read_table, table_path  # noqa: E402
from strataform.sources.published import published  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(match.group(1)) if match else None
    out_base = os.environ.get("BENCH_OUT") or tempfile.gettempdir()

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    timings: dict[str, float] = {}
    # JVM and code-generation warm-up (one tiny shuffle), reported separately.
    tw = time.perf_counter()
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    warmup = time.perf_counter() - tw

    cold_root = tempfile.mkdtemp(prefix="strataform-bench-", dir=out_base)
    t0 = time.perf_counter()
    cold = run_build(spark, sf_dir, cold_root)
    cold_total = time.perf_counter() - t0
    for row in cold.collect():
        timings[f"cold_{row['step']}"] = row["seconds"]

    out_root = tempfile.mkdtemp(prefix="strataform-bench-", dir=out_base)
    t0 = time.perf_counter()
    audit = run_build(spark, sf_dir, out_root)
    out_root = published(spark, out_root)["run"]
    build_total = time.perf_counter() - t0
    for row in audit.collect():
        timings[f"build_{row['step']}"] = row["seconds"]

    star = {name: read_table(spark, table_path(out_root, "star", name), schemas.STAR[name])
            for name in ("dim_date", "dim_store", "dim_employee", "dim_product", "fact_sales")}
    star["dim_customer"] = read_table(spark, table_path(out_root, "star", "dim_customer_v2"),
                                      schemas.STAR["dim_customer"])
    fact_rows = star["fact_sales"].count()
    marts_total = 0.0
    for name, build in marts.MARTS.items():
        t1 = time.perf_counter()
        # Materialise every row and column without collecting them.
        build(star).write.mode("overwrite").format("noop").save()
        elapsed = time.perf_counter() - t1
        timings[name] = round(elapsed, 3)
        marts_total += elapsed

    result = {
        "metric": "warehouse_build_and_marts",
        "value": round(build_total + marts_total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": sf,
        "build_sec": round(build_total, 3),
        "cold_build_sec": round(cold_total, 3),
        "fact_rows": fact_rows,
        "fact_rows_per_build_sec": round(fact_rows / build_total, 1),
        "marts_sec": round(marts_total, 3),
        "warmup_sec": round(warmup, 3),
        "cpus": cpus,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
