"""The performance lab on generated data: layouts x queries, then query pairs.

``python bench_lab.py [rows] [layout ...]`` writes the layouts below a new
folder (or $BENCH_LAB_DIR, where finished layouts are used again), runs every query to the ``noop`` sink (one cold run, then
$BENCH_RUNS warm ones) and prints one JSON line with warm medians in milliseconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date

from strata.operators import lab, layout
from strata.session import local_session
from strata.sources import generate

KEYS = ["customer_id", "sale_date"]
COLD_CUSTOMER = 4711
WINDOW = date(2024, 3, 1), date(2024, 3, 30)
MONTH = date(2024, 3, 1), date(2024, 3, 31)
HALF_YEAR = date(2024, 1, 1), date(2024, 6, 30)


def warm_ms(build, runs: int = int(os.environ.get("BENCH_RUNS", "2"))) -> int:
    taken = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        taken.append((time.perf_counter() - start) * 1000)
    return int(statistics.median(taken[1:]))


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 50_000_000
    wanted = sys.argv[2:] or ["compacted", "zorder", "clustered"]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench_lab")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    base = os.environ.get("BENCH_LAB_DIR") or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    out: dict[str, object] = {"rows": rows}

    if not os.path.exists(f"{base}/source/_SUCCESS"):
        generate.sales_of_size(spark, rows).write.mode("overwrite").parquet(f"{base}/source")
    source = spark.read.parquet(f"{base}/source")
    writers = {
        "smallfiles": lambda path: layout.write_small_files(source, path, 1600),
        "compacted": lambda path: layout.compact(spark, f"{base}/source", path, 64 * 1024 * 1024),
        "zorder": lambda path: layout.write_zorder(source, path, KEYS),
        "clustered": lambda path: layout.write_clustered(source, path, KEYS),
        "partitioned": lambda path: layout.write_partitioned(source, path, "sale_date"),
    }
    tables = {}
    for name in wanted:
        start = time.perf_counter()
        if not os.path.exists(f"{base}/{name}/_SUCCESS"):
            writers[name](f"{base}/{name}")
        print(f"wrote {name} {time.perf_counter() - start:.1f} s", file=sys.stderr, flush=True)
        tables[name] = spark.read.parquet(f"{base}/{name}")

    for name, table in tables.items():
        out[name] = {
            "selective": warm_ms(
                lambda t=table: lab.selective_window(t, "customer_id", COLD_CUSTOMER, *WINDOW)
            ),
            "single_day": warm_ms(lambda t=table: lab.single_day(t, date(2024, 6, 15))),
            "full_scan": warm_ms(lambda t=table: lab.full_scan(t)),
        }
        print(name, out[name], file=sys.stderr, flush=True)

    sales = tables[wanted[0]]
    customers, products, promotions = (
        generate.all_customers(spark).drop("region"),
        generate.all_products(spark),
        generate.all_promotions(spark),
    )
    pairs = {
        "exploding_bad": lambda: lab.promoted_distinct(sales, promotions, *MONTH),
        "exploding_rewritten": lambda: lab.promoted(sales, promotions, *MONTH),
        "nonsargable_bad": lambda: lab.month_by_functions(tables[wanted[-1]], 2024, 6),
        "nonsargable_rewritten": lambda: lab.month_by_range(tables[wanted[-1]], 2024, 6),
        "distinct_bad": lambda: lab.labelled(sales, products, "product_id", *HALF_YEAR).distinct(),
        "distinct_rewritten": lambda: lab.labelled(sales, products, "product_id", *HALF_YEAR),
        "dim_join_shuffle": lambda: lab.brand_by_shuffle(sales, products, "product_id"),
        "dim_join_broadcast": lambda: lab.brand_by_broadcast(sales, products, "product_id"),
        "skew_join_shuffled": lambda: lab.segment_join_shuffled(
            sales, customers, "customer_id", ["segment"]
        ),
        "skew_join": lambda: lab.segment_join(sales, customers, "customer_id", ["segment"]),
        "skew_join_salted": lambda: lab.segment_join_salted(
            sales, customers, "customer_id", ["segment"], share=0.01, floor=0
        ),
        "scan_two_keys": lambda: lab.scan_by_two_keys(sales),
        "selective_open": lambda: lab.selective_open(
            sales, "customer_id", COLD_CUSTOMER, date(2024, 1, 1)
        ),
    }
    for name, build in pairs.items():
        out[name] = warm_ms(build)
        print(name, out[name], file=sys.stderr, flush=True)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
