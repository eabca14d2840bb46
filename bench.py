"""Benchmark of the headline queries.

Runs the whole set once on ``$BENCH_WARM_DIR`` (default sf0.01, a tenth of
the timed size) to warm the JVM, its JIT and the codegen cache, then times
one run of each on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``.  The set follows the job's own flow:

* ``plan_build``: the output catalogue planned once from the raw tables;
* the five job outputs computed from the raw tables (``noop`` sink, nothing
  collected): customer, product and order issues, the enriched fact and the
  profit mart, and the profit by year from the raw tables;
* ``publish_all``: the whole job writing its seven parquet tables;
* the four roll-ups as SQL text over the published ``aggregates`` table
  (re-read, registered as a temp view), as the job answers them.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.operators.marts import ROLLUP_SQL, profit_by_year, register_aggregates  # noqa: E402
from salesmart.plans.catalog import rendered  # noqa: E402
from salesmart.plans.etl import publish_tables, run_pipeline  # noqa: E402
from salesmart.session import build_session, shared_dir  # noqa: E402
from salesmart.sources.testdata import raw_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")


HEADLINE = {
    "customer_issues": lambda o: rendered(o["customer_data_issues"]),
    "product_issues": lambda o: rendered(o["product_data_issues"]),
    "order_issues": lambda o: rendered(o["order_data_issues"]),
    "orders_enriched": lambda o: o["orders_enriched"],
    "profit_mart": lambda o: o["aggregates"],
    "profit_by_year_raw": lambda o: profit_by_year(o["aggregates"]),
}


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def run_set(spark, sf):
    times = {}
    t0 = time.perf_counter()
    raw = raw_tables(spark, sf)
    outputs = run_pipeline(*raw)
    times["plan_build"] = time.perf_counter() - t0
    for name, fn in HEADLINE.items():
        t0 = time.perf_counter()
        _noop(fn(outputs))
        times[name] = time.perf_counter() - t0
    t0 = time.perf_counter()
    published = publish_tables(spark, *raw, shared_dir(spark, "bench"))
    times["publish_all"] = time.perf_counter() - t0
    for name, sql in ROLLUP_SQL.items():
        t0 = time.perf_counter()
        register_aggregates(published["aggregates"])
        _noop(spark.sql(sql))
        times[name] = time.perf_counter() - t0
    return {k: round(v, 3) for k, v in times.items()}


def main():
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=CPUS,
                          extra={"spark.driver.memory": "16g"})
    if WARM_DIR and os.path.isdir(WARM_DIR):
        run_set(spark, WARM_DIR)
    times = run_set(spark, SF_DIR)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
