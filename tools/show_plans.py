"""Write the final (post-AQE) physical plans of the key outputs to PLANS.md.

usage: python tools/show_plans.py [sf_dir]
Each output is executed once (noop sink is not used: the plan of the same
DataFrame object is read after it ran, so AQE's final decisions show).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.operators.facts import enriched_from_annotated  # noqa: E402
from salesmart.operators.refs import annotate_orders  # noqa: E402
from salesmart.plans.catalog import rendered  # noqa: E402
from salesmart.plans.etl import publish_tables, run_pipeline  # noqa: E402
from salesmart.plans.sinks import read_published  # noqa: E402
from salesmart.session import build_session, shared_dir  # noqa: E402
from salesmart.sources.testdata import raw_tables  # noqa: E402

SHOW = ("order_data_issues", "aggregates", "customer_data_issues")


def final_plan(spark, df) -> str:
    df.collect()
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(),
                                                                "formatted")
    tree = text.split("\n\n\n")[0]
    details = [block for block in text.split("\n\n")
               if block.lstrip().startswith("(") and ("Scan parquet" in block or "Exchange" in block
                                                       and "hashpartitioning" in block)]
    return tree + "\n\n" + "\n\n".join(details)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    outputs = run_pipeline(*raw_tables(spark, sf))
    out = ["# Final physical plans", "",
           f"Generated by `tools/show_plans.py` on `{sf}` with `local[8]`, after each",
           "output ran, so the plans show AQE's final choices.", ""]
    for name in SHOW:
        df = rendered(outputs[name])
        out += [f"## {name}", "", "```", final_plan(spark, df).strip(), "```", ""]
    # the publish path: orders checked and enriched against the written dimensions
    raw = raw_tables(spark, sf)
    base = shared_dir(spark, "plans")
    publish_tables(spark, *raw, base)
    dims = read_published(spark, base, ["customers", "products"])
    fact = enriched_from_annotated(annotate_orders(raw[2], dims["customers"], dims["products"],
                                                   rebalance_dims=False))
    out += ["## orders_enriched against the written dimensions (publish path)", "", "```",
            final_plan(spark, fact).strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print("wrote", path)


if __name__ == "__main__":
    main()
