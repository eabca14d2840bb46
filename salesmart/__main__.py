"""Command line: run the whole job on raw files.

    python -m salesmart CUSTOMERS PRODUCTS ORDERS OUTPUT [--lines] [--orders-layout LAYOUT]
                        [--products-splittable] [--hot-share SHARE] [--master MASTER]

CUSTOMERS is a workbook, a folder of workbooks or a glob; PRODUCTS is CSV
(``--products-splittable``: without line breaks in quotes, so that large files
can be split); ORDERS is JSON, one top-level array per file or JSON lines,
looked up by default.  ``--lines`` keeps every line of a multi-line order.
Prints the row count of each published table.
"""

from __future__ import annotations

import argparse

from salesmart.operators.marts import table_counts
from salesmart.plans.etl import run_etl
from salesmart.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="salesmart")
    parser.add_argument("customers")
    parser.add_argument("products")
    parser.add_argument("orders")
    parser.add_argument("output")
    parser.add_argument("--lines", action="store_true")
    parser.add_argument("--orders-layout", choices=("auto", "array", "lines"), default="auto")
    parser.add_argument("--products-splittable", action="store_true")
    parser.add_argument("--hot-share", type=float, default=None,
                        help="salt customers/products holding more than this share of orders")
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    tables = run_etl(spark, args.customers, args.products, args.orders, args.output,
                     order_key=None if args.lines else ("Order ID",),
                     orders_multiline={"auto": None, "array": True, "lines": False}[args.orders_layout],
                     products_multiline=not args.products_splittable, hot_share=args.hot_share)
    table_counts(tables).show(truncate=False)


if __name__ == "__main__":
    main()
