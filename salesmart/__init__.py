"""salesmart: retail data-quality checks and profit marts as Spark DataFrame plans.

Every public operator takes and returns lazy ``DataFrame`` objects; nothing is
collected to the driver.  The modules are grouped as

* ``functions``  column expressions: validation rules, date/number parsing,
  name imputation;
* ``operators``  DataFrame -> DataFrame steps: dedup, cleaning, referential
  checks, dimensions, the enriched fact, the profit mart and its roll-ups;
* ``sources``    readers for workbooks, CSV, JSON and parquet, plus the raw
  views derived from the TPC-H-style test tables;
* ``plans``      sinks and the end-to-end pipeline (``run_etl``);
"""

from salesmart.operators.dedup import keep_one_per_key
from salesmart.operators.quality import clean_customers, clean_products
from salesmart.operators.refs import clean_orders, annotate_orders
from salesmart.operators.dims import build_customer_dim, build_product_dim
from salesmart.operators.facts import build_orders_enriched
from salesmart.operators.marts import (
    aggregate_profit_by,
    first_rows,
    preview,
    rollup_sql,
    profit_by_year,
    profit_by_year_category,
    profit_by_customer,
    profit_by_customer_year,
    issue_summary,
    table_counts,
)
from salesmart.operators.skew import hot_keys, left_lookup
from salesmart.plans.etl import publish_tables, run_etl, run_pipeline
from salesmart.plans.sinks import write_parquet
from salesmart.sources.files import read_customers, read_products, read_orders

__all__ = [
    "keep_one_per_key",
    "clean_customers",
    "clean_products",
    "clean_orders",
    "annotate_orders",
    "build_customer_dim",
    "build_product_dim",
    "build_orders_enriched",
    "aggregate_profit_by",
    "first_rows",
    "preview",
    "rollup_sql",
    "hot_keys",
    "left_lookup",
    "publish_tables",
    "profit_by_year",
    "profit_by_year_category",
    "profit_by_customer",
    "profit_by_customer_year",
    "issue_summary",
    "table_counts",
    "run_etl",
    "run_pipeline",
    "write_parquet",
    "read_customers",
    "read_products",
    "read_orders",
]
