"""The end-to-end job: raw tables -> seven output tables.

``run_pipeline`` builds the output catalogue as lazy DataFrames.  By default
the referential check and the enrichment share one left join per dimension
(``refs.annotate_orders``); ``fused=False`` runs them as separate steps.
Every lookup join rebalances its dimension side, so AQE can broadcast a
dimension it measures as small and split the orders partition of a hot key
(``operators/skew.py``).

``run_etl`` reads the raw files, publishes the seven tables as parquet
(``publish_tables``) and returns them re-read from the written files.  Each
annotated table feeds two outputs: the dimensions are persisted while theirs
are written, the orders are staged in the shared folder.  Each later step
reads the tables the earlier one wrote, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart import schemas as S
from salesmart.operators.dims import build_customer_dim, build_product_dim
from salesmart.operators.facts import build_orders_enriched, enriched_from_annotated
from salesmart.operators.marts import MART_KEYS, aggregate_profit_by
from salesmart.operators.quality import (
    annotate_customers,
    annotate_products,
    customer_issue_report,
    impute_customer_names,
    product_issue_report,
    valid_products,
)
from salesmart.operators.refs import (
    DEFAULT_ORDER_KEY,
    annotate_orders,
    clean_orders,
    order_issue_report,
)
from salesmart.plans.sinks import Run, read_published, write_parquet
from salesmart.session import drop_shared, shared_dir
from salesmart.sources.files import read_customers, read_orders, read_products

# Output table names (fixed values).
OUTPUT_TABLES = (
    "customer_data_issues",
    "product_data_issues",
    "order_data_issues",
    "customers",
    "products",
    "orders_enriched",
    "aggregates",
)


def run_pipeline(customers_raw: DataFrame, products_raw: DataFrame, orders_raw: DataFrame,
                 order_key: Sequence[str] | None = DEFAULT_ORDER_KEY, fused: bool = True,
                 dedup: str = "aggregate",
                 hot_share: float | None = None) -> dict[str, DataFrame]:
    """The seven output tables as lazy DataFrames.  ``hot_share`` salts the
    customers and products holding more than that share of the orders
    (``operators/skew.py``)."""
    customers = annotate_customers(customers_raw, dedup)
    products = annotate_products(products_raw, dedup)
    customers_clean = impute_customer_names(customers)
    products_clean = valid_products(products)
    customer_dim = build_customer_dim(customers_clean)
    product_dim = build_product_dim(products_clean)
    if fused:
        orders = annotate_orders(orders_raw, customer_dim, product_dim, order_key, dedup,
                                 hot_share=hot_share)
        order_issues = order_issue_report(orders)
        enriched = enriched_from_annotated(orders)
    else:
        orders_clean, order_issues = clean_orders(orders_raw, customers_clean, products_clean,
                                                  order_key, dedup, hot_share=hot_share)
        enriched = build_orders_enriched(orders_clean, customer_dim, product_dim,
                                         hot_share=hot_share)
    return {
        "customer_data_issues": customer_issue_report(customers),
        "product_data_issues": product_issue_report(products),
        "order_data_issues": order_issues,
        "customers": customer_dim,
        "products": product_dim,
        "orders_enriched": enriched,
        "aggregates": aggregate_profit_by(enriched),
    }


def publish_tables(spark: SparkSession, customers_raw: DataFrame, products_raw: DataFrame,
                   orders_raw: DataFrame, output_base: str,
                   order_key: Sequence[str] | None = DEFAULT_ORDER_KEY, dedup: str = "aggregate",
                   persist: bool = True,
                   hot_share: float | None = None) -> dict[str, DataFrame]:
    """Write the seven tables in three steps, each reading what the previous
    one wrote, and return them re-read from the files.  They become visible
    together (``sinks.Run``): a run that fails leaves the former tables.

    1. customers and products: the annotated tables are persisted while their
       issue report and dimension are written;
    2. orders: checked and enriched against the dimensions *as written*
       (the join side is a file scan, so AQE measures its shuffle and
       broadcasts it only when it is small), written once to a staging
       folder in the shared store, from which the issue report and the fact
       are written; the folder is then deleted;
    3. the mart, aggregated from the written fact.
    """
    run = Run(spark, output_base)
    try:
        _write_tables(spark, run, customers_raw, products_raw, orders_raw, order_key, dedup, persist, hot_share)
    except BaseException:
        run.abort()
        raise
    run.commit()
    return read_published(spark, output_base, OUTPUT_TABLES, run.schemas)


def _write_tables(spark: SparkSession, run: Run, customers_raw: DataFrame, products_raw: DataFrame,
                  orders_raw: DataFrame, order_key: Sequence[str] | None, dedup: str, persist: bool,
                  hot_share: float | None) -> None:
    level = StorageLevel.MEMORY_AND_DISK
    customers = annotate_customers(customers_raw, dedup)
    products = annotate_products(products_raw, dedup)
    if persist:
        customers.persist(level)
        products.persist(level)
    try:
        run.write({"customer_data_issues": customer_issue_report(customers),
                   "customers": build_customer_dim(impute_customer_names(customers)),
                   "product_data_issues": product_issue_report(products),
                   "products": build_product_dim(valid_products(products))})
    finally:
        if persist:
            customers.unpersist()
            products.unpersist()

    def table(name: str) -> DataFrame:
        return spark.read.schema(run.schemas[name]).parquet(f"{run.folder}/{name}")

    orders = annotate_orders(orders_raw, table("customers"), table("products"), order_key, dedup,
                             hot_share=hot_share, rebalance_dims=False)
    staging = shared_dir(spark, "staging")
    try:
        write_parquet(orders, staging)
        staged = spark.read.schema(orders.schema).parquet(staging)
        run.write({"order_data_issues": order_issue_report(staged),
                   "orders_enriched": enriched_from_annotated(staged)})
    finally:
        drop_shared(spark, staging)
    run.write({"aggregates": aggregate_profit_by(table("orders_enriched"))})


def output_counts(customers_raw: DataFrame, products_raw: DataFrame, orders_raw: DataFrame,
                  order_key: Sequence[str] | None = DEFAULT_ORDER_KEY, dedup: str = "aggregate",
                  hot_share: float | None = None) -> DataFrame:
    """(table_name, row_count) of the seven outputs, without writing them.

    Each input is cleaned once: the orders path ends in one aggregate that
    counts reports, facts and mart rows, and the dimensions it joins share
    their dedup shuffle with the counts of customers and products.
    """
    customers = annotate_customers(customers_raw, dedup)
    products = annotate_products(products_raw, dedup)
    orders = annotate_orders(orders_raw, build_customer_dim(impute_customer_names(customers)),
                             build_product_dim(valid_products(products)), order_key, dedup, hot_share=hot_share)
    price = F.col(S.UNIT_PRICE)
    groups = (orders.withColumns({"Year": F.year("OrderDate"), "reported": F.size("Issues") > 0})
              .groupBy(*MART_KEYS, "reported").agg(F.count(F.lit(1)).alias("lines")))
    reported = F.col("reported")
    counts = [
        customers.agg(F.count_if(F.size("Issues") > 0).alias("customer_data_issues"),
                      F.count(F.lit(1)).alias("customers")),
        products.agg(F.count_if(price < 0).alias("product_data_issues"), F.count_if(price >= 0).alias("products")),
        groups.agg(F.coalesce(F.sum(F.when(reported, F.col("lines"))), F.lit(0)).alias("order_data_issues"),
                   F.coalesce(F.sum(F.when(~reported, F.col("lines"))), F.lit(0)).alias("orders_enriched"),
                   F.count_if(~reported).alias("aggregates"))]
    return reduce(DataFrame.unionByName, [c.unpivot([], c.columns, "table_name", "row_count") for c in counts])


def run_etl(spark: SparkSession, customers_path: str, products_path: str, orders_path: str,
            output_base: str, order_key: Sequence[str] | None = DEFAULT_ORDER_KEY,
            orders_multiline: bool | None = None, products_multiline: bool = True, persist: bool = True,
            hot_share: float | None = None) -> dict[str, DataFrame]:
    """Read the raw files, clean, enrich, aggregate and publish."""
    return publish_tables(spark, read_customers(spark, customers_path),
                          read_products(spark, products_path, multiline=products_multiline),
                          read_orders(spark, orders_path, multiline=orders_multiline),
                          output_base, order_key=order_key, persist=persist,
                          hot_share=hot_share)
