"""Named queries over the test tables, each ``(spark, sf_dir) -> DataFrame``.

Every query builds the raw tables from the given parquet files
(``sources.testdata``) and runs the library's operators over all of them.
``Issues`` arrays are rendered as ``|``-joined text so that results compare
as plain columns.  The file queries write the raw tables in the source
format into a fresh folder under the shared checkpoint folder and read them
back through the library's readers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart import schemas as S
from salesmart.operators.dims import build_customer_dim, build_product_dim
from salesmart.operators.facts import build_orders_enriched
from salesmart.operators.marts import (
    aggregate_profit_by,
    first_rows,
    issue_summary,
    preview,
    profit_by_customer,
    profit_by_customer_year,
    profit_by_year,
    profit_by_year_category,
    rollup_sql,
    table_counts,
)
from salesmart.operators.quality import (
    annotate_customers,
    annotate_products,
    clean_customers,
    clean_products,
)
from salesmart.operators.refs import clean_orders
from salesmart.operators.skew import DEFAULT_HOT_SHARE
from salesmart.plans.bucketed import store_orders
from salesmart.plans.etl import OUTPUT_TABLES, output_counts, publish_tables, run_etl, run_pipeline
from salesmart.plans.sinks import published_counts, read_published
from salesmart.session import shared_dir
from salesmart.sources.excel import write_workbook_table
from salesmart.sources.files import read_customers, read_orders, read_products, write_csv
from salesmart.sources.testdata import raw_customers, raw_orders, raw_products, raw_tables

Query = Callable[[SparkSession, str], DataFrame]

ROWS_PER_ARRAY = 20_000
ARRAYS_PER_TASK = 8  # the tasks of a shuffle are fewer than the files, so its blocks stay large


def rendered(df: DataFrame) -> DataFrame:
    """``Issues`` array as ``|``-joined text, in rule order."""
    if "Issues" not in df.columns:
        return df
    return df.withColumn("Issues", F.concat_ws("|", F.col("Issues")))


def _outputs(spark: SparkSession, sf: str, order_key=(S.ORDER_ID,)) -> dict[str, DataFrame]:
    return run_pipeline(*raw_tables(spark, sf), order_key=order_key)


def _customers(spark, sf):
    return clean_customers(raw_customers(spark, sf))


def _products(spark, sf):
    return clean_products(raw_products(spark, sf))


def _orders(spark, sf, order_key=(S.ORDER_ID,)):
    customers, _ = _customers(spark, sf)
    products, _ = _products(spark, sf)
    return clean_orders(raw_orders(spark, sf), customers, products, order_key=order_key)


def _dims(spark, sf):
    customers, _ = _customers(spark, sf)
    products, _ = _products(spark, sf)
    return build_customer_dim(customers), build_product_dim(products)


def _enriched(spark, sf, order_key=(S.ORDER_ID,)):
    clean, _ = _orders(spark, sf, order_key)
    return build_orders_enriched(clean, *_dims(spark, sf))


def _mart(spark, sf):
    """The mart through the fused plan: one lookup join per dimension."""
    return _outputs(spark, sf)["aggregates"]


def _bucketed(spark, sf, order_key=(S.ORDER_ID,)):
    """The stored orders, and both dimensions written into their buckets."""
    store = store_orders(spark, raw_orders(spark, sf), shared_dir(spark, "bucketed"), order_key)
    customers, products = _dims(spark, sf)
    return store, store.store_dimension("customers", customers), store.store_dimension("products", products)


def order_issues_bucketed(spark, sf, order_key=(S.ORDER_ID,)):
    """The order report from orders and dimensions that lie bucketed on their keys."""
    store, customers, products = _bucketed(spark, sf, order_key)
    return rendered(store.issues(customers, products))


def orders_enriched_bucketed(spark, sf):
    """The fact from orders and dimensions that lie bucketed on their keys."""
    store, customers, products = _bucketed(spark, sf)
    return store.enriched(customers, products)


# --- files ----------------------------------------------------------------

def _csv_products(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "products-csv")
    write_csv(raw_products(spark, sf), folder)
    return read_products(spark, folder)


def _json_orders(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "orders-json")
    raw_orders(spark, sf).write.json(folder)
    return read_orders(spark, folder)


def _xlsx_customers(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "customers-xlsx")
    write_workbook_table(raw_customers(spark, sf), folder)
    return read_customers(spark, folder)


def csv_products_quoted(spark, sf):
    """Products whose names hold commas, quotes and line breaks, or a missing-value token, through CSV."""
    folder = shared_dir(spark, "products-quoted")
    name = F.col(S.PRODUCT_NAME)
    dirty = (F.when(F.length(name) % 5 == 0, F.concat(name, F.lit(', "big"\nsecond line')))
             .when(F.length(name) % 5 == 1, F.lit("N/A")).when(F.length(name) % 5 == 2, F.concat(F.lit('"'), name))
             .otherwise(name))
    write_csv(raw_products(spark, sf).withColumn(S.PRODUCT_NAME, dirty), folder)
    return read_products(spark, folder).withColumn(
        "Price per product", F.col("Price per product").try_cast("double"))


def write_json_arrays(orders: DataFrame, folder: str, rows: int = ROWS_PER_ARRAY, compression: str = "none") -> None:
    """Files ``file=N`` of one indented top-level array each, of about ``rows`` rows, as many as the table needs.

    Rows are dealt by their number, so equal rows spread over all files.  They
    are shuffled as columns and made text where they are written; a row is a
    text line of its own, and no array is held as a whole.  ``compression`` is
    a codec of Spark's text writer.
    """
    count = orders.count()
    if not count:
        empty = orders.sparkSession.createDataFrame([(0, "[]")], "file int, value string")
        return empty.write.partitionBy("file").option("compression", compression).text(folder)
    files = -(-count // rows)
    dealt = (orders.select(F.monotonically_increasing_id().alias("at"),
                           F.struct(*[F.col(S.q(c)) for c in orders.columns]).alias("row"))
             .withColumn("file", F.pmod("at", F.lit(files)).cast("int")).repartition(-(-files // ARRAYS_PER_TASK), "file"))
    inside = Window.partitionBy("file").orderBy("at")
    record = F.to_json("row", {"pretty": "true"})
    lines = dealt.select(
        "file", "at", F.concat(F.when(F.row_number().over(inside) == 1, F.lit("[\n")).otherwise(F.lit("")), record,
                               F.when(F.lead("at").over(inside).isNull(), F.lit("\n]")).otherwise(F.lit(","))).alias("value"))
    (lines.sortWithinPartitions("file", "at").select("file", "value")
     .write.partitionBy("file").option("compression", compression).text(folder))


def json_array_orders(spark, sf):
    """Orders from files that each hold one indented top-level array, read by the default call."""
    folder = shared_dir(spark, "orders-arrays")
    write_json_arrays(raw_orders(spark, sf), folder, compression="gzip")
    return read_orders(spark, f"{folder}/file=*")


def json_array_orders_split(spark, sf):
    """Orders from files of one indented top-level array each, every one split into its objects."""
    folder = shared_dir(spark, "orders-split")
    write_json_arrays(raw_orders(spark, sf), folder, compression="gzip")
    return read_orders(spark, f"{folder}/file=*", whole_bytes=0)


def csv_roundtrip(spark, sf):
    df = _csv_products(spark, sf)
    return df.withColumn("Price per product", F.col("Price per product").try_cast("double"))


def json_roundtrip(spark, sf):
    return _json_orders(spark, sf)


def xlsx_ingest(spark, sf):
    return _xlsx_customers(spark, sf)


def xlsx_alias_customers(spark, sf):
    """Customers from workbooks with an aliased country column, ``N/A`` names and empty phones."""
    folder = shared_dir(spark, "customers-alias")
    raw = raw_customers(spark, sf)
    planted = raw.withColumns({
        S.CUSTOMER_NAME: F.when(F.length(S.EMAIL) % 4 == 0, F.lit("N/A")).otherwise(F.col(S.q(S.CUSTOMER_NAME))),
        S.PHONE: F.when(F.length(S.EMAIL) % 3 == 0, F.lit(None)).otherwise(F.col(S.PHONE))})
    write_workbook_table(planted.withColumnRenamed(S.COUNTRY, " country_NAME"), folder)
    return read_customers(spark, folder)


def xlsx_customer_issues(spark, sf):
    return rendered(clean_customers(_xlsx_customers(spark, sf))[1])


def csv_product_issues(spark, sf):
    return rendered(clean_products(_csv_products(spark, sf))[1])


def json_order_issues(spark, sf):
    customers, _ = _customers(spark, sf)
    products, _ = _products(spark, sf)
    return rendered(clean_orders(_json_orders(spark, sf), customers, products)[1])


def _order_counts(orders: DataFrame) -> DataFrame:
    """Order lines, lines with every required value, and orders among those, from one scan."""
    usable = F.lit(True)
    for name in S.ORDER_REQUIRED:
        usable = usable & F.col(S.q(name)).isNotNull()
    usable = usable & ~F.isnan(S.PROFIT)
    counts = orders.agg(F.count(F.lit(1)).alias("orders_raw"), F.count_if(usable).alias("order_lines_keyed"),
                        F.count_distinct(F.when(usable, F.col(S.q(S.ORDER_ID)))).alias("orders_keyed"))
    return counts.unpivot([], counts.columns, "table_name", "row_count")


def cleaning_counts(spark, sf):
    """Rows of each raw input before and after the key check and dedup."""
    customers, products, orders = raw_tables(spark, sf)
    return table_counts({
        "customers_raw": customers, "customers_keyed": annotate_customers(customers),
        "products_raw": products, "products_keyed": annotate_products(products),
    }).unionByName(_order_counts(orders))


def parquet_publish(spark, sf):
    """Publish the seven tables; their rows as counted by the tasks that wrote them."""
    base = shared_dir(spark, "publish")
    publish_tables(spark, *raw_tables(spark, sf), base)
    return published_counts(spark, base)


def published_rows(spark, sf):
    """Publish the seven tables twice, then count the rows of the files that the second run left."""
    base = shared_dir(spark, "publish-rows")
    publish_tables(spark, *raw_tables(spark, sf), base, order_key=None)
    publish_tables(spark, *raw_tables(spark, sf), base)
    return table_counts(read_published(spark, base, OUTPUT_TABLES))


def run_etl_aggregates(spark, sf):
    """The whole job from raw files: workbooks, CSV and JSON in, parquet out;
    the mart as re-read from its written files."""
    cust = shared_dir(spark, "etl-customers")
    prod = shared_dir(spark, "etl-products")
    orders = shared_dir(spark, "etl-orders")
    c, p, o = raw_tables(spark, sf)
    write_workbook_table(c, cust)
    write_csv(p, prod)
    o.write.json(orders)
    return run_etl(spark, cust, prod, orders, shared_dir(spark, "etl-out"))["aggregates"]


QUERIES: dict[str, Query] = {
    # customers
    "customers_clean": lambda spark, sf: rendered(_customers(spark, sf)[0]),
    "customer_issues": lambda spark, sf: rendered(_customers(spark, sf)[1]),
    # products
    "products_clean": lambda spark, sf: _products(spark, sf)[0],
    "product_issues": lambda spark, sf: rendered(_products(spark, sf)[1]),
    # orders
    "orders_clean": lambda spark, sf: rendered(_orders(spark, sf)[0]),
    "orders_clean_lines": lambda spark, sf: rendered(_orders(spark, sf, None)[0]),
    "order_issues": lambda spark, sf: rendered(_orders(spark, sf)[1]),
    "order_issues_lines": lambda spark, sf: rendered(_orders(spark, sf, None)[1]),
    "issue_counts": lambda spark, sf: issue_summary({
        "customer_data_issues": _customers(spark, sf)[1],
        "product_data_issues": _products(spark, sf)[1],
        "order_data_issues": _orders(spark, sf)[1]}),
    # dimensions and fact
    "customer_dim": lambda spark, sf: _dims(spark, sf)[0],
    "product_dim": lambda spark, sf: _dims(spark, sf)[1],
    "orders_enriched": lambda spark, sf: _enriched(spark, sf),
    "orders_enriched_lines": lambda spark, sf: _enriched(spark, sf, None),
    "orders_enriched_unmatched": lambda spark, sf: build_orders_enriched(
        raw_orders(spark, sf), *_dims(spark, sf)),
    "orders_enriched_fused": lambda spark, sf: _outputs(spark, sf)["orders_enriched"],
    "order_issues_fused": lambda spark, sf: rendered(_outputs(spark, sf)["order_data_issues"]),
    "order_issues_bucketed": order_issues_bucketed,
    "order_issues_lines_bucketed": lambda spark, sf: order_issues_bucketed(spark, sf, None),
    "orders_enriched_bucketed": orders_enriched_bucketed,
    # mart and roll-ups
    "profit_aggregates": lambda spark, sf: aggregate_profit_by(_enriched(spark, sf)),
    "profit_aggregates_lines": lambda spark, sf: aggregate_profit_by(_enriched(spark, sf, None)),
    "profit_aggregates_fused": _mart,
    "profit_aggregates_salted": lambda spark, sf: run_pipeline(
        *raw_tables(spark, sf), hot_share=DEFAULT_HOT_SHARE)["aggregates"],
    "profit_by_year": lambda spark, sf: profit_by_year(_mart(spark, sf)),
    "profit_by_year_category": lambda spark, sf: profit_by_year_category(_mart(spark, sf)),
    "profit_by_customer": lambda spark, sf: profit_by_customer(_mart(spark, sf)),
    "profit_by_customer_year": lambda spark, sf: profit_by_customer_year(_mart(spark, sf)),
    # top-k forms (the first five rows are the feature)
    "first5_year": lambda spark, sf: first_rows(profit_by_year(_mart(spark, sf))),
    "first5_year_category": lambda spark, sf: first_rows(profit_by_year_category(_mart(spark, sf))),
    "top5_customers": lambda spark, sf: first_rows(profit_by_customer(_mart(spark, sf))),
    "first5_customer_year": lambda spark, sf: first_rows(profit_by_customer_year(_mart(spark, sf))),
    # the same roll-ups as SQL text over the temp view ``aggregates``
    "profit_by_year_sql": lambda spark, sf: rollup_sql(spark, "profit_by_year", _mart(spark, sf)),
    "profit_by_year_category_sql": lambda spark, sf: rollup_sql(
        spark, "profit_by_year_category", _mart(spark, sf)),
    "profit_by_customer_sql": lambda spark, sf: rollup_sql(
        spark, "profit_by_customer", _mart(spark, sf)),
    "profit_by_customer_year_sql": lambda spark, sf: rollup_sql(
        spark, "profit_by_customer_year", _mart(spark, sf)),
    # catalogue
    "table_counts": lambda spark, sf: output_counts(*raw_tables(spark, sf)),
    "cleaning_counts": cleaning_counts,
    "preview_orders_enriched": lambda spark, sf: preview(_outputs(spark, sf)["orders_enriched"]),
    "preview_customer_issues": lambda spark, sf: rendered(
        preview(_outputs(spark, sf)["customer_data_issues"])),
    # sources and sinks
    "csv_roundtrip": csv_roundtrip,
    "csv_products_quoted": csv_products_quoted,
    "json_array_orders": json_array_orders,
    "json_array_orders_split": json_array_orders_split,
    "json_roundtrip": json_roundtrip,
    "xlsx_ingest": xlsx_ingest,
    "xlsx_alias_customers": xlsx_alias_customers,
    "xlsx_customer_issues": xlsx_customer_issues,
    "csv_product_issues": csv_product_issues,
    "json_order_issues": json_order_issues,
    "parquet_publish": parquet_publish,
    "published_rows": published_rows,
    "run_etl_aggregates": run_etl_aggregates,
}
