"""Raw retail tables derived from the TPC-H-style test tables.

The test tables are clean (no missing keys, duplicates or orphans), so the
raw customer, product and order tables are built from them by deterministic
column expressions (SQL expression text, one call each) that plant every
kind of dirt the cleaning steps handle:
missing and duplicated keys, blank and malformed names, bad emails, phones,
postal codes and regions, negative and missing prices, unknown parent ids
and missing profits.  Duplicated rows come from ``explode`` of a one- or
two-element array, so every base table is scanned once.

Fixed values below: the modulus of every planted defect and the literal
texts it plants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart import schemas as S

# Region names mapped to a raw region text (valid, mixed case or padded).
REGION_TEXT = {"AFRICA": "North", "AMERICA": "south", "ASIA": " East ", "EUROPE": "CENTRAL"}

# Declared schemas of the test tables this module reads (no inference job).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


# Order lines that one task joins; fewer than ``PLAIN_JOIN_LINES`` in all are left to the planner.
LINES_PER_TASK = 500_000
PLAIN_JOIN_LINES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table."""
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _copies(key: str, every: int) -> str:
    """0 for the original row and 1 for its duplicate, on every ``every``-th key."""
    return f"explode(CASE WHEN {key} % {every} = 0 THEN array(0, 1) ELSE array(0) END) AS dup"


def _dmy(ts: str) -> str:
    return (f"concat_ws('/', CAST(day({ts}) AS STRING), CAST(month({ts}) AS STRING), "
            f"CAST(year({ts}) AS STRING))")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    base = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .selectExpr("c_custkey AS k", "c_name", "lower(c_mktsegment) AS seg", "n_name",
                         "r_name", _copies("c_custkey", 23)))
    region = " ".join(f"WHEN '{name}' THEN '{text}'" for name, text in REGION_TEXT.items())
    return base.selectExpr(
        f"CASE WHEN k % 97 = 0 THEN NULL ELSE concat('C', CAST(k AS STRING)) END AS `{S.CUSTOMER_ID}`",
        "CASE WHEN dup = 1 THEN 'Duplicate' WHEN k % 11 = 0 THEN NULL WHEN k % 11 = 1 THEN '   ' "
        f"WHEN k % 11 = 2 THEN c_name ELSE concat('  Client ', seg) END AS `{S.CUSTOMER_NAME}`",
        "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 13 = 1 THEN 'invalidemail' "
        f"ELSE concat(seg, CAST(k AS STRING), '@example.com') END AS `{S.EMAIL}`",
        "CASE k % 17 WHEN 0 THEN 'nan' WHEN 1 THEN '#ERROR!' WHEN 2 THEN '(555)-123-4567' "
        "WHEN 3 THEN '555.123.4567' WHEN 4 THEN '555-123-4567' "
        f"ELSE lpad(CAST(k AS STRING), 10, '5') END AS `{S.PHONE}`",
        "CASE k % 19 WHEN 0 THEN '1841' WHEN 1 THEN '12345.0' WHEN 2 THEN '12345-6789' "
        f"WHEN 3 THEN NULL ELSE lpad(CAST(k AS STRING), 5, '1') END AS `{S.POSTAL_CODE}`",
        f"CASE r_name {region} ELSE r_name END AS `{S.REGION}`",
        f"n_name AS `{S.COUNTRY}`",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS k", "p_name", "p_brand", "p_type", "p_retailprice", _copies("p_partkey", 37))
    return p.selectExpr(
        f"CASE WHEN k % 101 = 0 THEN NULL ELSE concat('P', CAST(k AS STRING)) END AS `{S.PRODUCT_ID}`",
        f"p_name AS `{S.PRODUCT_NAME}`",
        "CASE WHEN k % 31 = 0 THEN CAST(NULL AS DOUBLE) WHEN k % 29 = 0 THEN -p_retailprice "
        "ELSE p_retailprice + dup END AS `Price per product`",
        f"p_type AS `{S.CATEGORY}`",
        f"p_brand AS `{S.SUB_CATEGORY}`",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # The tasks of the join grow in number with the lines (counted from the file
    # footers), as the planner merges shuffle partitions by compressed size and
    # never adds any.
    if (lines := lineitem.count()) > PLAIN_JOIN_LINES:
        tasks = -(-lines // LINES_PER_TASK)
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    # Profit = price * (discount - 0.05), both rounded to cents, computed
    # exactly: in whole cents and basis points the product is an integer far
    # below 2**53, and dividing two exact integers rounds to the nearest
    # double, the same double the exact decimal product converts to.
    profit = ("CAST(CAST(rint(l_extendedprice * 100) AS BIGINT) "
              "* (CAST(rint(l_discount * 100) AS BIGINT) - 5) AS DOUBLE) / 10000.0")
    return j.selectExpr(
        "CASE WHEN l_orderkey % 211 = 0 THEN NULL "
        f"ELSE concat('O', CAST(l_orderkey AS STRING)) END AS `{S.ORDER_ID}`",
        "concat(CASE WHEN l_orderkey % 53 = 0 THEN 'X' ELSE 'C' END, CAST(o_custkey AS STRING)) "
        f"AS `{S.CUSTOMER_ID}`",
        "concat(CASE WHEN l_partkey % 41 = 0 THEN 'X' ELSE 'P' END, CAST(l_partkey AS STRING)) "
        f"AS `{S.PRODUCT_ID}`",
        f"{_dmy('o_orderdate')} AS `{S.ORDER_DATE}`",
        f"{_dmy('l_shipdate')} AS `{S.SHIP_DATE}`",
        f"l_quantity AS `{S.QUANTITY}`",
        f"l_extendedprice AS `{S.PRICE}`",
        f"l_discount AS `{S.DISCOUNT}`",
        f"CASE WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN CAST(NULL AS DOUBLE) "
        f"ELSE {profit} END AS `{S.PROFIT}`",
        f"l_linestatus AS `{S.SHIP_MODE}`",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return raw_customers(spark, sf_dir), raw_products(spark, sf_dir), raw_orders(spark, sf_dir)
