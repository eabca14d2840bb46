"""Independent DuckDB SQL for every named query (the correctness oracle).

The SQL re-derives the raw tables from the pre-registered test views and
re-states every rule in plain SQL.  Spark-vs-DuckDB differences handled:
DuckDB sorts nulls last by default (every dedup order says NULLS FIRST);
DuckDB rounds a double by its binary value while Spark rounds half up on
its decimal text, so single values are rounded through a decimal.
"""

from __future__ import annotations

_RAW = r"""
cust_base AS (
  SELECT c.c_custkey AS k, c.c_name, lower(c.c_mktsegment) AS seg, n.n_name, r.r_name
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
cust_rows AS (
  SELECT *, 0 AS dup FROM cust_base
  UNION ALL SELECT *, 1 AS dup FROM cust_base WHERE k % 23 = 0),
raw_customers AS (
  SELECT
    CASE WHEN k % 97 = 0 THEN NULL ELSE 'C' || CAST(k AS VARCHAR) END AS "Customer ID",
    CASE WHEN dup = 1 THEN 'Duplicate' WHEN k % 11 = 0 THEN NULL WHEN k % 11 = 1 THEN '   '
         WHEN k % 11 = 2 THEN c_name ELSE '  Client ' || seg END AS "Customer Name",
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 13 = 1 THEN 'invalidemail'
         ELSE seg || CAST(k AS VARCHAR) || '@example.com' END AS email,
    CASE k % 17 WHEN 0 THEN 'nan' WHEN 1 THEN '#ERROR!' WHEN 2 THEN '(555)-123-4567'
         WHEN 3 THEN '555.123.4567' WHEN 4 THEN '555-123-4567'
         ELSE lpad(CAST(k AS VARCHAR), 10, '5') END AS phone,
    CASE k % 19 WHEN 0 THEN '1841' WHEN 1 THEN '12345.0' WHEN 2 THEN '12345-6789'
         WHEN 3 THEN NULL ELSE lpad(CAST(k AS VARCHAR), 5, '1') END AS "Postal Code",
    CASE r_name WHEN 'AFRICA' THEN 'North' WHEN 'AMERICA' THEN 'south' WHEN 'ASIA' THEN ' East '
         WHEN 'EUROPE' THEN 'CENTRAL' ELSE r_name END AS "Region",
    n_name AS "Country"
  FROM cust_rows),
part_rows AS (
  SELECT p_partkey AS k, p_name, p_type, p_brand, p_retailprice, 0 AS dup FROM part
  UNION ALL
  SELECT p_partkey, p_name, p_type, p_brand, p_retailprice, 1 FROM part WHERE p_partkey % 37 = 0),
raw_products AS (
  SELECT
    CASE WHEN k % 101 = 0 THEN NULL ELSE 'P' || CAST(k AS VARCHAR) END AS "Product ID",
    p_name AS "Product Name",
    CASE WHEN k % 31 = 0 THEN NULL WHEN k % 29 = 0 THEN -p_retailprice
         ELSE p_retailprice + dup END AS "Price per product",
    p_type AS "Category",
    p_brand AS "Sub-Category"
  FROM part_rows),
raw_orders AS (
  SELECT
    CASE WHEN l.l_orderkey % 211 = 0 THEN NULL ELSE 'O' || CAST(l.l_orderkey AS VARCHAR) END AS "Order ID",
    CASE WHEN l.l_orderkey % 53 = 0 THEN 'X' ELSE 'C' END || CAST(o.o_custkey AS VARCHAR) AS "Customer ID",
    CASE WHEN l.l_partkey % 41 = 0 THEN 'X' ELSE 'P' END || CAST(l.l_partkey AS VARCHAR) AS "Product ID",
    CAST(day(o.o_orderdate) AS VARCHAR) || '/' || CAST(month(o.o_orderdate) AS VARCHAR) || '/'
      || CAST(year(o.o_orderdate) AS VARCHAR) AS "Order Date",
    CAST(day(l.l_shipdate) AS VARCHAR) || '/' || CAST(month(l.l_shipdate) AS VARCHAR) || '/'
      || CAST(year(l.l_shipdate) AS VARCHAR) AS "Ship Date",
    l.l_quantity AS "Quantity",
    l.l_extendedprice AS "Price",
    l.l_discount AS "Discount",
    CASE WHEN l.l_linenumber = 7 AND l.l_orderkey % 5 = 0 THEN NULL
         ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
                   * (CAST(l.l_discount AS DECIMAL(4,2)) - CAST(0.05 AS DECIMAL(4,2))) AS DOUBLE)
    END AS "Profit",
    l.l_linestatus AS "Ship Mode"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_CLEAN = r"""
cust_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "Customer ID" ORDER BY
      "Customer Name" ASC NULLS FIRST, email ASC NULLS FIRST, phone ASC NULLS FIRST,
      "Postal Code" ASC NULLS FIRST, "Region" ASC NULLS FIRST, "Country" ASC NULLS FIRST) AS rn
    FROM raw_customers WHERE "Customer ID" IS NOT NULL) t WHERE rn = 1),
cust_trim AS (
  SELECT "Customer ID", trim("Customer Name") AS "Customer Name", trim(email) AS email,
         trim(phone) AS phone, trim("Postal Code") AS "Postal Code", trim("Region") AS "Region",
         "Country"
  FROM cust_dedup),
cust_annot AS (
  SELECT *, concat_ws('|',
    CASE WHEN "Customer Name" IS NULL OR "Customer Name" = '' THEN 'missing_name' END,
    CASE WHEN NOT regexp_matches("Customer Name", '^[\p{L} ]+$') THEN 'invalid_name' END,
    CASE WHEN NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')
         THEN 'invalid_email' END,
    CASE WHEN NOT regexp_matches(phone,
         '^(\d{10}|\(\d{3}\)-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|\d{3}-\d{3}-\d{4})$')
         THEN 'invalid_phone' END,
    CASE WHEN NOT regexp_matches("Postal Code", '^\d{5}(-\d{4})?$') THEN 'invalid_postal' END,
    CASE WHEN upper("Region") NOT IN ('NORTH', 'SOUTH', 'EAST', 'WEST', 'CENTRAL')
         THEN 'invalid_region' END) AS "Issues"
  FROM cust_trim),
customers_clean AS (
  SELECT "Customer ID",
    CASE WHEN "Customer Name" IS NULL OR trim("Customer Name") = ''
         THEN concat_ws('', 'IMPUTED_', regexp_extract(email, '^([^@]+)', 1))
         ELSE "Customer Name" END AS "Customer Name",
    email, phone, "Postal Code", "Region", "Country", "Issues"
  FROM cust_annot),
customer_issues AS (
  SELECT "Customer ID" AS CustomerID, "Customer Name" AS CustomerName, email AS Email,
         phone AS Phone, "Postal Code" AS PostalCode, "Region" AS Region, "Issues"
  FROM cust_annot WHERE "Issues" <> ''),
prod_annot AS (
  SELECT "Product ID", "Product Name", CAST("Price per product" AS DOUBLE) AS UnitPrice,
         "Category", "Sub-Category"
  FROM (
    SELECT *, row_number() OVER (PARTITION BY "Product ID" ORDER BY
      "Product Name" ASC NULLS FIRST, "Price per product" ASC NULLS FIRST,
      "Category" ASC NULLS FIRST, "Sub-Category" ASC NULLS FIRST) AS rn
    FROM raw_products WHERE "Product ID" IS NOT NULL) t WHERE rn = 1),
products_clean AS (SELECT * FROM prod_annot WHERE UnitPrice >= 0),
product_issues AS (
  SELECT *, 'negative_unit_price' AS "Issues" FROM prod_annot WHERE UnitPrice < 0),
customer_dim AS (
  SELECT "Customer ID" AS CustomerID, "Customer Name" AS CustomerName, "Country" AS Country
  FROM customers_clean),
product_dim AS (
  SELECT "Product ID" AS ProductID, "Category" AS Category, "Sub-Category" AS SubCategory
  FROM products_clean),
orders_keyed AS (
  SELECT * FROM raw_orders
  WHERE "Order ID" IS NOT NULL AND "Customer ID" IS NOT NULL AND "Product ID" IS NOT NULL
    AND "Profit" IS NOT NULL AND NOT isnan("Profit") AND "Order Date" IS NOT NULL),
orders_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "Order ID" ORDER BY
      "Customer ID" ASC NULLS FIRST, "Product ID" ASC NULLS FIRST, "Order Date" ASC NULLS FIRST,
      "Ship Date" ASC NULLS FIRST, "Quantity" ASC NULLS FIRST, "Price" ASC NULLS FIRST,
      "Discount" ASC NULLS FIRST, "Profit" ASC NULLS FIRST, "Ship Mode" ASC NULLS FIRST) AS rn
    FROM orders_keyed) t WHERE rn = 1)"""


def _orders_ctes(source: str, suffix: str) -> str:
    """Dated and checked orders from ``source`` as ``orders_annot{suffix}``,
    with their clean and issue subsets and the enriched fact."""
    return rf"""
orders_dated{suffix} AS (
  SELECT *,
    CAST(try_strptime("Order Date", '%-d/%-m/%Y') AS DATE) AS OrderDate,
    CAST(try_strptime("Ship Date", '%-d/%-m/%Y') AS DATE) AS ShipDate
  FROM {source}),
orders_annot{suffix} AS (
  SELECT o.*, concat_ws('|',
    CASE WHEN c.k IS NULL THEN 'invalid_customer_id' END,
    CASE WHEN p.k IS NULL THEN 'invalid_product_id' END) AS "Issues"
  FROM orders_dated{suffix} o
  LEFT JOIN (SELECT DISTINCT "Customer ID" AS k FROM customers_clean) c ON o."Customer ID" = c.k
  LEFT JOIN (SELECT DISTINCT "Product ID" AS k FROM products_clean) p ON o."Product ID" = p.k),
orders_clean{suffix} AS (SELECT * FROM orders_annot{suffix} WHERE "Issues" = ''),
order_issues{suffix} AS (
  SELECT "Order ID" AS OrderID, "Customer ID" AS CustomerID, "Product ID" AS ProductID,
         OrderDate, ShipDate, "Issues"
  FROM orders_annot{suffix} WHERE "Issues" <> ''),
orders_enriched{suffix} AS (
  SELECT o."Order ID", o.OrderDate, o.ShipDate, o."Ship Mode",
    o."Customer ID" AS CustomerID, cd.CustomerName, cd.Country,
    o."Product ID" AS ProductID, pd.Category, pd.SubCategory,
    o."Quantity", o."Price", o."Discount",
    CAST(round(CAST(o."Profit" AS DECIMAL(18,6)), 2) AS DOUBLE) AS ProfitRounded,
    CAST(year(o.OrderDate) AS INTEGER) AS Year
  FROM orders_clean{suffix} o
  LEFT JOIN customer_dim cd ON o."Customer ID" = cd.CustomerID
  LEFT JOIN product_dim pd ON o."Product ID" = pd.ProductID),
mart{suffix} AS (
  SELECT Year, Category, SubCategory, CustomerName,
         round(sum(ProfitRounded), 2) AS TotalProfit
  FROM orders_enriched{suffix} GROUP BY Year, Category, SubCategory, CustomerName)"""


_WITH = ("WITH" + _RAW + "," + _CLEAN + "," + _orders_ctes("orders_dedup", "") + ","
         + _orders_ctes("orders_keyed", "_lines") + "\n")

_UNMATCHED = """
SELECT o."Order ID",
  CAST(try_strptime(o."Order Date", '%-d/%-m/%Y') AS DATE) AS OrderDate, o."Ship Mode",
  o."Customer ID" AS CustomerID, cd.CustomerName, cd.Country,
  o."Product ID" AS ProductID, pd.Category, pd.SubCategory,
  o."Quantity", o."Price", o."Discount",
  CAST(round(CAST(o."Profit" AS DECIMAL(18,6)), 2) AS DOUBLE) AS ProfitRounded,
  CAST(year(CAST(try_strptime(o."Order Date", '%-d/%-m/%Y') AS DATE)) AS INTEGER) AS Year
FROM raw_orders o
LEFT JOIN customer_dim cd ON o."Customer ID" = cd.CustomerID
LEFT JOIN product_dim pd ON o."Product ID" = pd.ProductID"""

_BY_YEAR = "SELECT Year, round(sum(TotalProfit), 2) AS ProfitByYear FROM mart GROUP BY Year"
_BY_YEAR_CAT = ("SELECT Year, Category, round(sum(TotalProfit), 2) AS ProfitByYearCategory "
                "FROM mart GROUP BY Year, Category")
_BY_CUST = ("SELECT CustomerName, round(sum(TotalProfit), 2) AS ProfitByCustomer "
            "FROM mart GROUP BY CustomerName")
_BY_CUST_YEAR = ("SELECT CustomerName, Year, round(sum(TotalProfit), 2) AS ProfitByCustomerYear "
                 "FROM mart GROUP BY CustomerName, Year")

_ISSUE_COUNTS = """
SELECT table_name, issue, count(*) AS row_count FROM (
  SELECT 'customer_data_issues' AS table_name, unnest(string_split("Issues", '|')) AS issue
  FROM customer_issues
  UNION ALL
  SELECT 'product_data_issues', unnest(string_split("Issues", '|')) FROM product_issues
  UNION ALL
  SELECT 'order_data_issues', unnest(string_split("Issues", '|')) FROM order_issues) t
GROUP BY table_name, issue"""

_TABLE_COUNTS = """
SELECT 'customer_data_issues' AS table_name, count(*) AS row_count FROM customer_issues
UNION ALL SELECT 'product_data_issues', count(*) FROM product_issues
UNION ALL SELECT 'order_data_issues', count(*) FROM order_issues
UNION ALL SELECT 'customers', count(*) FROM customer_dim
UNION ALL SELECT 'products', count(*) FROM product_dim
UNION ALL SELECT 'orders_enriched', count(*) FROM orders_enriched
UNION ALL SELECT 'aggregates', count(*) FROM mart"""

_BODIES = {
    "customers_clean": "SELECT * FROM customers_clean",
    "customer_issues": "SELECT * FROM customer_issues",
    "products_clean": "SELECT * FROM products_clean",
    "product_issues": "SELECT * FROM product_issues",
    "orders_clean": "SELECT * FROM orders_clean",
    "orders_clean_lines": "SELECT * FROM orders_clean_lines",
    "order_issues": "SELECT * FROM order_issues",
    "order_issues_lines": "SELECT * FROM order_issues_lines",
    "issue_counts": _ISSUE_COUNTS,
    "customer_dim": "SELECT * FROM customer_dim",
    "product_dim": "SELECT * FROM product_dim",
    "orders_enriched": "SELECT * FROM orders_enriched",
    "orders_enriched_lines": "SELECT * FROM orders_enriched_lines",
    "orders_enriched_unmatched": _UNMATCHED,
    "orders_enriched_fused": "SELECT * FROM orders_enriched",
    "order_issues_fused": "SELECT * FROM order_issues",
    "order_issues_bucketed": "SELECT * FROM order_issues",
    "order_issues_lines_bucketed": "SELECT * FROM order_issues_lines",
    "orders_enriched_bucketed": "SELECT * FROM orders_enriched",
    "profit_aggregates": "SELECT * FROM mart",
    "profit_aggregates_lines": "SELECT * FROM mart_lines",
    "profit_aggregates_fused": "SELECT * FROM mart",
    "profit_aggregates_salted": "SELECT * FROM mart",
    "profit_by_year": _BY_YEAR + " ORDER BY Year",
    "profit_by_year_category": _BY_YEAR_CAT + " ORDER BY Year, Category",
    "profit_by_customer": _BY_CUST + " ORDER BY ProfitByCustomer DESC, CustomerName ASC NULLS FIRST",
    "profit_by_customer_year": _BY_CUST_YEAR + " ORDER BY Year ASC NULLS FIRST, CustomerName DESC NULLS LAST",
    "first5_year": _BY_YEAR + " ORDER BY Year ASC NULLS FIRST LIMIT 5",
    "first5_year_category": _BY_YEAR_CAT + " ORDER BY Year ASC NULLS FIRST, Category ASC NULLS FIRST LIMIT 5",
    "top5_customers": _BY_CUST + " ORDER BY ProfitByCustomer DESC NULLS LAST, CustomerName ASC NULLS FIRST LIMIT 5",
    "first5_customer_year": _BY_CUST_YEAR + " ORDER BY Year ASC NULLS FIRST, CustomerName DESC NULLS LAST LIMIT 5",
    "profit_by_year_sql": _BY_YEAR,
    "profit_by_year_category_sql": _BY_YEAR_CAT,
    "profit_by_customer_sql": _BY_CUST,
    "profit_by_customer_year_sql": _BY_CUST_YEAR,
    "table_counts": _TABLE_COUNTS,
    "cleaning_counts": """
SELECT 'customers_raw' AS table_name, count(*) AS row_count FROM raw_customers
UNION ALL SELECT 'customers_keyed', count(*) FROM cust_dedup
UNION ALL SELECT 'products_raw', count(*) FROM raw_products
UNION ALL SELECT 'products_keyed', count(*) FROM prod_annot
UNION ALL SELECT 'orders_raw', count(*) FROM raw_orders
UNION ALL SELECT 'orders_keyed', count(*) FROM orders_dedup
UNION ALL SELECT 'order_lines_keyed', count(*) FROM orders_keyed""",
    "preview_orders_enriched": """
SELECT * FROM orders_enriched
ORDER BY "Order ID" NULLS FIRST, OrderDate NULLS FIRST, ShipDate NULLS FIRST,
  "Ship Mode" NULLS FIRST, CustomerID NULLS FIRST, CustomerName NULLS FIRST, Country NULLS FIRST,
  ProductID NULLS FIRST, Category NULLS FIRST, SubCategory NULLS FIRST, "Quantity" NULLS FIRST,
  "Price" NULLS FIRST, "Discount" NULLS FIRST, ProfitRounded NULLS FIRST, Year NULLS FIRST
LIMIT 5""",
    "preview_customer_issues": """
SELECT * FROM customer_issues
ORDER BY CustomerID NULLS FIRST, CustomerName NULLS FIRST, Email NULLS FIRST, Phone NULLS FIRST,
  PostalCode NULLS FIRST, Region NULLS FIRST, "Issues" NULLS FIRST
LIMIT 5""",
    "csv_roundtrip": "SELECT * FROM raw_products",
    "csv_products_quoted": """
SELECT * REPLACE (CASE length("Product Name") % 5
    WHEN 0 THEN "Product Name" || ', "big"' || chr(10) || 'second line' WHEN 1 THEN NULL
    WHEN 2 THEN '"' || "Product Name" ELSE "Product Name" END AS "Product Name")
FROM raw_products""",
    "json_array_orders": "SELECT * FROM raw_orders",
    "json_array_orders_split": "SELECT * FROM raw_orders",
    "json_roundtrip": "SELECT * FROM raw_orders",
    "xlsx_ingest": "SELECT * FROM raw_customers",
    "xlsx_alias_customers": """
SELECT * REPLACE (CASE WHEN length(email) % 4 = 0 THEN NULL ELSE "Customer Name" END AS "Customer Name",
                  CASE WHEN length(email) % 3 = 0 THEN 'nan' ELSE phone END AS phone)
FROM raw_customers""",
    "xlsx_customer_issues": "SELECT * FROM customer_issues",
    "csv_product_issues": "SELECT * FROM product_issues",
    "json_order_issues": "SELECT * FROM order_issues",
    "parquet_publish": _TABLE_COUNTS,
    "published_rows": _TABLE_COUNTS,
    "run_etl_aggregates": "SELECT * FROM mart",
}

ORACLE_SQL: dict[str, str] = {name: _WITH + body for name, body in _BODIES.items()}
