"""Dimensions, enriched fact, profit mart and the four roll-ups."""

import math
from decimal import Decimal

import pytest
from tables import CUSTOMER_COLUMNS, ORDER_COLUMNS
from pyspark.sql import functions as F

from salesmart import (
    aggregate_profit_by,
    build_customer_dim,
    build_orders_enriched,
    build_product_dim,
    clean_customers,
    clean_orders,
    clean_products,
)
from salesmart.operators.marts import (
    ROLLUP_SQL,
    first_rows,
    profit_by_customer,
    profit_by_customer_year,
    profit_by_year,
    profit_by_year_category,
    register_aggregates,
    rollup_sql,
)


def enriched_of(orders, customers, products):
    cust, _ = clean_customers(customers)
    prod, _ = clean_products(products)
    clean, _ = clean_orders(orders, cust, prod)
    return build_orders_enriched(clean, build_customer_dim(cust), build_product_dim(prod))


def test_dimension_columns(customers_raw, products_raw):
    cust, _ = clean_customers(customers_raw)
    prod, _ = clean_products(products_raw)
    assert build_customer_dim(cust).columns == ["CustomerID", "CustomerName", "Country"]
    assert build_product_dim(prod).columns == ["ProductID", "Category", "SubCategory"]


def test_customer_dim_aliases(spark):
    df = spark.createDataFrame([("1", "x", "a", "DE")], "customer_id string, name string, "
                                                         "customer_name string, country_name string")
    dim = build_customer_dim(df)
    assert dim.first().asDict() == {"CustomerID": "1", "CustomerName": "a", "Country": "DE"}
    with pytest.raises(ValueError, match="country"):
        build_customer_dim(df.drop("country_name"))


def test_enriched_columns(orders_raw, customers_raw, products_raw):
    df = enriched_of(orders_raw, customers_raw, products_raw)
    assert df.columns == ["Order ID", "OrderDate", "ShipDate", "CustomerID", "CustomerName",
                          "Country", "ProductID", "Category", "SubCategory", "ProfitRounded",
                          "Year"]


def test_enriched_values(orders_raw, customers_raw, products_raw):
    rows = {r["Order ID"]: r for r in enriched_of(orders_raw, customers_raw, products_raw).collect()}
    assert {k: (r.CustomerName, r.Country, r.Category, r.SubCategory, r.ProfitRounded, r.Year)
            for k, r in rows.items()} == {
        "2041": ("Zoë Lindqvist", "Norway", "Kitchen", "Boilers", 7.01, 2021),
        "2042": ("Ngozi Eze", "Ghana", "Wood", "Storage", -40.44, None),
        "2043": ("Mia Bell", "Chile", "Kitchen", "Boilers", 0.33, 2022)}


def test_enriched_keeps_unmatched_orders(orders_raw, customers_raw, products_raw):
    dims = build_customer_dim(clean_customers(customers_raw)[0]), build_product_dim(clean_products(products_raw)[0])
    df = build_orders_enriched(orders_raw.where("`Order ID` = '2046'"), *dims)
    row = df.first()
    assert (row.CustomerName, row.Category, row.ProfitRounded, row.Year) == (None, None, 2.0, 2022)
    assert "ShipDate" not in df.columns  # the raw orders carry no parsed ship date


def test_optional_order_columns_kept(spark, customers_raw, products_raw):
    orders = spark.createDataFrame(
        [("77", "K70", "T-1", 4.0, "8/8/2019", "9/8/2019", "Rail", 3.0, 12.0, 0.2)],
        ORDER_COLUMNS + ", `Ship Mode` string, Quantity double, Price double, Discount double")
    df = enriched_of(orders, customers_raw, products_raw)
    assert df.columns == ["Order ID", "OrderDate", "ShipDate", "Ship Mode", "CustomerID",
                          "CustomerName", "Country", "ProductID", "Category", "SubCategory",
                          "Quantity", "Price", "Discount", "ProfitRounded", "Year"]


def test_mart_sums_rounded_profits(orders_raw, customers_raw, products_raw):
    more = orders_raw.where("`Order ID` = '2043'").withColumn("Order ID", F.lit("2143"))
    agg = aggregate_profit_by(enriched_of(orders_raw.union(more), customers_raw, products_raw))
    got = {(r.Year, r.Category, r.SubCategory, r.CustomerName): r.TotalProfit for r in agg.collect()}
    assert got == {(2021, "Kitchen", "Boilers", "Zoë Lindqvist"): 7.01,
                   (None, "Wood", "Storage", "Ngozi Eze"): -40.44,
                   (2022, "Kitchen", "Boilers", "Mia Bell"): 0.66}


def test_customers_sharing_a_name_merge(spark, products_raw):
    customers = spark.createDataFrame(
        [(k, "Ada Moss", f"{k}@x.example", "5550001111", "10101", "East", "Malta") for k in ("a", "b")],
        CUSTOMER_COLUMNS)
    orders = spark.createDataFrame(
        [("1", "a", "T-1", 10.0, "4/4/2018", None), ("2", "b", "T-1", -2.5, "5/5/2018", None)], ORDER_COLUMNS)
    agg = aggregate_profit_by(enriched_of(orders, customers, products_raw))
    assert [(r.CustomerName, r.TotalProfit) for r in agg.collect()] == [("Ada Moss", 7.5)]


@pytest.fixture
def mart(spark):
    """A null year and name, a tie in profit, and cents that need rounding."""
    return spark.createDataFrame([
        (2019, "Moss", "Wood", 0.1), (2019, "Moss", "Wood", 0.2), (2019, "Eze", "Textiles", -4.005),
        (None, "Eze", "Wood", 9.0), (2021, None, "Wood", 4.99), (2021, "Roe", "Decor", 0.3)],
        "Year int, CustomerName string, Category string, TotalProfit double")


EXPECTED = {
    "profit_by_year": [(None, 9.0), (2019, -3.71), (2021, 5.29)],
    "profit_by_year_category": [(None, "Wood", 9.0), (2019, "Textiles", -4.01), (2019, "Wood", 0.3),
                                (2021, "Decor", 0.3), (2021, "Wood", 4.99)],
    "profit_by_customer": [("Eze", 5.0), (None, 4.99), ("Moss", 0.3), ("Roe", 0.3)],
    "profit_by_customer_year": [("Eze", None, 9.0), ("Moss", 2019, 0.3), ("Eze", 2019, -4.01),
                                ("Roe", 2021, 0.3), (None, 2021, 4.99)],
}

FUNCS = {
    "profit_by_year": profit_by_year,
    "profit_by_year_category": profit_by_year_category,
    "profit_by_customer": profit_by_customer,
    "profit_by_customer_year": profit_by_customer_year,
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_rollup_dataframe(mart, name):
    assert [tuple(r) for r in FUNCS[name](mart).collect()] == EXPECTED[name]


@pytest.mark.parametrize("name", sorted(ROLLUP_SQL))
def test_rollup_sql(spark, mart, name):
    register_aggregates(mart)
    assert [tuple(r) for r in rollup_sql(spark, name).collect()] == EXPECTED[name]


def test_top_k(mart):
    top = first_rows(profit_by_customer(mart), 2)
    assert [r.CustomerName for r in top.collect()] == ["Eze", None]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_totals_do_not_depend_on_the_order_of_rows(spark, parts):
    """Cents whose double sums differ in the last digits by order; the totals are the same bits."""
    cents = [((i * 7919) % 100_003 - 50_000) / 100 for i in range(3000)] + [1e15 + 0.25, -1e15]
    rows = [(2020 + i % 2, "Wood", "Desk", "Moss", c) for i, c in enumerate(cents)]
    fact = spark.createDataFrame(rows, "Year int, Category string, SubCategory string, CustomerName string, "
                                       "ProfitRounded double").repartition(parts, F.rand(parts))
    want = {y: float(sum(Decimal(repr(c)) for i, c in enumerate(cents) if 2020 + i % 2 == y)) for y in (2020, 2021)}
    agg = aggregate_profit_by(fact)
    assert {r.Year: r.TotalProfit for r in agg.collect()} == want
    assert {r.Year: r.ProfitByYear for r in profit_by_year(agg).collect()} == want


def test_totals_of_values_without_a_decimal(spark):
    mart = spark.createDataFrame(
        [(2020, "a", "w", float("inf")), (2020, "b", "w", 1.0), (2021, "a", "w", 1e30), (2021, "b", "w", 1e30),
         (2022, "a", "w", None), (2023, "a", "w", float("nan"))],
        "Year int, CustomerName string, Category string, TotalProfit double")
    got = {r.Year: r.ProfitByYear for r in profit_by_year(mart).collect()}
    assert got[2020] == float("inf") and got[2021] == 2e30 and got[2022] is None and math.isnan(got[2023])
