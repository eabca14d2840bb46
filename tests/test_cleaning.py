"""Cleaning steps on the hand-written fixtures (exact outcomes)."""

import pytest
from tables import ORDER_COLUMNS
from pyspark.sql import functions as F

from salesmart import clean_customers, clean_orders, clean_products


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


def test_customers_are_kept_once_and_imputed(customers_raw):
    rows = by_id(clean_customers(customers_raw)[0], "Customer ID")
    assert {k: r["Customer Name"] for k, r in rows.items()} == {
        "K70": "Zoë Lindqvist", "K71": "Ngozi Eze", "K72": "IMPUTED_pat+lists",
        "K73": "\t", "K74": "O'Hara-Lind", "K75": "Mia Bell"}
    assert rows["K75"]["Region"] is None  # the smallest row of the repeated id, nulls first


def test_customer_faults_are_listed_in_rule_order(customers_raw):
    issues = clean_customers(customers_raw)[1]
    assert issues.columns == ["CustomerID", "CustomerName", "Email", "Phone", "PostalCode", "Region", "Issues"]
    got = by_id(issues, "CustomerID")
    assert {k: list(r["Issues"]) for k, r in got.items()} == {
        "K72": ["missing_name", "invalid_postal"],
        "K73": ["invalid_name", "invalid_email", "invalid_phone", "invalid_postal", "invalid_region"],
        "K74": ["invalid_name", "invalid_email", "invalid_phone", "invalid_postal", "invalid_region"]}
    assert got["K72"]["CustomerName"] is None  # as read, before imputation


def test_products_split_by_price(products_raw):
    clean, issues = clean_products(products_raw)
    assert {r["Product ID"]: (r["Product Name"], r["UnitPrice"]) for r in clean.collect()} == {
        "T-1": ("kettle", 24.9), "T-5": ("shelf", 0.0)}
    # a missing or unreadable price is in neither table
    assert [(r["Product ID"], list(r["Issues"])) for r in issues.collect()] == [("T-2", ["negative_unit_price"])]


@pytest.fixture
def cleaned(customers_raw, products_raw):
    return clean_customers(customers_raw)[0], clean_products(products_raw)[0]


def test_orders_need_known_parents(orders_raw, cleaned):
    clean, issues = clean_orders(orders_raw, *cleaned)
    assert issues.columns == ["OrderID", "CustomerID", "ProductID", "OrderDate", "ShipDate", "Issues"]
    assert {r["OrderID"]: list(r["Issues"]) for r in issues.collect()} == {
        "2044": ["invalid_customer_id"], "2045": ["invalid_product_id"],
        "2046": ["invalid_customer_id", "invalid_product_id"]}
    rows = by_id(clean, "Order ID")
    assert {k: (r["Product ID"], str(r["OrderDate"]), str(r["ShipDate"])) for k, r in rows.items()} == {
        "2041": ("T-1", "2021-11-09", "2021-11-12"),
        "2042": ("T-5", "None", "None"),  # 31 February, and no ship date
        "2043": ("T-1", "2022-01-01", "None")}


def test_every_line_is_kept_without_an_order_key(orders_raw, cleaned):
    clean, issues = clean_orders(orders_raw, *cleaned, order_key=None)
    assert clean.where(F.col("Order ID") == "2041").count() == 2
    assert clean.count() == 4 and issues.count() == 3


@pytest.mark.parametrize("lost", ["Order ID", "Customer ID", "Product ID", "Profit", "Order Date"])
def test_orders_without_a_required_value_go(spark, cleaned, lost):
    whole = {"Order ID": "1", "Customer ID": "K70", "Product ID": "T-1", "Profit": 1.5,
             "Order Date": "2/2/2020", "Ship Date": None}
    rows = [tuple(whole.values()), tuple((whole | {"Order ID": "2", lost: None}).values())]
    clean, issues = clean_orders(spark.createDataFrame(rows, ORDER_COLUMNS), *cleaned)
    assert [r["Order ID"] for r in clean.collect()] == ["1"] and issues.count() == 0


def test_orders_stay_in_place_for_the_parent_check(spark, customers_raw, products_raw, orders_raw):
    """Only the ids without a parent travel; more of them than the limit are found by joins, with the same rows."""
    cleaned = clean_customers(customers_raw)[0], clean_products(products_raw)[0]
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "-1")
        want = [sorted(map(str, df.collect())) for df in clean_orders(orders_raw, *cleaned, order_key=None, missing_ids=0)]
        for most, joins in ((1, 2), (2, 0), (1000, 0)):  # two ids of each kind have no parent
            got = clean_orders(orders_raw, *cleaned, order_key=None, missing_ids=most)
            assert [sorted(map(str, df.collect())) for df in got] == want
            plan = got[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert plan.count("SortMergeJoin") == joins and ("Exchange hashpartitioning" in plan) == bool(joins)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
