"""Checks of orders that lie bucketed on their keys: same results, and no order is shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from salesmart.operators.dims import build_customer_dim, build_product_dim
from salesmart.operators.quality import clean_customers, clean_products
from salesmart.operators.refs import annotate_orders, order_issue_report
from salesmart.operators.facts import enriched_from_annotated
from salesmart.operators.skew import SALT
from salesmart.plans.bucketed import BucketedOrders, store_orders
from salesmart.session import shared_dir


@pytest.fixture
def dims(customers_raw, products_raw):
    return build_customer_dim(clean_customers(customers_raw)[0]), build_product_dim(clean_products(products_raw)[0])


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def stored(spark, orders, dims, **options):
    store = store_orders(spark, orders, shared_dir(spark, "bucketed"), **options)
    return store, store.store_dimension("customers", dims[0]), store.store_dimension("products", dims[1])


def many(orders, copies):
    """The orders ``copies`` times, each copy under ids of its own."""
    numbered = orders.crossJoin(orders.sparkSession.range(copies)).withColumn(
        "Order ID", F.concat_ws("-", "Order ID", "id"))
    return numbered.select(orders.columns)


@pytest.mark.parametrize("order_key", [("Order ID",), None])
@pytest.mark.parametrize("hot_share", [0.2, 1.0])
def test_same_report_and_fact(spark, no_broadcast, orders_raw, dims, order_key, hot_share):
    orders = orders_raw.unionByName(orders_raw)  # without a key, equal lines stay apart
    store, customers, products = stored(spark, orders, dims, order_key=order_key, buckets=4, hot_share=hot_share)
    annotated = annotate_orders(orders, *dims, order_key)
    report, fact = order_issue_report(annotated), enriched_from_annotated(annotated)
    assert store.issues(customers, products).columns == report.columns
    assert rows(store.issues(customers, products)) == rows(report) != []
    assert store.enriched(customers, products).columns == fact.columns
    assert rows(store.enriched(customers, products)) == rows(fact) != []
    store.close()


def test_both_findings_of_a_line_in_rule_order(spark, orders_raw, dims):
    store, customers, products = stored(spark, orders_raw, dims, buckets=3)
    found = {r["OrderID"]: r["Issues"] for r in store.issues(customers, products).collect()}
    assert found["2046"] == ["invalid_customer_id", "invalid_product_id"]
    store.close()


def test_orders_are_not_shuffled(spark, no_broadcast, orders_raw, dims):
    store, customers, products = stored(spark, many(orders_raw, 20), dims, buckets=4, hot_share=1.0)
    joins = store._looked_up("customers", customers), store._looked_up("products", products)
    for df in joins:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    # Of the report only the lines found are shuffled, once.
    plan = store.issues(customers, products)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert plan.index("Exchange") < plan.index("SortMergeJoin")  # above the joins
    # The fact shuffles the orders to the products only.
    plan = store.enriched(customers, products)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning(Customer ID" not in plan
    store.close()


def test_a_hot_customer_is_spread_over_the_buckets(spark, no_broadcast, orders_raw, dims):
    orders = many(orders_raw, 60)  # K70 and T-1 hold more than a third
    store, customers, products = stored(spark, orders, dims, buckets=8, hot_share=0.2)
    by_customer = store.orders("customers")
    hot = by_customer.where(F.col("Customer ID") == "K70")
    files = hot.groupBy(F.input_file_name()).count()
    assert files.count() > 3 and files.agg(F.max("count")).first()[0] < hot.count() * 0.6
    assert by_customer.where(F.col("Customer ID") == "K72").select(SALT).distinct().count() == 1
    assert customers.where(F.col("CustomerID") == "K70").count() == 8
    report = order_issue_report(annotate_orders(orders, *dims))
    assert rows(store.issues(customers, products)) == rows(report)
    store.close()


def test_a_new_dimension_is_checked_against_the_stored_orders(spark, orders_raw, dims):
    store, customers, products = stored(spark, orders_raw, dims, buckets=4)
    before = rows(store.issues(customers, products))
    later = BucketedOrders(spark, store.folder)  # as another session opens it
    fewer = dims[0].where(F.col("CustomerID") != "K70")
    report = order_issue_report(annotate_orders(orders_raw, fewer, dims[1]))
    assert rows(later.issues(later.store_dimension("customers", fewer),
                             later.store_dimension("products", dims[1]))) == rows(report) != before
    assert rows(store.issues(customers, products)) == before
    store.close(), later.close()


def test_empty_orders_and_dimensions(spark, orders_raw, dims):
    store, customers, products = stored(spark, orders_raw.limit(0), dims, buckets=2)
    assert store.issues(customers, products).count() == store.enriched(customers, products).count() == 0
    store.close()
    none = [d.limit(0) for d in dims]
    store, customers, products = stored(spark, orders_raw, none, buckets=2)
    assert rows(store.issues(customers, products)) == rows(order_issue_report(annotate_orders(orders_raw, *none)))
    store.close()


def test_an_unfinished_folder_is_no_store(spark, orders_raw):
    folder = shared_dir(spark, "bucketed")
    store_orders(spark, orders_raw, folder, buckets=2)
    with pytest.raises(Exception):
        store_orders(spark, orders_raw, folder, buckets=2)  # a folder is filled once
    with pytest.raises(Exception):
        BucketedOrders(spark, f"{folder}/orders-customers")
