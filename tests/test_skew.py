"""Hot keys: a third of all orders on one customer."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators.dims import build_customer_dim
from salesmart.operators.quality import clean_customers
from salesmart.operators.refs import _lookup
from salesmart.operators.skew import hot_keys, left_lookup


@pytest.fixture
def skewed(spark):
    orders = spark.range(30000).select(
        F.concat(F.lit("O"), F.col("id").cast("string")).alias("Order ID"),
        F.when(F.col("id") % 3 == 0, F.lit("C1"))
         .otherwise(F.concat(F.lit("C"), (F.col("id") % 500).cast("string"))).alias("Customer ID"))
    customers = spark.range(400).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("Customer ID"),
        F.lit("Ann").alias("Customer Name"), F.lit("a@b.co").alias("email"),
        F.lit("1234567890").alias("phone"), F.lit("12345").alias("Postal Code"),
        F.lit("North").alias("Region"), F.lit("X").alias("Country"))
    return orders, build_customer_dim(clean_customers(customers)[0])


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_sides(spark):
    """Treat every lookup side as too large to broadcast; tiny skew limits."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_keys_are_bounded(skewed):
    orders, _ = skewed
    assert [r[0] for r in hot_keys(orders, "Customer ID", 0.01).collect()] == ["C1"]
    assert hot_keys(orders, "Customer ID", 0.5).count() == 0


def test_aqe_splits_the_hot_customer(spark, skewed, large_sides):
    orders, dim = skewed
    joined = _lookup(orders, dim, "Customer ID", "CustomerID", "_found", ["CustomerName"])
    plan = _plan(joined)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert joined.count() == 30000


def test_small_lookup_side_is_broadcast_after_measuring(spark, skewed):
    orders, dim = skewed
    joined = _lookup(orders, dim, "Customer ID", "CustomerID", "_found", ["CustomerName"])
    assert "BroadcastHashJoin" in _plan(joined)


def test_salted_lookup_equals_plain_join(spark, skewed, large_sides):
    orders, dim = skewed
    side = dim.withColumnRenamed("CustomerID", "Customer ID")
    salted = left_lookup(orders, side, "Customer ID", hot_keys(orders, "Customer ID"), buckets=8)
    plain = orders.join(side, "Customer ID", "left")
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    unmatched = salted.where(F.col("CustomerName").isNull()).count()
    assert unmatched == plain.where(F.col("CustomerName").isNull()).count() > 0


def test_clean_orders_salted_equals_default(spark, skewed):
    from salesmart import clean_customers, clean_orders, clean_products
    orders, _ = skewed
    orders = orders.selectExpr("`Order ID`", "`Customer ID`",
                               "CASE WHEN length(`Order ID`) % 2 = 0 THEN 'P1' ELSE 'P2' END AS `Product ID`",
                               "1.5 AS Profit", "'1/2/2023' AS `Order Date`", "'3/2/2023' AS `Ship Date`")
    customers = spark.range(400).selectExpr(
        "concat('C', CAST(id AS STRING)) AS `Customer ID`", "'Ann' AS `Customer Name`",
        "'a@b.co' AS email", "'1234567890' AS phone", "'12345' AS `Postal Code`",
        "'North' AS Region", "'X' AS Country")
    products = spark.createDataFrame([("P1", 1.0, "c", "s")], "`Product ID` string, "
                                     "UnitPrice double, Category string, `Sub-Category` string")
    cust, _ = clean_customers(customers)
    prod, _ = clean_products(products)
    plain = clean_orders(orders, cust, prod)
    salted = clean_orders(orders, cust, prod, hot_share=0.01)
    for a, b in zip(plain, salted):
        a = a.withColumn("Issues", F.concat_ws("|", "Issues"))
        b = b.withColumn("Issues", F.concat_ws("|", "Issues"))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert salted[1].count() > 0 and salted[0].count() > 0


def test_file_backed_dimension_needs_no_rebalance(spark, skewed, large_sides, tmp_path):
    orders, dim = skewed
    dim.write.parquet(str(tmp_path / "dim"))
    written = spark.read.parquet(str(tmp_path / "dim"))
    joined = _lookup(orders, written, "Customer ID", "CustomerID", "_found", ["CustomerName"],
                     rebalance=False)
    plan = _plan(joined)
    assert "skew=true" in plan and "RebalancePartitions" not in plan


def test_hot_keys_of_columns_in_one_pass(spark):
    from salesmart.operators.skew import hot_keys_of_columns
    df = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'C1' ELSE concat('C', CAST(id % 500 AS STRING)) END AS c",
        "CASE WHEN id % 2 = 0 THEN 'P7' WHEN id % 7 = 0 THEN NULL "
        "ELSE concat('P', CAST(id % 900 AS STRING)) END AS p")
    both = hot_keys_of_columns(df, ["c", "p"], 0.01)
    for key, want in (("c", ["C1"]), ("p", ["P7"])):
        got = sorted(r[0] for r in both[key].collect())
        assert got == want == sorted(r[0] for r in hot_keys(df, key, 0.01).collect())
