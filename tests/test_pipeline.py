"""The end-to-end job: files in, seven parquet tables out; invariants on the
raw tables derived from the test data; result stability under partitioning."""

import json
import os

import pytest
from pyspark.sql import functions as F

from salesmart import schemas as S
from salesmart.operators.quality import annotate_customers, annotate_products
from salesmart.operators.refs import prepare_orders
from salesmart.plans.catalog import _mart, rendered
from salesmart.plans.etl import OUTPUT_TABLES, run_etl, run_pipeline
from salesmart.session import checkpoint_root
from salesmart.sources.excel import workbook_bytes
from salesmart.sources.testdata import raw_tables

from tables import SF_SMALL


def local_path(uri):
    return uri.split(":", 1)[1].replace("//", "/") if uri.startswith("file:") else uri


def test_mart_has_one_lookup_join_per_dimension(spark):
    plan = _mart(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2


def test_run_etl_from_files(spark, tmp_path):
    header = ["Customer ID", "Customer Name", "email", "phone", "Postal Code", "Region", "Country"]
    rows = [["K1", "Ida Vo", "ida@x.example", "5550001111", "10101", "West", "Fiji"],
            ["K2", "N/A", "per@x.example", None, "10101", "Moon", "Laos"]]
    (tmp_path / "customers.xlsx").write_bytes(workbook_bytes(header, rows))
    (tmp_path / "products.csv").write_text(
        "Product ID,Product Name,Category,Sub-Category,Price per product\n"
        '"T1","cup, ""blue""\nsmall",Kitchen,Cups,3\nT2,broken,Kitchen,Cups,-3\n')
    (tmp_path / "orders.json").write_text(json.dumps([
        {"Order ID": "7", "Customer ID": "K1", "Product ID": "T1", "Profit": 3.335,
         "Order Date": "30/6/2020", "Ship Date": "1/7/2020"},
        {"Order ID": "8", "Customer ID": "K2", "Product ID": "T1", "Profit": -1.0,
         "Order Date": "1/1/2021"},
        {"Order ID": "9", "Customer ID": "K1", "Product ID": "T2", "Profit": 6.0,
         "Order Date": "1/1/2021"}], indent=1))
    out = tmp_path / "out"
    for _ in range(2):  # a second run replaces the first
        tables = run_etl(spark, str(tmp_path / "customers.xlsx"), str(tmp_path / "products.csv"),
                         str(tmp_path / "orders.json"), str(out))
        assert sorted(tables) == sorted(OUTPUT_TABLES)
        assert all((out / name).is_dir() for name in OUTPUT_TABLES)
        counts = {n: df.count() for n, df in tables.items()}
        assert counts == {"customer_data_issues": 1, "product_data_issues": 1,
                          "order_data_issues": 1, "customers": 2, "products": 1,
                          "orders_enriched": 2, "aggregates": 2}
    agg = {(r.Year, r.CustomerName): r.TotalProfit for r in tables["aggregates"].collect()}
    assert agg == {(2020, "Ida Vo"): 3.34, (2021, "IMPUTED_per"): -1.0}
    issue = tables["customer_data_issues"].first()
    assert list(issue["Issues"]) == ["missing_name", "invalid_phone", "invalid_region"]
    assert not [p for p in os.listdir(local_path(checkpoint_root(spark))) if p.startswith("staging")]


@pytest.fixture(scope="module")
def small(spark):
    return run_pipeline(*raw_tables(spark, SF_SMALL))


def test_invariant_orders_split(spark, small):
    _, _, orders = raw_tables(spark, SF_SMALL)
    prepared = prepare_orders(orders).count()
    assert small["orders_enriched"].count() + small["order_data_issues"].count() == prepared


def test_invariant_customer_issues_subset(spark, small):
    missing = small["customer_data_issues"].select(F.col("CustomerID")).subtract(
        small["customers"].select("CustomerID"))
    assert missing.count() == 0


def test_invariant_products_split(spark):
    _, products, _ = raw_tables(spark, SF_SMALL)
    annotated = annotate_products(products)
    total = annotated.count()
    null_price = annotated.where(F.col(S.UNIT_PRICE).isNull()).count()
    outputs = run_pipeline(*raw_tables(spark, SF_SMALL))
    assert outputs["products"].count() + outputs["product_data_issues"].count() + null_price == total


def test_invariant_dimension_keys_unique(small):
    for name, key in [("customers", "CustomerID"), ("products", "ProductID")]:
        df = small[name]
        assert df.count() == df.select(key).distinct().count()


def test_invariant_mart_total_equals_fact_total(small):
    fact = small["orders_enriched"].agg(F.sum("ProfitRounded")).first()[0]
    mart = small["aggregates"].agg(F.sum("TotalProfit")).first()[0]
    assert round(fact, 2) == round(mart, 2)


def test_fused_equals_unfused(spark):
    raw = raw_tables(spark, SF_SMALL)
    fused = run_pipeline(*raw, fused=True)
    plain = run_pipeline(*raw, fused=False)
    for name in ("order_data_issues", "orders_enriched", "aggregates"):
        a, b = rendered(fused[name]), rendered(plain[name])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


@pytest.mark.parametrize("dedup", ["aggregate", "window"])
def test_dedup_strategies_agree(spark, dedup):
    customers, _, _ = raw_tables(spark, SF_SMALL)
    ref = annotate_customers(customers, "aggregate")
    other = annotate_customers(customers, dedup)
    assert ref.exceptAll(other).count() == 0 and other.exceptAll(ref).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_result_stable_under_partitioning(spark, parts):
    c, p, o = raw_tables(spark, SF_SMALL)
    base = run_pipeline(c, p, o)
    moved = run_pipeline(c.repartition(parts), p.repartition(parts), o.repartition(parts))
    for name in ("customer_data_issues", "customers", "orders_enriched", "aggregates"):
        a, b = rendered(base[name]), rendered(moved[name])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_command_line(spark, tmp_path, capsys):
    from salesmart.__main__ import main
    header = ["Customer ID", "Customer Name", "email", "phone", "Postal Code", "Region", "Country"]
    (tmp_path / "c.xlsx").write_bytes(workbook_bytes(
        header, [["K5", "Ann Wu", "ann@x.example", "5550001111", "10101", "East", "Oman"]]))
    (tmp_path / "p.csv").write_text("Product ID,Category,Sub-Category,Price\nT7,Garden,Hoses,31\n")
    (tmp_path / "o.json").write_text(
        '{"Order ID": "5", "Customer ID": "K5", "Product ID": "T7", "Profit": 1.005, '
        '"Order Date": "2/3/2024"}\n'
        '{"Order ID": "5", "Customer ID": "K5", "Product ID": "T7", "Profit": 2.0, '
        '"Order Date": "2/3/2024"}\n')
    main([str(tmp_path / "c.xlsx"), str(tmp_path / "p.csv"), str(tmp_path / "o.json"),
          str(tmp_path / "out"), "--lines", "--hot-share", "0.5"])
    assert "orders_enriched" in capsys.readouterr().out
    agg = spark.read.parquet(str(tmp_path / "out" / "aggregates")).collect()
    assert [(r.Year, r.CustomerName, r.TotalProfit) for r in agg] == [(2024, "Ann Wu", 3.01)]


def test_salted_pipeline_equals_default(spark):
    raw = raw_tables(spark, SF_SMALL)
    plain = run_pipeline(*raw)
    salted = run_pipeline(*raw, hot_share=0.01)
    for name in ("order_data_issues", "orders_enriched", "aggregates"):
        a, b = plain[name], salted[name]
        if "Issues" in a.columns:
            a, b = a.withColumn("Issues", F.concat_ws("|", "Issues")), b.withColumn(
                "Issues", F.concat_ws("|", "Issues"))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_order_dedup_strategies_agree(spark):
    _, _, orders = raw_tables(spark, SF_SMALL)
    a = prepare_orders(orders, dedup="aggregate")
    b = prepare_orders(orders, dedup="window")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
