"""Inputs that must be read whole or refused: JSON layouts, CSV quoting and headers, workbook columns."""

import json

import pytest
from pyspark.sql import functions as F

from salesmart.operators.skew import hot_keys, left_lookup
from salesmart.session import checkpoint_root
from salesmart.sources.excel import workbook_bytes
from salesmart.sources.files import json_layout, read_customers, read_orders, read_products
from salesmart.sources.store import first_mark, open_store

RECORDS = [{"Order ID": str(i), "Customer ID": "K1", "Profit": i / 4} for i in range(7)]


@pytest.mark.parametrize("text", [json.dumps(RECORDS, indent=2), json.dumps(RECORDS),
                                  "\n\n" + json.dumps(RECORDS, indent=1), "\n".join(map(json.dumps, RECORDS))])
def test_orders_of_any_layout(spark, tmp_path, text):
    (tmp_path / "o.json").write_text(text)
    got = read_orders(spark, str(tmp_path / "o.json")).collect()
    assert sorted((r["Order ID"], r["Profit"]) for r in got) == [(str(i), i / 4) for i in range(7)]


def test_orders_of_a_wrong_or_mixed_layout_raise(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(RECORDS, indent=2))
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ_FILE"):
        read_orders(spark, str(tmp_path / "a.json"), multiline=False).collect()
    (tmp_path / "b.json").write_text("\n".join(map(json.dumps, RECORDS)))
    with pytest.raises(ValueError, match="arrays or all JSON lines"):
        read_orders(spark, str(tmp_path))


def test_csv_line_breaks_quotes_dots_and_missing_tokens(spark, tmp_path):
    (tmp_path / "p.csv").write_text('Product ID,Name.short,Price\nT1,"a, ""b""\nc",1\nT2,N/A,nan\n')
    got = sorted(tuple(r) for r in read_products(spark, str(tmp_path / "p.csv")).collect())
    assert got == [("T1", 'a, "b"\nc', "1"), ("T2", None, None)]
    with pytest.raises(Exception):
        read_products(spark, str(tmp_path / "p.csv"), multiline=False).collect()


def test_csv_files_of_another_header_order_raise(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Product ID,Price,Category\nT1,1,c\n")
    (tmp_path / "b.csv").write_text("Category,Product ID,Price\nc,T2,2\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_products(spark, str(tmp_path)).collect()


HEADER = ["Customer ID", "Customer Name", "email", "phone", "Postal Code", "Region"]


def test_workbook_aliases_and_missing_tokens(spark, tmp_path):
    rows = [["K1", "N/A", "NA", None, 1841, "East", "Mali"], ["K2", "Ana", "a@x.example", 5550001111, "10101", "n/a", None]]
    (tmp_path / "c.xlsx").write_bytes(workbook_bytes([*HEADER, " Country_Name"], rows))
    got = [tuple(r) for r in read_customers(spark, str(tmp_path / "c.xlsx")).collect()]
    assert got == [("K1", None, None, "nan", "1841", "East", "Mali"),
                   ("K2", "Ana", "a@x.example", "5550001111", "10101", None, None)]
    (tmp_path / "d.xlsx").write_bytes(workbook_bytes(HEADER, [r[:6] for r in rows]))
    with pytest.raises(Exception, match="no column for"):
        read_customers(spark, str(tmp_path / "d.xlsx")).collect()


def test_stores_by_scheme(tmp_path):
    for folder in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        store, path = open_store(folder)
        assert path.rstrip("/") == str(tmp_path)
    with pytest.raises(Exception):
        open_store("nosuch://host/x")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:1"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_hot_share_is_bounded_and_null_keys_are_salted(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("k"), "id")
    for share in (0, -1, 1.5, 0.00001):
        with pytest.raises(ValueError, match="hot_share"):
            hot_keys(df, "k", share)
    side = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    salted = left_lookup(df, side, "k", hot_keys(df, "k", 0.1))
    plain = df.join(side, "k", "left")
    assert salted.exceptAll(plain).count() == 0 and salted.count() == 1000
