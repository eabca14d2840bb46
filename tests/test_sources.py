"""Readers: workbook, CSV and JSON files written in a temporary folder."""

import gzip
import io
import json
import tracemalloc
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salesmart.plans.catalog import write_json_arrays
from salesmart.sources import excel, store, testdata
from salesmart.sources.excel import iter_sheet_rows, workbook_bytes, write_workbook_table
from salesmart.sources.files import read_customers, read_orders, read_products
from salesmart.sources.testdata import raw_orders
from tables import SF_SMALL


def test_read_customers_workbook(spark, tmp_path):
    header = ["Customer ID", "Customer Name", "email", "phone", "Postal Code", "Country"]
    rows = [["A", "X", "x@test.com", 1234567890, "01841", "Chad"],
            ["B", "Y", "y@test.com", None, 2345.5, None]]
    (tmp_path / "customers.xlsx").write_bytes(workbook_bytes(header, rows))
    df = read_customers(spark, str(tmp_path))
    got = sorted(tuple(r) for r in df.collect())
    assert df.columns == ["Customer ID", "Customer Name", "email", "phone", "Postal Code",
                          "Region", "Country"]
    assert got == [("A", "X", "x@test.com", "1234567890", "01841", None, "Chad"),
                   ("B", "Y", "y@test.com", "nan", "2345.5", None, None)]


def test_workbook_shared_strings_and_gaps(tmp_path):
    import io
    import zipfile
    raw = workbook_bytes(["a", "b", "c"], [["x", None, "z"]])
    # rewrite the sheet with a shared string, a boolean and a skipped column
    buf = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(raw)) as src, zipfile.ZipFile(buf, "w") as dst:
        for item in src.infolist():
            data = src.read(item.filename)
            if item.filename == "xl/worksheets/sheet1.xml":
                data = data.replace(b'<row r="2">', b'<row r="2"><c r="A2" t="s"><v>0</v></c>'
                                    b'<c r="C2" t="b"><v>1</v></c></row><row r="3">')
            dst.writestr(item, data)
        ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        dst.writestr("xl/sharedStrings.xml",
                     f'<sst xmlns="{ns}"><si><r><t>sha</t></r><r><t>red</t></r></si></sst>')
    rows = list(iter_sheet_rows(buf.getvalue()))
    assert rows[0] == ["a", "b", "c"]
    assert rows[1] == ["shared", None, "TRUE"]
    assert rows[2] == ["x", None, "z"]


def test_write_and_read_workbooks(spark, tmp_path):
    df = spark.createDataFrame([(str(i), f"n{i}", "Chad") for i in range(50)],
                               "`Customer ID` string, `Customer Name` string, Country string").repartition(3)
    write_workbook_table(df, str(tmp_path / "wb"), rows_per_workbook=10)
    files = list((tmp_path / "wb").glob("*.xlsx"))
    assert 5 <= len(files) <= 8              # each partition split into workbooks of <= 10 rows
    back = read_customers(spark, str(tmp_path / "wb"))
    assert back.count() == 50
    assert back.where("`Customer Name` = 'n7'").first()["Customer ID"] == "7"


def test_read_products_csv(spark, tmp_path):
    pd.DataFrame({"Product ID": ["P1", "P2", "P3"], "Price": [20, None, 3.5],
                  "Category": ["a, b", "NA", "c"]}).to_csv(tmp_path / "products.csv", index=False)
    df = read_products(spark, str(tmp_path / "products.csv"))
    rows = {r["Product ID"]: r for r in df.collect()}
    assert df.count() == 3
    assert rows["P1"]["Price"] == "20.0" and rows["P1"]["Category"] == "a, b"
    assert rows["P2"]["Price"] is None and rows["P2"]["Category"] is None


@pytest.mark.parametrize("multiline", [False, True])
def test_read_orders_json_array(spark, tmp_path, multiline):
    records = [{"Order ID": "O1", "Customer ID": "C1", "Product ID": "P1", "Profit": 10,
                "Order Date": "1/1/2023", "Ship Date": "2/1/2023"},
               {"Order ID": "O2", "Customer ID": "C2", "Product ID": 7, "Profit": 2.5,
                "Order Date": "1/1/2023"}]
    text = json.dumps(records, indent=2 if multiline else None)
    (tmp_path / "orders.json").write_text(text)
    df = read_orders(spark, str(tmp_path / "orders.json"), multiline=multiline)
    got = {r["Order ID"]: r for r in df.collect()}
    assert sorted(got) == ["O1", "O2"]
    assert got["O1"]["Profit"] == 10.0
    assert got["O2"]["Product ID"] == "7"       # ids stay text
    assert got["O2"]["Ship Date"] is None


def test_read_orders_json_lines(spark, tmp_path):
    path = tmp_path / "orders.jsonl"
    path.write_text("\n".join(json.dumps({"Order ID": f"O{i}", "Profit": i}) for i in range(5)))
    assert read_orders(spark, str(path)).count() == 5


def test_workbook_extension_any_case(spark, tmp_path):
    (tmp_path / "UPPER.XLSX").write_bytes(workbook_bytes(["Customer ID", "Country"], [["Z1"]]))
    (tmp_path / "notes.txt").write_text("not a workbook")
    df = read_customers(spark, str(tmp_path))
    assert [r["Customer ID"] for r in df.collect()] == ["Z1"]


def test_json_arrays_grow_in_number_not_in_size(spark, tmp_path):
    """Equal rows, which a hash would put into one file, spread over files of a fixed size."""
    columns = ("`Order ID` string, `Customer ID` string, `Product ID` string, Profit double, "
               "`Order Date` string, `Ship Date` string")
    hot = spark.createDataFrame([("1", "K", "T", 1.5, "1/1/2022", None)] * 900, columns).repartition(4)
    orders = hot.union(spark.createDataFrame([(str(i), "K", "T", 0.5, None, "x\ny") for i in range(100)], columns))
    write_json_arrays(orders, str(tmp_path / "arrays"), rows=50)
    files = sorted((tmp_path / "arrays").glob("file=*/part-*"))
    sizes = [len(json.loads(f.read_text())) for f in files]
    assert len(files) == 20 and sum(sizes) == 1000 and max(sizes) <= 100
    got = read_orders(spark, f"{tmp_path}/arrays/file=*").select(*orders.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, orders.collect()))
    write_json_arrays(orders.where("false"), str(tmp_path / "none"), rows=50)
    assert read_orders(spark, f"{tmp_path}/none/file=*").count() == 0


def _shared_workbook(path, n_rows):
    """A workbook whose cells are shared strings, written row by row."""
    body = f'<sst xmlns="{excel.MAIN_NS}">' + "".join(
        f"<si><t>{t}</t></si>" for t in ["Customer ID", "Customer Name", *(f"name {i} é" for i in range(n_rows))]) + "</sst>"
    blank = io.BytesIO(excel.workbook_bytes([], []))
    with zipfile.ZipFile(blank) as old, zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as new:
        for part in old.namelist():
            if "sheet1" not in part:
                new.writestr(part, old.read(part))
        new.writestr("xl/sharedStrings.xml", body)
        with new.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'<worksheet xmlns="{excel.MAIN_NS}"><sheetData>'.encode())
            sheet.write(b'<row><c t="s"><v>0</v></c><c t="s"><v>1</v></c></row>')
            for i in range(n_rows):
                sheet.write(b'<row><c><v>%d</v></c><c t="s"><v>%d</v></c></row>' % (i, i + 2))
            sheet.write(b"</sheetData></worksheet>")


def test_large_workbook_is_read_in_bounded_memory(tmp_path):
    n = 60_000
    _shared_workbook(tmp_path / "big.xlsx", n)
    tracemalloc.start()
    try:
        with open(tmp_path / "big.xlsx", "rb") as file:
            rows = excel.iter_sheet_rows(file)
            assert next(rows) == ["Customer ID", "Customer Name"]
            for i, row in enumerate(rows):
                assert row == [str(i), f"name {i} é"]
        assert i == n - 1
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 6 << 20  # as a tree the strings alone take over 30 MB


def test_workbooks_travel_as_paths_where_tasks_can_open_them(spark, tmp_path, monkeypatch):
    for name in ("a.xlsx", "b.XLSX"):
        _shared_workbook(tmp_path / name, 5)
    schema = StructType([StructField(c, StringType()) for c in ("Customer ID", "Customer Name")])
    by_path = excel.read_workbooks(spark, str(tmp_path), schema)
    scan = by_path._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in scan and "content" not in scan
    monkeypatch.setattr(excel, "tasks_can_open", lambda files: False)
    by_content = excel.read_workbooks(spark, str(tmp_path), schema)
    assert by_path.count() == 10 and sorted(by_path.collect()) == sorted(by_content.collect())


def test_stores_that_tasks_cannot_open_are_told(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"1")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert store.tasks_can_open(files)
    assert not store.tasks_can_open(files.selectExpr("'unknown://host/x' AS path"))
    assert not store.tasks_can_open(files.selectExpr("concat(path, '.gone') AS path"))


def test_order_lines_are_joined_by_tasks_that_grow_in_number(spark, monkeypatch):
    plain = raw_orders(spark, SF_SMALL)
    monkeypatch.setattr(testdata, "PLAIN_JOIN_LINES", 1000)
    monkeypatch.setattr(testdata, "LINES_PER_TASK", 500)
    lines = testdata.table(spark, SF_SMALL, "lineitem").count()
    many = raw_orders(spark, SF_SMALL)
    used = many.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
    assert used[0] == -(-lines // 500) and used[1] < 1500
    assert sorted(map(str, many.collect())) == sorted(map(str, plain.collect()))


def test_compressed_json_arrays(spark, tmp_path):
    orders = raw_orders(spark, SF_SMALL)
    write_json_arrays(orders, str(tmp_path / "a"), rows=900, compression="gzip")
    files = sorted((tmp_path / "a").glob("file=*/part-*"))
    assert len(files) == -(-orders.count() // 900) and all(f.name.endswith(".gz") for f in files)
    assert all(isinstance(json.loads(gzip.decompress(f.read_bytes())), list) for f in files)
    for limit in (0, 1 << 30):
        got = read_orders(spark, f"{tmp_path}/a/file=*", whole_bytes=limit).select(*orders.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, orders.collect()))
