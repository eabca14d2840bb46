"""Large files that are split: records over block borders, every layout, and text that must raise."""

import csv
import gzip
import io
import json
import random

import pytest

from salesmart.sources.files import json_layout, read_orders, read_products
from salesmart.sources.split_text import INFLATED, text_bytes
from salesmart.sources.store import first_mark

SCHEMA = "id string, note string, tags array<string>, part struct<x: double, note: string>"
HARD = ["", "plain", "a } b", 'q " q', "{", "}{", "\\", '\\"', "[1, {", "] }, {", "é\U0001f600", "tab\tline\nend", ", \"id\": \"9\"}"]


@pytest.fixture
def blocks(spark):
    """Sets the size of the blocks that files are split into."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_size(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield set_size
    for n, v in before.items():
        spark.conf.set(n, v)


def json_rows(draw, count):
    text = lambda: draw.choice(HARD)
    return [{"id": str(i), "note": draw.choice([None, text()]), "tags": [text() for _ in range(draw.randrange(3))],
             "part": draw.choice([None, {"x": i / 2, "note": text()}])} for i in range(count)]


def layouts(rows):
    yield json.dumps(rows)
    yield json.dumps(rows, indent=2, ensure_ascii=False)
    yield "\ufeff\n [" + " ,\r\n".join(json.dumps(r, separators=(",", ":")) for r in rows) + "\t]\n\n"


def plain(row):
    part = row["part"]
    return (row["id"], row["note"], tuple(row["tags"]), part and (part["x"], part["note"]))


@pytest.mark.parametrize("size", [24, 200, 1 << 20])
def test_arrays_split_anywhere(spark, tmp_path, blocks, size):
    blocks(size)
    want = []
    for f, count in enumerate((0, 1, 2, 25)):
        rows = json_rows(random.Random(f), count)
        for k, text in enumerate(layouts(rows)):
            if count or k < 2:
                (tmp_path / f"f{f}{k}.json").write_text(text)
                want += map(plain, rows)
    got = [plain(r.asDict(recursive=True)) for r in read_orders(
        spark, str(tmp_path), SCHEMA, whole_bytes=0).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_arrays_are_whole_or_split_by_their_size(spark, tmp_path):
    rows = json_rows(random.Random(5), 30)
    for name, part in (("small", rows[:2]), ("large", rows[2:])):
        (tmp_path / f"{name}.json").write_text(json.dumps(part))
    size = (tmp_path / "small.json").stat().st_size
    for limit in (0, size - 1, size, 1 << 30):
        got = read_orders(spark, str(tmp_path), SCHEMA, whole_bytes=limit)
        assert sorted(r.id for r in got.collect()) == sorted(r["id"] for r in rows)


@pytest.mark.parametrize("text", [
    '[{"id": "1"}, {"id": "2"', '[{"id": "1"}', '[{"id": "1"} {"id": "2"}]', '[{"id": "1"}, 7, {"id": "2"}]', '[{"id": "1"}]]',
    '[{"id": "1"}] {"id": "2"}', '[{"id": "1}]', '[{"id": {"x": 1}]', '[{"id": "1",}]', '[', '[{"id": "1"},]'])
def test_arrays_that_do_not_parse_raise(spark, tmp_path, text):
    (tmp_path / "o.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_orders(spark, str(tmp_path), "id string", whole_bytes=0).collect()


CELLS = ["", "plain", "with, comma", 'quo"ted', '"', '""', "line\nbreak", "two\n\nbreaks, \"and\" more", "'", "é\U0001f600", " x ",
         "a,\"b\nc", "\n", ",", "x" * 70]


@pytest.mark.parametrize("size", [16, 150, 1 << 20])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_csv_split_anywhere(spark, tmp_path, blocks, size, ending):
    blocks(size)
    draw, want = random.Random(size), []
    for f, count in enumerate((0, 1, 40)):
        rows = [[f"{f}-{i}", draw.choice(CELLS), draw.choice(CELLS), draw.choice(CELLS)] for i in range(count)]
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=ending, quoting=draw.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        writer.writerows([["Product ID", "Name", "Category", "Price"], *rows])
        (tmp_path / f"f{f}.csv").write_bytes(out.getvalue().encode())
        want += [tuple(c or None for c in r) for r in rows]
    got = [tuple(r) for r in read_products(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_csv_quotes_within_unquoted_cells(spark, tmp_path, blocks):
    blocks(20)
    (tmp_path / "p.csv").write_text('Product ID,Name,Price\nT1,5" nail,3\n\nT2,"a\n5"" b",4\nT3,6" x 2",5\n')
    got = sorted(tuple(r) for r in read_products(spark, str(tmp_path)).collect())
    assert got == [("T1", '5" nail', "3"), ("T2", 'a\n5" b', "4"), ("T3", '6" x 2"', "5")]


@pytest.mark.parametrize("text", ['Product ID,Price\nT1,"1\nT2,2\n', "Product ID,Price\nT1,1,2\n", "Product ID,Price\nT1\n"])
def test_csv_that_does_not_parse_raises(spark, tmp_path, text):
    (tmp_path / "p.csv").write_text(text)
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        read_products(spark, str(tmp_path)).collect()


def test_layout_is_told_from_the_first_bytes(spark, tmp_path, monkeypatch):
    far = " " * 9000
    (tmp_path / "a.json").write_text(f"\ufeff{far}[{{}}]")
    (tmp_path / "empty.json").write_text("")
    assert first_mark(str(tmp_path / "a.json")) == "[" and first_mark(str(tmp_path / "empty.json")) == ""
    assert json_layout(spark, str(tmp_path)) == "array"
    # Where a task cannot open the store by itself, the text is read.
    from salesmart.sources import files

    monkeypatch.setattr(files, "file_marks", lambda s, p: s.createDataFrame([(str(p), None)], "file string, mark string"))
    assert json_layout(spark, str(tmp_path)) == "array"
    (tmp_path / "b.json").write_text('{"id": 1}')
    with pytest.raises(ValueError, match="arrays or all JSON lines"):
        json_layout(spark, str(tmp_path))


def test_text_is_shuffled_once(spark, tmp_path, blocks):
    blocks(200)
    (tmp_path / "o.json").write_text(json.dumps(json_rows(random.Random(3), 40)))
    df = read_orders(spark, str(tmp_path), SCHEMA, whole_bytes=0)
    assert len(df.collect()) == 40
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    text_shuffles = [line for line in final.splitlines() if "Exchange hashpartitioning(s_file" in line and "s_block" in line
                     and "REPARTITION_BY_COL" in line and "Reused" not in line]
    assert len(text_shuffles) == 1


@pytest.mark.parametrize("whole_bytes", [0, 1 << 30])
def test_compressed_arrays(spark, tmp_path, whole_bytes):
    rows = json_rows(random.Random(4), 30)
    (tmp_path / "o.json.gz").write_bytes(gzip.compress(json.dumps(rows, indent=2).encode()))
    (tmp_path / "p.json").write_text(json.dumps(rows[:3]))
    assert first_mark(str(tmp_path / "o.json.gz")) == "["
    got = [plain(r.asDict(recursive=True)) for r in read_orders(spark, str(tmp_path), SCHEMA, whole_bytes=whole_bytes).collect()]
    assert sorted(map(repr, got)) == sorted(repr(plain(r)) for r in rows + rows[:3])


def test_compressed_arrays_count_as_larger(spark, tmp_path):
    (tmp_path / "o.json.gz").write_bytes(gzip.compress(b'[{"id": "1"}]'))
    size = (tmp_path / "o.json.gz").stat().st_size
    assert spark.read.text(str(tmp_path)).select(text_bytes()).first()[0] == INFLATED * size
