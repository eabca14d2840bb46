"""Publishing: all tables of a run or none, rows counted while they are written."""

import os

import pytest
from tables import SF_SMALL

from salesmart.operators.marts import table_counts
from salesmart.plans import etl, sinks
from salesmart.plans.etl import OUTPUT_TABLES, output_counts, publish_tables, run_pipeline
from salesmart.plans.sinks import RUNS, Store, published_counts, read_published
from salesmart.sources.testdata import raw_tables


def counts(df):
    return {r.table_name: r.row_count for r in df.collect()}


@pytest.fixture(scope="module")
def raw(spark):
    return raw_tables(spark, SF_SMALL)


def test_a_run_that_fails_leaves_the_former_tables(spark, raw, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    publish_tables(spark, *raw, base)
    before = counts(table_counts(read_published(spark, base, OUTPUT_TABLES)))

    def fail(_):
        raise RuntimeError("lost")

    monkeypatch.setattr(etl, "aggregate_profit_by", fail)  # after customers, products and orders are written
    with pytest.raises(RuntimeError, match="lost"):
        publish_tables(spark, *[df.limit(5) for df in raw], base)
    assert counts(table_counts(read_published(spark, base, OUTPUT_TABLES))) == before
    assert {n: spark.read.parquet(f"{base}/{n}").count() for n in OUTPUT_TABLES} == before
    assert os.listdir(f"{base}/{RUNS}") and not Store(spark, base).folders(f"{base}/{RUNS}")


def test_a_committed_run_is_seen_whole_before_its_tables_are_moved(spark, raw, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    publish_tables(spark, *raw, base)
    moved, move = [], Store.move

    def move_two(self, source, target):
        if len(moved) == 2:
            raise OSError("lost")
        moved.append(target)
        move(self, source, target)

    monkeypatch.setattr(Store, "move", move_two)
    with pytest.raises(OSError, match="lost"):
        publish_tables(spark, *raw, base, order_key=None)
    want = counts(table_counts(run_pipeline(*raw, order_key=None)))
    assert counts(table_counts(read_published(spark, base, OUTPUT_TABLES))) == want
    assert counts(published_counts(spark, base)) == want
    monkeypatch.undo()
    publish_tables(spark, *raw, base)  # the next run tidies up
    assert not Store(spark, base).folders(f"{base}/{RUNS}")
    assert {n: spark.read.parquet(f"{base}/{n}").count() for n in OUTPUT_TABLES} == counts(published_counts(spark, base))


def test_tables_without_a_marker_are_read_from_their_folders(spark, tmp_path):
    sinks.publish({"t": spark.range(3).toDF("x")}, str(tmp_path))
    assert read_published(spark, str(tmp_path), ["t"])["t"].count() == 3


@pytest.mark.parametrize("order_key", [("Order ID",), None])
def test_counts_agree(spark, raw, tmp_path, order_key):
    want = counts(table_counts(run_pipeline(*raw, order_key=order_key)))
    assert counts(output_counts(*raw, order_key=order_key)) == want
    tables = publish_tables(spark, *raw, str(tmp_path / "out"), order_key=order_key)
    assert counts(published_counts(spark, str(tmp_path / "out"))) == counts(table_counts(tables)) == want


def test_counts_of_empty_inputs(spark, raw):
    assert set(counts(output_counts(*[df.where("false") for df in raw])).values()) == {0}


def test_counting_outputs_scans_the_orders_once(spark, raw):
    df = output_counts(*raw)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("lineitem") == 1
