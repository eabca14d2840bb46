"""The registered queries: their columns and rows, their SQL, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import queries
from salesmart.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
#: The columns that each query must return.
COLUMNS = {
    1: "page_id host path rule verdict",
    3: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    4: "doc_id held_out n_tokens n_known train_tokens base_score score",
    5: "doc_id held_out score predicted",
    6: "doc_id size text_crc32 law shard slot grown_shard",
    7: "doc_id size source_size target taken",
    8: "doc_id n_bytes n_tokens over_limit",
    9: "doc_id fingerprint component_id",
    10: "doc_id n_words n_base first_word last_word base_labels labels score",
    11: "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    12: "doc_id leaf subroot root proof_sha256 folded_root verified",
    13: "doc_id n_shingles component_id kept",
}


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_its_columns_and_a_row_for_each_input(spark, name):
    number = int(name[2:].split("_")[0])
    df = QUERIES[name](spark, SF)
    if number in COLUMNS:
        assert df.columns == COLUMNS[number].split()
        source = "pages" if number == 1 else "documents"
        assert df.count() == spark.read.parquet(f"{SF}/{source}.parquet").count()
    else:
        assert {"doc_id", "item_id"} <= set(df.columns) and df.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for name_of in ("pages", "documents"):
        con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{SF}/{name_of}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    got = [tuple(r[n] for n in names) for r in QUERIES[name](spark, SF).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want.fetchall()))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert set(after) <= before and after
        if name in ("toxicity", "simhash_near_dedup", "benchmark_decontamination"):
            assert len(after) == len(set(after)) and len(after) > 0.8 * len(before)
        if name != "sharding":
            assert docs.columns == columns
        before = set(after)
    assert docs.columns == [*columns, "shard", "slot"]
    empty = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
