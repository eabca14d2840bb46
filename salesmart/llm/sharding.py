"""Sharding: a two-pass external shuffle.

Pass one scatters the records into buckets of about ``bucket_bytes``, counted
over all columns, by a seeded hash of the record's id and text.  Records equal
in both that make up more than ``HOT_SHARE`` of a bucket are scattered by
their places in the files as well, so that no bucket gathers them.  Pass two loads one bucket at a
time, orders it by that hash, shuffles it with Spark's ``shuffle`` (a seeded
Fisher-Yates shuffle of an array) and writes it out.  The buckets in order
form one permutation of all records, which is cut into ``n_shards`` runs
whose lengths differ by at most one (the law is ``rows``).

Scale: one shuffle of the records; a task holds one bucket, whose size is a
parameter and does not grow with the input (there are more buckets instead).
``repartitionById`` gives bucket b to partition b, so the generator of each
bucket starts from seed + b and a rerun, also of a lost task, gives the same
order.  The bucket sizes, one row per bucket, are the only global state; their
prefix sums are taken in Spark.  Equal texts differ in id and so spread over
all buckets.

Defined cases: a null text counts no bytes and has the checksum of the empty
text; a null id is hashed as null.  Rows equal in id and text stay apart as
rows.  An empty table gives an empty result.  Input columns
named as an output column are replaced by it.  Where only some rows equal in id
and text are alike in all columns, which of them has which slot depends on
their places in the files if they are scattered by these, else on their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from salesmart.llm.common import row_place, with_columns_last, written

N_SHARDS = 40
BUCKET_BYTES = 16 << 20
ROW_BYTES = 16
HOT_SHARE = 0.25


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus a fixed overhead per record."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("long")


def held_bytes(docs: DataFrame) -> Column:
    """About the bytes of a whole row: those of its texts and nested values, 8 for every other value."""
    total = F.lit(ROW_BYTES)
    for field in docs.schema.fields:
        column = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = F.octet_length(column)
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            size = F.octet_length(F.to_json(F.struct(column)))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0))
    return total.cast("long")


def scattered(docs: DataFrame, seed: int, key: str, text: str, bucket_bytes: int) -> tuple[DataFrame, int]:
    """(s_bucket, s_row) of every record, and the number of buckets."""
    mark, (file, position) = F.xxhash64(F.lit(seed), F.col(key), F.col(text)), row_place(docs)
    total = docs.agg(F.sum(held_bytes(docs)).alias("b")).first()["b"] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    hot = written(docs.select(mark.alias("h_mark"), held_bytes(docs).alias("h_bytes")).groupBy("h_mark")
                  .agg(F.sum("h_bytes").alias("h_bytes"), F.count(F.lit(1)).alias("h_rows"))
                  .where((F.col("h_rows") > 1) & (F.col("h_bytes") > bucket_bytes * HOT_SHARE))
                  .select("h_mark"), "shard-hot")
    rows = docs.select(mark.alias("s_mark"), F.xxhash64(F.lit(seed), mark, file, position).alias("s_own"),
                       F.struct(mark.alias("mark"), F.col(key).alias("id"), F.struct("*").alias("record"))
                       .alias("s_row"))
    by = F.when(F.col("h_mark").isNull(), F.col("s_mark")).otherwise(F.col("s_own"))
    return rows.join(hot, F.col("s_mark") == F.col("h_mark"), "left").select(
        F.pmod(by, F.lit(n_buckets)).cast("int").alias("s_bucket"), "s_row"), n_buckets


def shard_records(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = 20, key: str = "doc_id",
                  text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` in shuffled order with shard (0..n_shards-1) and slot (0.. in each shard)."""
    tagged, n_buckets = scattered(docs, seed, key, text, bucket_bytes)
    ahead = Window.orderBy("s_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = tagged.groupBy("s_bucket").agg(F.count(F.lit(1)).alias("s_count"))
    offsets = written(
        sizes.select("s_bucket",
                     F.coalesce(F.sum("s_count").over(ahead), F.lit(0)).alias("s_before"),
                     F.sum("s_count").over(Window.partitionBy()).alias("s_all")),
        "shard-offsets")
    loaded = (tagged.repartitionById(n_buckets, F.col("s_bucket"))
              .groupBy("s_bucket").agg(F.sort_array(F.collect_list("s_row")).alias("s_rows")))
    shuffled = loaded.select("s_bucket", F.posexplode(F.shuffle("s_rows", seed)).alias("s_at", "s_row"))
    placed = shuffled.join(offsets, "s_bucket").select(
        F.col("s_row.record").alias("s_record"),
        (F.col("s_before") + F.col("s_at")).alias("s_pos"), "s_all")
    # Shard s holds positions [floor(s*all/n), floor((s+1)*all/n)).
    shard = F.expr(f"cast(((s_pos + 1) * {n_shards} - 1) div s_all as int)")
    first = F.expr(f"(cast(((s_pos + 1) * {n_shards} - 1) div s_all as bigint) * s_all) div {n_shards}")
    return with_columns_last(placed, "s_record", [shard, F.col("s_pos") - first], ["shard", "slot"])
