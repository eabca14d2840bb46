"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

The mix takes ``share`` times all words.  Sources in code-point order (null
last) carry the weights of ``weights``, repeating; each gets a target in
proportion to its weight, at most ``most_epochs`` times its own size, and what
a source cannot take is shared again by weight among the others.  A target of
e epochs and a rest is met by e whole copies of the source and a weighted
sample without replacement for the rest: each document draws the exponential
key -ln(u) / quality, the source is taken in ascending key order, and its
prefix sum of sizes is cut at the document nearest to the rest.

Scale: no source is ever in one task.  Keys are cut into ``BUCKETS`` ranges
per source, each of which holds at most about 3 / BUCKETS of a source's
distinct documents; sizes are summed per (source, range) with map-side
aggregation, the prefix sums over ranges give the one range in which the cut
lies, and only the distinct keys of that range are ordered.  What remains is
one row per source (target, epochs, last key taken), joined to the documents
without moving their texts while that table is under Spark's broadcast size,
else by a shuffle join whose hot sources adaptive execution splits.

u depends on the seed, the id and the text only, so reruns agree on any
partitioning.

Ties: rows equal in id and text draw the same key.  They are one row of the
ordering, with their number, however many they are.  Where the cut falls among
them, those that come first in the files are taken, as many as bring the sum
nearest to the rest; the last of them is found by counts per ``CHUNK`` rows of
a file and the order within one such chunk.

Defined cases: a null text has no words and takes none; a null source is a
source of its own; a null quality counts as ``DEFAULT_QUALITY``.  An empty
table gives an empty result; if no document has words, nothing is taken.
Columns beside id, text and source are never looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.llm.common import row_place, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
BUCKETS = 16384
GOOD, DEFAULT_QUALITY, BAD = 1.0, 0.5, 0.25
CHUNK = 1 << 16


def exponential(seed: int, key: Column, text: Column) -> Column:
    """-ln(u) with u uniform in (0, 1), the same for the same id and text."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, text), 11)
    return -F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53)))


def _key_range(key: Column) -> Column:
    """Monotone map of (0, inf) to 0..BUCKETS-1: the distribution of the keys if all qualities were equally frequent."""
    qualities = (GOOD, DEFAULT_QUALITY, BAD)
    below = sum((1 - F.exp(-key * q) for q in qualities[1:]), 1 - F.exp(-key * qualities[0])) / len(qualities)
    return F.least(F.floor(below * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def quality_weights(labels: DataFrame) -> DataFrame:
    """(q_id, q_weight) from quality labels: ``GOOD`` or ``BAD``, their mean for both."""
    weight = F.when(F.col("quality") == 1, GOOD).when(F.col("quality") == 0, BAD)
    return (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("q_id"))
            .agg(F.avg(weight).alias("q_weight")))


def measured(docs: DataFrame, labels: DataFrame | None, seed: int, key: str = "doc_id", text: str = "text",
             source: str = "source", record: bool = False) -> DataFrame:
    """id, source, size, sampling key, key range and place of each row; with ``record`` also the row itself."""
    file, position = row_place(docs)
    rows = docs.select(*[F.struct("*").alias("m_record")] * record, F.col(key).alias("m_id"),
                       F.col(source).alias("m_source"), word_count(F.col(text)).alias("m_size"),
                       exponential(seed, F.col(key), F.col(text)).alias("m_draw"),
                       file.alias("m_file"), position.alias("m_at"))
    if labels is not None:
        rows = rows.join(quality_weights(labels), F.col("m_id") == F.col("q_id"), "left")
    else:
        rows = rows.withColumn("q_weight", F.lit(None).cast("double"))
    rows = rows.withColumn("m_key", F.col("m_draw") / F.coalesce("q_weight", F.lit(DEFAULT_QUALITY)))
    return rows.select(*["m_record"] * record, "m_id", "m_source", "m_size", "m_key",
                       _key_range(F.col("m_key")).alias("m_range"), "m_file", "m_at")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(m_source, t_size, t_target) from (m_source, t_size), one row per source.

    The targets are min(most_epochs * size, level * weight).  Sources are
    ordered by the level at which they fill up; the first that does not fill
    up gives the level.
    """
    listed = Window.orderBy(F.col("m_source").asc_nulls_last())
    every = Window.partitionBy()
    cap = F.col("t_size") * most_epochs
    ranked = sizes.select(
        "m_source", "t_size", cap.cast("double").alias("t_cap"),
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                     ((F.row_number().over(listed) - 1) % len(weights) + 1).cast("int")).alias("t_weight"))
    by_level = Window.orderBy(F.col("t_cap") / F.col("t_weight"), F.col("m_source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("t_size").over(every) * share - F.coalesce(F.sum("t_cap").over(before), F.lit(0.0)))
             / (F.sum("t_weight").over(every) - F.coalesce(F.sum("t_weight").over(before), F.lit(0.0))))
    levels = ranked.withColumn("t_level", level)
    open_level = F.when(F.col("t_level") <= F.col("t_cap") / F.col("t_weight"), F.col("t_level"))
    # The level rises with every source that fills up and falls after the first that does not.
    return (levels.withColumn("t_open", F.max(open_level).over(every))
            .select("m_source", "t_size",
                    F.coalesce(F.least("t_cap", F.col("t_open") * F.col("t_weight")), F.col("t_cap"))
                    .alias("t_target")))


def _place_in_order() -> Column:
    """Where a row stands in the order of the mix; equal rows stand at one place."""
    return F.struct(F.col("m_key").alias("key"), F.col("m_id").alias("id"), F.col("m_size").alias("size"))


def mix_plan(rows: DataFrame, **options) -> DataFrame:
    """One row per source: size, target, whole epochs and, beyond them, the last place and the last row there."""
    ranges = written(rows.groupBy("m_source", "m_range").agg(F.sum("m_size").alias("r_size")), "mix-ranges")
    sizes = ranges.groupBy("m_source").agg(F.sum("r_size").alias("t_size"))
    targets = written(
        source_targets(sizes, **options)
        .withColumn("t_epochs", F.when(F.col("t_size") > 0, F.floor(F.col("t_target") / F.col("t_size")))
                    .otherwise(F.lit(0)).cast("long"))
        .withColumn("t_rest", F.col("t_target") - F.col("t_epochs") * F.col("t_size"))
        .withColumnRenamed("m_source", "t_source"), "mix-targets")
    in_order = Window.partitionBy("m_source").orderBy("m_range")
    reached = F.sum("r_size").over(in_order)
    cut = (ranges.withColumn("r_reached", reached)
           .join(targets, F.col("m_source").eqNullSafe(F.col("t_source")))
           .where((F.col("r_reached") >= F.col("t_rest"))
                  & (F.col("r_reached") - F.col("r_size") < F.col("t_rest")))
           .select(F.col("m_source").alias("c_source"), F.col("m_range").alias("c_range"),
                   (F.col("r_reached") - F.col("r_size")).alias("c_before"), "t_rest"))
    near = (rows.join(cut, F.col("m_source").eqNullSafe(F.col("c_source")) & (F.col("m_range") == F.col("c_range")))
            .groupBy("c_source", "c_range", "c_before", "t_rest", _place_in_order().alias("c_last"))
            .agg(F.count(F.lit(1)).alias("c_rows"), F.sum("m_size").alias("c_size")))
    earlier = Window.partitionBy("c_source").orderBy("c_last").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("t_rest") - F.col("c_before") - F.coalesce(F.sum("c_size").over(earlier), F.lit(0))
    # A row is in if that brings the sum nearer to the rest than stopping before it.
    fitting = (F.when(F.col("c_last.size") > 0, F.floor(F.col("c_room") / F.col("c_last.size") + 0.5))
               .when(F.col("c_room") >= 0, F.col("c_rows")).otherwise(0))
    last = (near.withColumn("c_room", room)
            .withColumn("c_taken", F.least(fitting, F.col("c_rows")).cast("long")).where("c_taken > 0")
            .groupBy("c_source").agg(F.max(F.struct("c_last", "c_rows", "c_taken")).alias("l")))
    found = written(
        cut.select("c_source", "c_range").join(last.select(F.col("c_source").alias("l_source"), "l.*"),
                                               F.col("c_source").eqNullSafe(F.col("l_source")), "left")
        .drop("l_source"), "mix-cuts")
    plan = targets.join(found, F.col("t_source").eqNullSafe(F.col("c_source")), "left")
    ends = _last_equal_rows(rows, found.where("c_taken < c_rows"))
    return plan.join(ends, F.col("t_source").eqNullSafe(F.col("e_source")), "left").select(
        "t_source", "t_size", "t_target", "t_epochs", "c_range", "c_last", "c_end")


def _last_equal_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(e_source, c_end): the place of the last row taken where only some of the rows equal in key are."""
    tied = (rows.join(found, F.col("m_source").eqNullSafe(F.col("c_source")) & (F.col("m_range") == F.col("c_range"))
                      & (_place_in_order() == F.col("c_last")))
            .select("c_source", "c_taken", F.struct("m_file", F.floor(F.col("m_at") / CHUNK).alias("part"))
                    .alias("e_chunk"), F.struct(F.col("m_file").alias("file"), F.col("m_at").alias("at"))
                    .alias("c_end")))
    counts = tied.groupBy("c_source", "c_taken", "e_chunk").agg(F.count(F.lit(1)).alias("e_rows"))
    reached = F.sum("e_rows").over(Window.partitionBy("c_source").orderBy("e_chunk"))
    chunk = (counts.withColumn("e_reached", reached)
             .where((F.col("e_reached") >= F.col("c_taken")) & (F.col("e_reached") - F.col("e_rows") < F.col("c_taken")))
             .select(F.col("c_source").alias("e_source"), F.col("e_chunk").alias("e_last"),
                     (F.col("c_taken") - F.col("e_reached") + F.col("e_rows")).alias("e_at")))
    within = tied.join(chunk, F.col("c_source").eqNullSafe(F.col("e_source")) & (F.col("e_chunk") == F.col("e_last")))
    return (within.withColumn("e_nth", F.row_number().over(Window.partitionBy("e_source").orderBy("c_end")))
            .where("e_nth = e_at").select("e_source", "c_end"))


def _picked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with their source's plan and ``m_times``, how often the mix takes each."""
    place, row = _place_in_order(), F.struct(F.col("m_file").alias("file"), F.col("m_at").alias("at"))
    last = (place == F.col("c_last")) & (F.col("c_end").isNull() | (row <= F.col("c_end")))
    extra = (F.when(F.col("m_range") < F.col("c_range"), 1)
             .when((F.col("m_range") == F.col("c_range")) & ((place < F.col("c_last")) | last), 1).otherwise(0))
    return (rows.join(plan, F.col("m_source").eqNullSafe(F.col("t_source")), "left")
            .withColumn("m_times", F.col("t_epochs") + extra))


def _numbers(docs: DataFrame, labels: DataFrame | None, seed: int) -> DataFrame:
    return written(measured(docs, labels, seed), "mix-rows")


def mix(docs: DataFrame, labels: DataFrame | None = None, seed: int = 7, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken (words taken, repeats counted) of every row of ``docs``."""
    numbers = _numbers(docs, labels, seed)
    return _picked(numbers, written(mix_plan(numbers, **options), "mix-plan")).select(
        F.col("m_id").alias("doc_id"), F.col("m_size").alias("size"), F.col("t_size").alias("source_size"),
        F.col("t_target").alias("target"), (F.col("m_size") * F.col("m_times")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, labels: DataFrame | None = None, seed: int = 7, **options) -> DataFrame:
    """The documents of the mix with their own columns, one row for each time a document is taken."""
    plan = written(mix_plan(_numbers(docs, labels, seed), **options), "mix-plan")
    times = _picked(measured(docs, labels, seed, record=True), plan).where("m_times > 0")
    return (times.select("m_record", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m_times"))).alias("m_epoch"))
            .select("m_record.*"))
