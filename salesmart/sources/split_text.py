"""Records of large text files that a line reader cannot find alone, read by all cores.

A quoted CSV cell may hold line breaks, and a JSON array may be one line or
many, so where a record ends depends on all the text before it.  The files are
read as text pieces (``lineSep``), which Spark splits into blocks.  What a
piece does to the reader's state is known without the text before it: the
state at its end, inside or outside a quoted text, for either state at its
start, and for either state the change in depth.  These effects are composed
by running sums and last values, first over the pieces of each block, then
over the blocks of each file, which gives every piece its true state and every
record its end.

Scale: one shuffle brings the pieces of a block together; a block is bounded by
``spark.sql.files.maxPartitionBytes``, but a compressed file is one block.  Only a few numbers of each block are
ordered by file, and only the records cut by a border of blocks, at most two
parts for each block, meet in a second shuffle.  Everything is built-in
expressions; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A file goes by a hash of its path, which is cheap to sort by; a second hash tells if two files share one.
BLOCK = ("s_file", "s_block")
# Indented JSON shrinks about so much; a compressed file may hold more or less.
INFLATED = 16


@dataclass(frozen=True)
class Pieces:
    """What a piece (its text is the column ``s_text``) does.

    ``after_out`` and ``after_in`` are true if the piece ends inside a quoted
    text when it starts outside or inside of one; ``depth_out`` and
    ``depth_in`` are its change in depth then.  ``sets`` tells if the end of a
    piece may be the same for both starts.
    """

    separator: str
    after_out: Column
    after_in: Column
    depth_out: Column
    depth_in: Column
    sets: bool


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def json_pieces() -> Pieces:
    """Text between closing braces, of a top-level array of objects.

    No valid JSON escape holds a brace, so no escape is cut.  The brace that
    ends the piece counts if it is outside a string.
    """
    plain = F.regexp_replace("s_text", r"(?s)\\.", "")
    odd = _count(plain, '"') % 2 == 1

    def depth(start: Column, closes: Column) -> Column:
        outside = F.regexp_replace(start, r'(?s)"[^"]*("|$)', "")
        return _count(outside, "{") - _count(outside, "}") - F.when(closes, 1).otherwise(0)

    return Pieces("}", odd, ~odd, depth(plain, ~odd),
                  depth(F.regexp_replace(plain, r'(?s)^[^"]*("|$)', ""), odd), sets=False)


def csv_pieces() -> Pieces:
    """Lines; a cell is quoted only if its first character is a quote, and quotes in it are doubled."""
    def opens(line: Column) -> Column:
        unquoted = F.regexp_replace(line, r'(^|,)"(?:[^"]|"")*+"(?=,|\r?$)', "$1")
        return F.coalesce(unquoted.rlike(r'(^|,)"'), F.lit(False))

    closing = r'^(?:[^"]|"")*+"(?=,|\r?$)'
    line = F.col("s_text")
    # What follows the closing quote starts with a comma: a cell of its own.
    after_in = F.when(line.rlike(closing), opens(F.regexp_replace(line, closing, "x"))).otherwise(True)
    return Pieces("\n", opens(line), after_in, F.lit(0), F.lit(0), sets=True)


def _with_state(df: DataFrame, part: list[str], order: str, after_out: str, after_in: str, sets: bool) -> DataFrame:
    """``df`` with ``s_set`` and ``s_flips``, from which ``_state`` tells the state at the start of each row.

    A row whose end does not depend on its start sets the state; the others keep
    or flip it.
    """
    before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    flip = (F.col(after_out) & ~F.col(after_in)).cast("int")
    df = df.withColumn("s_sum", F.sum(flip).over(upto)).withColumn("s_flips", F.col("s_sum") - flip)
    if not sets:
        return df.withColumn("s_set", F.lit(None).cast("int"))
    base = F.when(F.col(after_out) == F.col(after_in), (F.col(after_out).cast("int") + F.col("s_sum")) % 2)
    return df.withColumn("s_base", base).withColumn("s_set", F.last("s_base", ignorenulls=True).over(before))


def _state(start: Column) -> Column:
    """The state (0 outside, 1 inside) of a row of ``_with_state`` if the first row of its part starts in ``start``."""
    return ((F.coalesce(F.col("s_set"), start) + F.col("s_flips")) % 2).cast("int")


def text_bytes() -> Column:
    """Bytes of a file's text; a compressed file, by its name, is taken to hold ``INFLATED`` times its size."""
    size = F.col("_metadata.file_size")
    return F.when(F.col("_metadata.file_name").rlike(r"(?i)\.(gz|bz2|zst|deflate|snappy|lz4)$"), size * INFLATED).otherwise(size)


def records(spark: SparkSession, path, kind: Pieces, min_bytes: int = 0) -> DataFrame:
    """(s_first, s_text, s_inside, s_depth, s_last) of every record of the files over ``min_bytes`` bytes.

    ``s_text`` joins the record's pieces by the separator, without the one after
    the last.  ``s_first`` and ``s_last`` mark the first and last record of a
    file; ``s_inside`` and ``s_depth`` are the state at the record's end, which
    is 0 and at most 0 but for a last record that does not end.
    """
    text = spark.read.option("lineSep", kind.separator).text(path)
    if min_bytes:
        text = text.where(text_bytes() > min_bytes)
    name = F.col("_metadata.file_path")
    pieces = text.select(F.xxhash64(name).alias("s_file"), F.hash(name).alias("s_check"),
                         F.col("_metadata.file_block_start").alias("s_block"),
                         F.monotonically_increasing_id().alias("s_at"), F.col("value").alias("s_text"))
    pieces = (pieces.withColumns({"s_after_out": kind.after_out, "s_after_in": kind.after_in,
                                  "s_depth_out": kind.depth_out, "s_depth_in": kind.depth_in})
              .repartition(*BLOCK))
    placed = _with_state(pieces, list(BLOCK), "s_at", "s_after_out", "s_after_in", kind.sets)

    def depth_if(start: int) -> Column:
        return F.when(_state(F.lit(start)) == 1, F.col("s_depth_in")).otherwise(F.col("s_depth_out"))

    def after_if(start: int) -> Column:
        return F.when(_state(F.lit(start)) == 1, F.col("s_after_in")).otherwise(F.col("s_after_out"))

    blocks = placed.groupBy(*BLOCK).agg(
        F.max_by(after_if(0), "s_at").alias("b_out"), F.max_by(after_if(1), "s_at").alias("b_in"),
        F.sum(depth_if(0)).alias("b_depth_out"), F.sum(depth_if(1)).alias("b_depth_in"),
        F.min("s_at").alias("b_min"), F.max("s_at").alias("b_max"), F.min("s_check").alias("b_check"),
        F.max("s_check").alias("b_check_max"),
        F.max(F.length("s_text")).alias("b_longest"))  # both uses read every column, so that they share one shuffle
    blocks = blocks.where(F.when((F.col("b_check") == F.col("b_check_max")) & (F.col("b_longest") >= 0), True).otherwise(
        F.raise_error(F.lit("two files share the hash of their paths; read them one at a time"))))
    blocks = _with_state(blocks, ["s_file"], "s_block", "b_out", "b_in", kind.sets)
    file = Window.partitionBy("s_file")
    earlier = file.orderBy("s_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (blocks.withColumn("b_start", _state(F.lit(0)))
              .withColumn("b_depth", F.when(F.col("b_start") == 1, F.col("b_depth_in")).otherwise(F.col("b_depth_out")))
              .select(F.col("s_file").alias("b_file"), F.col("s_block").alias("b_block"), "b_check", "b_start",
                      F.coalesce(F.sum("b_depth").over(earlier), F.lit(0)).alias("b_before"),
                      F.first("b_min").over(file.orderBy("s_block").rowsBetween(
                          Window.unboundedPreceding, Window.unboundedFollowing)).alias("b_first"),
                      F.last("b_max").over(file.orderBy("s_block").rowsBetween(
                          Window.unboundedPreceding, Window.unboundedFollowing)).alias("b_last")))

    inside = F.when(F.col("s_start") == 1, F.col("s_after_in")).otherwise(F.col("s_after_out")).cast("int")
    change = F.when(F.col("s_start") == 1, F.col("s_depth_in")).otherwise(F.col("s_depth_out"))
    rows = Window.partitionBy(*BLOCK).orderBy("s_at").rowsBetween(Window.unboundedPreceding, 0)
    known = (placed.join(blocks, (F.col("s_file") == F.col("b_file")) & (F.col("s_block") == F.col("b_block"))
                         & (F.col("s_check").bitwiseXOR(F.col("b_check")) == 0))  # no key of the join, which moves no text
             .withColumn("s_start", _state(F.col("b_start")))
             .withColumns({"s_inside": inside, "s_change": change})
             .withColumn("s_depth", F.col("b_before") + F.sum("s_change").over(rows))
             .withColumn("s_clean", (F.col("s_start") == 0) & (F.col("s_depth") - F.col("s_change") <= 0))
             .withColumn("s_key", F.last(F.when(F.col("s_clean"), F.col("s_at")), ignorenulls=True).over(rows)))

    known = known.withColumn("s_done", (F.col("s_inside") == 0) & (F.col("s_depth") <= 0))
    alone = F.col("s_clean") & F.col("s_done")
    single = known.where(alone).select("s_key", "s_text", F.col("s_at").alias("s_to"), "s_inside", "s_depth",
                                       "b_first", "b_last")
    parts = known.where(~alone).groupBy(*BLOCK, "s_key").agg(
        F.sort_array(F.collect_list(F.struct("s_at", "s_text"))).alias("s_pieces"),
        F.max(F.struct("s_at", "s_inside", "s_depth", "s_done")).alias("s_end"),
        F.first("b_first").alias("b_first"), F.first("b_last").alias("b_last"))
    parts = parts.select(
        "s_file", "s_key", F.array_join(F.col("s_pieces.s_text"), kind.separator).alias("s_text"),
        F.col("s_pieces")[0]["s_at"].alias("s_from"), F.col("s_end.s_at").alias("s_to"), "s_end.s_inside", "s_end.s_depth",
        "s_end.s_done", "b_first", "b_last")
    # Else a border of blocks cuts the record: it has no start here, or no end.
    whole = F.col("s_key").isNotNull() & F.col("s_done")
    order = Window.partitionBy("s_file").orderBy("s_from").rowsBetween(Window.unboundedPreceding, 0)
    cut = (parts.where(~whole).withColumn("s_key", F.last("s_key", ignorenulls=True).over(order))
           .groupBy("s_file", "s_key").agg(
               F.sort_array(F.collect_list(F.struct("s_from", "s_text"))).alias("s_pieces"),
               F.max(F.struct("s_to", "s_inside", "s_depth")).alias("s_end"),
               F.first("b_first").alias("b_first"), F.first("b_last").alias("b_last"))
           .select("s_key", F.array_join(F.col("s_pieces.s_text"), kind.separator).alias("s_text"), "s_end.s_to",
                   "s_end.s_inside", "s_end.s_depth", "b_first", "b_last"))
    return single.unionByName(parts.where(whole).select(*cut.columns)).unionByName(cut).select(
        (F.col("s_key") == F.col("b_first")).alias("s_first"), "s_text", "s_inside", "s_depth",
        (F.col("s_to") == F.col("b_last")).alias("s_last"))
