"""Readers of the three raw inputs and of published parquet tables.

* customers: workbooks (``excel.read_workbooks``); a missing phone becomes
  the text ``nan`` so that it is reported as an invalid phone;
* products: CSV with a header, split into blocks even if quoted cells hold line
  breaks; all columns are read as text (no inference pass), common
  missing-value tokens become null, and the price column is typed later by the
  cleaning step;
* orders: JSON with a declared schema, as one top-level array per file (large
  ones are split) or as JSON lines (splittable).  Ids stay text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart import schemas as S
from salesmart.sources.excel import read_workbooks
from salesmart.sources.split_text import csv_pieces, json_pieces, records, text_bytes
from salesmart.sources.store import file_marks

# Text read as missing in CSV cells (the usual spreadsheet and
# dataframe spellings of "no value").
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
MISSING_PHONE_TEXT = "nan"
CUSTOMER_ALIASES = {S.CUSTOMER_ID: S.CUSTOMER_ID_ALIASES, S.CUSTOMER_NAME: S.CUSTOMER_NAME_ALIASES,
                    S.COUNTRY: S.COUNTRY_ALIASES}
# Quotes inside a quoted cell are doubled.
CSV_QUOTING = {"quote": '"', "escape": '"'}
# An array of at most so many bytes is read by one task, as two splits of a file would be.
WHOLE_ARRAY_BYTES = 256 << 20


def read_customers(spark: SparkSession, path: str,
                   schema: StructType = S.CUSTOMER_SCHEMA) -> DataFrame:
    """Customer workbooks; missing-value tokens are null, a missing phone is the text ``nan``.

    A column may go by any of its aliases; a workbook without a country raises.
    """
    df = read_workbooks(spark, path, schema, CUSTOMER_ALIASES, required=(S.COUNTRY,))
    df = df.select(*[F.when(~F.col(S.q(c)).isin(*NA_TOKENS), F.col(S.q(c))).alias(c) for c in df.columns])
    if S.PHONE in df.columns:
        df = df.withColumn(S.PHONE, F.coalesce(F.col(S.PHONE), F.lit(MISSING_PHONE_TEXT)))
    return df


def read_products(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Product CSV.  Every file must have the first one's header, on one line.

    Large files are split.  Cells may hold line breaks in quotes; the records
    are found by ``split_text``, at the price of one shuffle of the text.
    ``multiline=False`` spares it for files without such breaks; a record that
    is not a line then raises, as does text that does not parse.
    """
    if multiline:
        df = _quoted_csv(spark, path)
    else:
        df = (spark.read.options(**CSV_QUOTING).option("header", True).option("inferSchema", False)
              .option("enforceSchema", False).option("mode", "FAILFAST").option("columnPruning", False).csv(path))
    return df.select(*[F.when(F.col(S.q(c)).isin(*NA_TOKENS), F.lit(None)).otherwise(F.col(S.q(c))).alias(c)
                       for c in df.columns])


def _quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of CSV files whose quoted cells may hold line breaks; all columns are text."""
    names = spark.read.options(**CSV_QUOTING).option("header", True).csv(path).columns
    fields = [f"c{i}" for i in range(len(names))]
    lines = records(spark, path, csv_pieces())
    whole = F.when(F.col("s_inside") == 0, F.regexp_replace("s_text", r"\r$", "")).otherwise(
        F.raise_error(F.lit("MALFORMED CSV: a quoted cell does not end before its file does")))
    rows = lines.select("s_first", whole.alias("s_text")).where(F.trim("s_text") != "")
    cells = F.from_csv(F.regexp_replace("s_text", "^\ufeff", ""), ", ".join(f"{f} string" for f in fields),
                       {**CSV_QUOTING, "mode": "FAILFAST", "maxCharsPerColumn": "-1"})
    parsed = rows.select("s_first", cells.alias("s_row"))
    # A name that Spark made up or numbered stands for an empty or a repeated one.
    same = F.lit(True)
    for i, (field, name) in enumerate(zip(fields, names)):
        cell = F.coalesce(F.col("s_row").getField(field), F.lit(""))
        same = same & ((cell == name) | (F.concat(cell, F.lit(str(i))) == name) | (F.lit(f"_c{i}") == name))
    is_header = F.when(same, True).otherwise(F.raise_error(F.lit(
        f"MALFORMED CSV: a file's header is not the first file's, {names}")))
    body = parsed.where(F.when(F.col("s_first"), ~is_header).otherwise(True))
    return body.select(*[F.col("s_row").getField(f).alias(n) for f, n in zip(fields, names)])


def write_csv(df: DataFrame, path: str) -> None:
    """``df`` as CSV that ``read_products`` reads back unchanged (empty text becomes null)."""
    df.write.option("header", True).options(**CSV_QUOTING).csv(path)


def json_layout(spark: SparkSession, path: str) -> str:
    """``array`` or ``lines``: how every file under ``path`` starts; raises if they differ.

    A task reads the first bytes of each file.  Where tasks cannot open the
    store without Spark, the files are read once as text.
    """
    heads = {r["mark"] for r in file_marks(spark, path).select("mark").distinct().limit(4).collect()}
    if None in heads:
        lines = spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"), F.regexp_extract("value", r"[^\s\ufeff]", 0).alias("mark"))
        first = (lines.where(F.col("mark") != "").groupBy("file")
                 .agg(F.min(F.struct("block", "line", "mark")).alias("first")))
        heads = {r["mark"] for r in first.select("first.mark").distinct().limit(4).collect()}
    marks = heads - {""}
    if marks <= {"["}:
        return "array"
    if marks == {"{"}:
        return "lines"
    raise ValueError(f"the JSON files under {path} start with {sorted(marks)}; all must be arrays or all JSON lines")


def read_orders(spark: SparkSession, path: str, schema: StructType = S.ORDER_SCHEMA,
                multiline: bool | None = None, whole_bytes: int = WHOLE_ARRAY_BYTES) -> DataFrame:
    """Order JSON, as one top-level array of objects per file (any layout) or as JSON lines.

    By default the first bytes of the files tell the layout; ``multiline`` True
    (arrays) or False (lines) names it.  Lines are split by Spark.  An array is
    read by one task up to ``whole_bytes`` bytes (``split_text.text_bytes``); a
    larger one is split into its objects by ``split_text``, at the price of one
    shuffle of its text.  Files may be compressed.  Text
    that does not parse raises, so a wrong layout never loses rows.
    """
    if multiline is None:
        multiline = json_layout(spark, path) == "array"
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    if not multiline:
        return reader.json(path)
    whole = reader.option("multiLine", True).json(path).where(text_bytes() <= whole_bytes)
    return whole.unionByName(_split_arrays(spark, path, schema, whole_bytes))


def _split_arrays(spark: SparkSession, path: str, schema: StructType, min_bytes: int) -> DataFrame:
    """The objects of the top-level arrays in files over ``min_bytes`` bytes."""
    found = records(spark, path, json_pieces(), min_bytes)
    text = F.col("s_text")
    # What stands after the last closing brace is the end of the array, or all of an empty one.
    closes = F.when(F.col("s_first"), text.rlike(r"^[\s\ufeff]*\[\s*\]\s*$")).otherwise(text.rlike(r"^\s*\]\s*$"))
    opens = F.when(F.col("s_first"), text.rlike(r"^[\s\ufeff]*\[\s*\{")).otherwise(text.rlike(r"^\s*,\s*\{"))
    sound = F.when(F.col("s_last"), closes & (F.col("s_depth") == -1)).otherwise(opens)
    checked = F.when(sound, ~F.col("s_last")).otherwise(F.raise_error(F.concat(
        F.lit("MALFORMED JSON: not an element of a top-level array of objects: "), F.substring("s_text", 1, 100))))
    element = F.concat(F.regexp_replace("s_text", r"^[\s\ufeff]*[\[,]\s*", ""), F.lit("}"))
    parsed = F.from_json(element, schema, {"mode": "FAILFAST"})
    return found.where(checked).select(parsed.alias("s_row")).select("s_row.*")
