"""Helpers shared by the operators."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesmart.session import shared_dir

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Words are maximal runs of characters other than the six ASCII white-space ones.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and every later use sees the same rows.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_place(df: DataFrame) -> tuple[Column, Column]:
    """(file, position) of each row, both longs, to tell equal rows apart.

    Rows read from Parquet have the same place at every reading, however the
    files are split.  Rows of other frames are numbered by partition, which is
    the same in every run only if the frame's own order is.
    """
    try:
        place = df.metadataColumn("_metadata")
        file, position = F.xxhash64(place["file_path"]), place["row_index"]
        df.select(file, position)
    except AnalysisException:  # the frame has no files, or not of Parquet
        return F.lit(0).cast("long"), F.monotonically_increasing_id()
    return file, position


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _workers_find_package(spark: SparkSession) -> None:
    """Under a local master the Python workers look for this package where the driver found it.

    On a cluster the package is installed or shipped like any other dependency.
    """
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.environment.setdefault("PYTHONPATH", _PACKAGE_ROOT)


def with_columns_last(df: DataFrame, record: str, new: list[Column], names: list[str]) -> DataFrame:
    """The fields of the struct column ``record`` followed by the new columns.

    A field whose name clashes with a new column (in any case) is replaced by it.
    """
    taken = {n.lower() for n in names}
    kept = [F.col(record).getField(f).alias(f)
            for f in df.schema[record].dataType.fieldNames() if f.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for c, n in zip(new, names)])
