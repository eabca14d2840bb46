"""Access to the shared store from within a task."""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Shipped by value, so executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEAD_BYTES = 4096


def open_store(folder: str):
    """(file system, path) of a folder or file given as a path or a URI; an unknown scheme raises."""
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        uri = folder if "://" in folder else "file://" + folder[len("file:"):]
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(folder)


def first_mark(path: str, size: int = HEAD_BYTES) -> str:
    """The first character of a text file that is not white space (empty if there is none), read ``size`` bytes at a time.

    A file whose name ends like a compressed one's is decompressed.
    """
    store, name = open_store(path)
    with store.open_input_stream(name) as file:
        while head := file.read(size):
            if text := head.lstrip(b" \t\r\n\xef\xbb\xbf"):
                return chr(text[0])
    return ""


def file_marks(spark: SparkSession, path) -> DataFrame:
    """(file, mark) of every file under ``path``; the mark is null where a task cannot open the store by itself.

    Files are listed by Spark without their content, and a task reads the first
    bytes of its files, so what is read does not grow with their size.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        for batch in batches:
            marks = []
            for name in batch["path"]:
                try:
                    marks.append(first_mark(name))
                except (OSError, pa.ArrowException):
                    marks.append(None)
            yield pd.DataFrame({"file": batch["path"], "mark": pd.Series(marks, dtype=object)})

    return spark.read.format("binaryFile").load(path).select("path").mapInPandas(run, "file string, mark string")


def tasks_can_open(files: DataFrame) -> bool:
    """Whether tasks can open every file of a ``binaryFile`` frame in the store without Spark.

    Each task opens its files and reads one byte of each; only a file that
    cannot be opened gives a row, and one such row ends the search.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        for batch in batches:
            closed = []
            for path in batch["path"]:
                try:
                    store, name = open_store(path)
                    with store.open_input_file(name) as file:
                        file.read(1)
                except (OSError, pa.ArrowException):
                    closed.append(path)
            yield pd.DataFrame({"path": pd.Series(closed, dtype=object)})

    return not files.select("path").mapInPandas(run, "path string").head(1)
