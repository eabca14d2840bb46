"""Parquet publishing of the output catalogue: the tables of a run, all or none.

A run writes its tables under ``base/_runs/<run>`` and counts their rows while
it writes them.  ``commit`` then replaces the marker ``base/_runs/current.json``
in one rename; from then on ``read_published`` follows the new run.  Last, the
tables are moved to ``base/<table>``, where any reader finds them; a table that
is not moved yet is read from the run's folder.  A run that fails before its
commit leaves the former tables as they were.  One run at a time may publish to
a base.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUNS = "_runs"
MARKER = "current.json"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def publish(catalog: Mapping[str, DataFrame], base: str, names: Iterable[str] | None = None,
            mode: str = "overwrite", rows: dict[str, int] | None = None) -> dict[str, StructType]:
    """Write the named tables (all by default) to ``base/<name>``; return
    the schema of each table written.

    ``rows`` takes the number of rows of each table, observed by the tasks
    that write it; a task that is run again counts once.
    """
    written = {}
    for name in (names if names is not None else catalog):
        df, seen = catalog[name], None
        if rows is not None:
            seen = Observation()
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        write_parquet(df, f"{base.rstrip('/')}/{name}", mode)
        written[name] = catalog[name].schema
        if seen is not None:
            rows[name] = seen.get["rows"]
    return written


class Store:
    """The file system of a folder, as Spark's own writers reach it."""

    def __init__(self, spark: SparkSession, base: str):
        self._spark, self.base = spark, base.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.base).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def drop(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def folders(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path)) if s.isDirectory()]

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def replace_text(self, path: str, text: str) -> None:
        """``path`` holds ``text``, or what it held before: written aside and renamed over it."""
        aside = self._fs.makeQualified(self._path(f"{path}.{uuid.uuid4().hex[:12]}"))
        out = self._fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        options = self._spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 1)
        options[0] = self._hadoop.Options.Rename.OVERWRITE
        target = self._fs.makeQualified(self._path(path))
        self._hadoop.FileContext.getFileContext(aside.toUri(), self._conf).rename(aside, target, options)


class Run:
    """One run's tables of ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self._store = Store(spark, base)
        self.name = f"run-{uuid.uuid4().hex[:12]}"
        self.folder = f"{self._store.base}/{RUNS}/{self.name}"
        self.rows: dict[str, int] = {}
        self.schemas: dict[str, StructType] = {}

    def write(self, catalog: Mapping[str, DataFrame]) -> None:
        self.schemas.update(publish(catalog, self.folder, rows=self.rows))

    def abort(self) -> None:
        self._store.drop(self.folder)

    def commit(self) -> None:
        """Make the run current, then move its tables to their places and drop what earlier runs left."""
        store = self._store
        tables = [{"table_name": n, "row_count": c} for n, c in self.rows.items()]
        store.replace_text(f"{store.base}/{RUNS}/{MARKER}", json.dumps({"run": self.name, "tables": tables}))
        for name in self.rows:
            store.drop(f"{store.base}/{name}")
            store.move(f"{self.folder}/{name}", f"{store.base}/{name}")
        for left in store.folders(f"{store.base}/{RUNS}"):
            store.drop(f"{store.base}/{RUNS}/{left}")


def _marker(spark: SparkSession, base: str) -> DataFrame:
    return (spark.read.schema("run string, tables array<struct<table_name: string, row_count: bigint>>")
            .json(f"{base.rstrip('/')}/{RUNS}/{MARKER}"))


def published_counts(spark: SparkSession, base: str) -> DataFrame:
    """(table_name, row_count) of the tables published under ``base``, as counted while they were written."""
    return _marker(spark, base).select(F.inline("tables"))


def read_published(spark: SparkSession, base: str, names: Iterable[str],
                   schemas: Mapping[str, StructType] | None = None) -> dict[str, DataFrame]:
    """The named tables of the run that ``base`` shows (of the plain folder
    ``base`` if no run was committed there); a known schema spares the footer
    read that infers it."""
    schemas, base, store = schemas or {}, base.rstrip("/"), Store(spark, base)
    run = _marker(spark, base).first()["run"] if store.exists(f"{base}/{RUNS}/{MARKER}") else None
    out = {}
    for n in names:
        reader = spark.read.schema(schemas[n]) if n in schemas else spark.read
        ahead = f"{base}/{RUNS}/{run}/{n}"
        out[n] = reader.parquet(ahead if run and store.exists(ahead) else f"{base}/{n}")
    return out
