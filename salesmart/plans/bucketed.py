"""Orders and dimensions stored bucketed on their keys, for checks that run again and again.

``store_orders`` keeps the prepared orders twice in a folder: all columns
bucketed on the customer id, and the columns of the issue report bucketed on
the product id.  ``store_dimension`` writes a dimension into as many buckets.
Checks against newly written dimensions then move no order: each copy meets
its dimension bucket by bucket, and only the reported lines are shuffled, to
put both findings of a line together.  A row lies in one layout only, so the
fact, which needs the attributes of both dimensions, moves the orders once (to
the products) instead of twice.

One customer or product may hold a third of all orders.  Such keys (more than
``hot_share`` of the lines, so at most ``1 / hot_share`` of them; the lists are
stored with the orders) and lines without a key are salted as in
``operators.skew``, and the buckets are those of (key, salt).

The folder lies in the shared store.  Bucketing is known to Spark's catalogue
only, so a reader in any session enters the files there under a fresh name
(``BucketedOrders.close`` takes the names out again; the files stay).  The
layout is written last: a folder without it is not a finished store.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salesmart import schemas as S
from salesmart.functions.rules import INVALID_CUSTOMER_ID, INVALID_PRODUCT_ID
from salesmart.operators.facts import enriched_from_annotated
from salesmart.operators.refs import DEFAULT_ORDER_KEY, ISSUES, order_issue_report, prepare_orders
from salesmart.operators.skew import DEFAULT_HOT_SHARE, SALT, hot_keys_of_columns, left_lookup, salted_rows, salted_side

LINE = "__line"
_FOUND = "__found"
#: Per side: the orders' key, the dimension's key, the code of a missing parent.
SIDES = {"customers": (S.CUSTOMER_ID, "CustomerID", INVALID_CUSTOMER_ID),
         "products": (S.PRODUCT_ID, "ProductID", INVALID_PRODUCT_ID)}
REPORTED = (S.ORDER_ID, S.CUSTOMER_ID, S.PRODUCT_ID, "OrderDate", "ShipDate")


def _fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _write(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """``df`` in ``buckets`` files, one for each bucket of (key, salt), sorted."""
    name = _fresh("bucketed_write")
    (df.repartition(buckets, F.col(S.q(key)), SALT).write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, key, SALT).sortBy(key, SALT).saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE {name}")


def store_orders(spark: SparkSession, orders: DataFrame, folder: str,
                 order_key: Sequence[str] | None = DEFAULT_ORDER_KEY, dedup: str = "aggregate",
                 buckets: int | None = None, hot_share: float = DEFAULT_HOT_SHARE) -> "BucketedOrders":
    """Prepare the raw ``orders`` and store them in the new ``folder``; ``buckets`` is by default
    the session's number of shuffle partitions."""
    folder = folder.rstrip("/")
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prepared = prepare_orders(orders, order_key, dedup).withColumn(LINE, F.monotonically_increasing_id())
    prepared.write.parquet(f"{folder}/lines")  # both copies have the line numbers written here
    lines = spark.read.schema(prepared.schema).parquet(f"{folder}/lines")
    found = hot_keys_of_columns(lines, [key for key, _, _ in SIDES.values()], hot_share)
    schemas = {}
    for side, (key, _, _) in SIDES.items():
        found[key].write.parquet(f"{folder}/hot-{side}")
        hot = spark.read.schema(found[key].schema).parquet(f"{folder}/hot-{side}")
        kept = lines if side == "customers" else lines.select(LINE, *REPORTED)
        salted = salted_rows(kept, key, hot, buckets)
        schemas[side] = F.lit(salted.schema.json()).alias(side)  # an empty copy has no file to tell it
        _write(salted, f"{folder}/orders-{side}", key, buckets)
    spark.range(1).select(F.lit(buckets).alias("buckets"), *schemas.values()).coalesce(1).write.parquet(f"{folder}/layout")
    return BucketedOrders(spark, folder)


class BucketedOrders:
    """The orders that ``store_orders`` wrote to ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        layout = spark.read.parquet(f"{self.folder}/layout").first()
        self.buckets = layout["buckets"]
        self._schemas = {side: StructType.fromJson(json.loads(layout[side])) for side in SIDES}
        self._names: list[str] = []

    def _open(self, path: str, key: str, schema: StructType) -> DataFrame:
        name = _fresh("bucketed_orders")
        columns = ", ".join(f"{S.q(f.name)} {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({S.q(key)}, {SALT}) "
                       f"SORTED BY ({S.q(key)}, {SALT}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        self._names.append(name)
        return self.spark.table(name)

    def close(self) -> None:
        """Take the tables out of the catalogue; frames that read them are not to be used afterwards."""
        for name in self._names:
            self.spark.sql(f"DROP TABLE {name}")
        self._names.clear()

    def orders(self, side: str) -> DataFrame:
        """The copy bucketed on the key of ``side`` ("customers": all columns)."""
        return self._open(f"{self.folder}/orders-{side}", SIDES[side][0], self._schemas[side])

    def store_dimension(self, side: str, dim: DataFrame) -> DataFrame:
        """Write ``dim`` (one row per key) bucketed like the orders' copy, each time to a place of its own."""
        key, dim_key, _ = SIDES[side]
        hot = self.spark.read.parquet(f"{self.folder}/hot-{side}").withColumnRenamed(key, dim_key)
        salted = salted_side(dim, dim_key, hot, self.buckets)
        path = f"{self.folder}/{_fresh(f'dim-{side}')}"
        _write(salted, path, dim_key, self.buckets)
        return self._open(path, dim_key, salted.schema)

    def _looked_up(self, side: str, dim: DataFrame, *carry: str) -> DataFrame:
        key, dim_key, _ = SIDES[side]
        parents = dim.select(F.col(dim_key).alias(key), SALT, *carry, F.lit(True).alias(_FOUND))
        return self.orders(side).join(parents, on=[key, SALT], how="left").drop(SALT)

    def issues(self, customers: DataFrame, products: DataFrame) -> DataFrame:
        """The issue report (``refs.order_issue_report``) against dimensions written by ``store_dimension``.

        No order is shuffled: each copy keeps its lines without a parent, and
        those alone are grouped by their line.
        """
        missing = []
        for side, dim in (("customers", customers), ("products", products)):
            lines = self._looked_up(side, dim).where(F.col(_FOUND).isNull())
            missing.append(lines.select(LINE, *REPORTED, F.lit(SIDES[side][2]).alias("code")))
        codes = [F.max(F.when(F.col("code") == code, code)) for _, _, code in SIDES.values()]
        found = (missing[0].unionByName(missing[1]).groupBy(LINE, *REPORTED)
                 .agg(F.array_compact(F.array(*codes)).alias(ISSUES)))
        return order_issue_report(found)

    def enriched(self, customers: DataFrame, products: DataFrame) -> DataFrame:
        """The fact of the valid orders (``facts.enriched_from_annotated``): the customers meet the orders where they lie."""
        attributes = [c for c in customers.columns if c not in ("CustomerID", SALT)]
        known = self._looked_up("customers", customers, *attributes).where(F.col(_FOUND)).drop(_FOUND, LINE)
        # A hot key of the stored products has every salt; one row of each is enough here.
        plain = (products.where(F.col(SALT) == 0).drop(SALT).withColumnRenamed("ProductID", S.PRODUCT_ID)
                 .withColumn(_FOUND, F.lit(True)))
        both = left_lookup(known, plain, S.PRODUCT_ID, rebalance=True).where(F.col(_FOUND)).drop(_FOUND)
        return enriched_from_annotated(both.withColumn(ISSUES, F.array().cast("array<string>")))
