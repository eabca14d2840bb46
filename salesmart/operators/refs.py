"""Order cleaning: key check, dedup, date parsing and referential checks.

The referential check is a left join of the orders with each parent's key
set carrying a marker column; a null marker means the parent is missing.
One annotated frame thus yields both the valid orders (semi-join) and the
reported ones (anti-join) without collecting id lists to the driver.

Such a join moves every order once per parent.  ``clean_orders`` therefore
first finds the ids in the orders that a parent lacks, from the two id columns
alone, and broadcasts them if they are at most ``MISSING_IDS`` per parent; the
orders then stay where they are.  More are joined as above.

``annotate_orders`` is the fused form used by the pipeline: the parents are
the two dimensions, and the same joins also carry the dimension attributes
the enriched fact needs, so the fact costs no further join.  Both forms are
exact because the parent keys are unique after cleaning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from salesmart import schemas as S
from salesmart.functions.rules import (
    INVALID_CUSTOMER_ID,
    INVALID_PRODUCT_ID,
    Rule,
    issues_of,
)
from salesmart.functions.scalar import parse_dmy
from salesmart.operators.dedup import keep_one_per_key
from salesmart.operators.skew import hot_keys_of_columns, left_lookup
from salesmart.session import shared_dir

ISSUES = "Issues"
_CUST_OK = "__customer_found"
_PROD_OK = "__product_found"
_MISSING = "__no_parent"

DEFAULT_ORDER_KEY = (S.ORDER_ID,)
# Ids without a parent that are broadcast, per parent; about 100 bytes each in memory.
MISSING_IDS = 1_500_000


def prepare_orders(orders: DataFrame, order_key: Sequence[str] | None = DEFAULT_ORDER_KEY,
                   dedup: str = "aggregate") -> DataFrame:
    """Drop orders missing a required column (null or NaN), keep one row per
    ``order_key`` (``None`` keeps every line) and parse both dates."""
    df = orders.dropna(subset=list(S.ORDER_REQUIRED))
    if order_key:
        df = keep_one_per_key(df, order_key, dedup)
    ship = parse_dmy(F.col(S.SHIP_DATE)) if S.SHIP_DATE in df.columns else F.lit(None).cast("date")
    return df.withColumns({"OrderDate": parse_dmy(F.col(S.ORDER_DATE)), "ShipDate": ship})


def _lookup(df: DataFrame, parent: DataFrame, key: str, parent_key: str, marker: str,
            carry: Sequence[str] = (), hot: DataFrame | None = None,
            rebalance: bool = True) -> DataFrame:
    """Left join ``df`` with the parent's ``parent_key`` (plus ``carry``
    columns) and a marker that is null where no parent row matched.  Keys
    listed in ``hot`` are salted (``skew.left_lookup``)."""
    side = parent.select(F.col(parent_key).alias(key), *[F.col(c) for c in carry],
                         F.lit(True).alias(marker))
    if not carry:
        side = side.distinct()
    return left_lookup(df, side, key, hot, rebalance=rebalance)


def _hot(orders: DataFrame, hot_share: float | None) -> tuple[DataFrame | None, DataFrame | None]:
    """Hot customer and product ids, counted in one pass over the raw order
    lines: only the two key columns are read and the dedup is not re-run.
    Line counts stand in for order counts; any hot set gives the same join
    result, and the bound on its size holds."""
    if hot_share is None:
        return None, None
    hot = hot_keys_of_columns(orders, [S.CUSTOMER_ID, S.PRODUCT_ID], hot_share)
    return hot[S.CUSTOMER_ID], hot[S.PRODUCT_ID]


def _missing_ids(orders: DataFrame, parents: dict[str, DataFrame], most: int) -> dict[str, DataFrame]:
    """By id column, the ids in ``orders`` that its parent lacks, if they are at most ``most``.

    One pass over the id columns of all order lines finds them; they are written
    to the shared folder, which also counts them.  Ids must be text on both sides.
    """
    keys = [k for k, p in parents.items()
            if all(isinstance(df.schema[k].dataType, StringType) for df in (orders, p))]
    if not keys or not most:
        return {}
    tagged = [F.struct(F.lit(i).alias("side"), F.col(S.q(k)).alias("id")) for i, k in enumerate(keys)]
    used = orders.select(F.inline(F.array(*tagged))).where(F.col("id").isNotNull()).distinct()
    known = [parents[k].select(F.lit(i).alias("side"), F.col(S.q(k)).alias("id")) for i, k in enumerate(keys)]
    missing = used.join(reduce(DataFrame.unionAll, known), on=["side", "id"], how="left_anti")
    folder = shared_dir(orders.sparkSession, "missing-ids")
    missing.write.parquet(folder)
    found = orders.sparkSession.read.schema("side int, id string").parquet(folder)
    counts = {r["side"]: r["count"] for r in found.groupBy("side").count().collect()}
    return {k: found.where(F.col("side") == i).select(F.col("id").alias(k))
            for i, k in enumerate(keys) if counts.get(i, 0) <= most}


def _mark_found(df: DataFrame, missing: DataFrame, key: str, marker: str) -> DataFrame:
    """``df`` with the marker of ``_lookup``, from the ids without a parent; ``df`` is not shuffled."""
    side = F.broadcast(missing.withColumn(_MISSING, F.lit(True)))
    found = F.when(F.col(_MISSING).isNull() & F.col(S.q(key)).isNotNull(), True)
    return df.join(side, on=key, how="left").withColumn(marker, found).drop(_MISSING)


def _with_ref_issues(df: DataFrame) -> DataFrame:
    rules = [Rule(INVALID_CUSTOMER_ID, F.col(_CUST_OK).isNull()),
             Rule(INVALID_PRODUCT_ID, F.col(_PROD_OK).isNull())]
    return df.withColumn(ISSUES, issues_of(rules)).drop(_CUST_OK, _PROD_OK)


def order_issue_report(annotated: DataFrame) -> DataFrame:
    return (annotated
            .select(F.col(S.ORDER_ID).alias("OrderID"),
                    F.col(S.CUSTOMER_ID).alias("CustomerID"),
                    F.col(S.PRODUCT_ID).alias("ProductID"),
                    F.col("OrderDate"), F.col("ShipDate"), F.col(ISSUES))
            .where(F.size(ISSUES) > 0))


def valid_orders(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.size(ISSUES) == 0)


def clean_orders(orders: DataFrame, customers: DataFrame, products: DataFrame,
                 order_key: Sequence[str] | None = DEFAULT_ORDER_KEY,
                 dedup: str = "aggregate",
                 hot_share: float | None = None,
                 missing_ids: int = MISSING_IDS) -> tuple[DataFrame, DataFrame]:
    """(valid orders, issue report).  ``customers`` and ``products`` are the
    cleaned tables; an order is valid when both of its parents exist.
    ``hot_share`` salts keys holding more than that share of the orders
    (``skew.left_lookup``).  By default a job finds the ids without a parent at
    once, and up to ``missing_ids`` of them per parent are broadcast; with more
    (or 0) the orders are joined with the parent, and AQE splits skewed
    partitions.  ``orders`` is read twice and must give the same rows."""
    df = prepare_orders(orders, order_key, dedup)
    cols = df.columns
    sides = [(S.CUSTOMER_ID, customers, _CUST_OK), (S.PRODUCT_ID, products, _PROD_OK)]
    missing = {} if hot_share is not None else _missing_ids(orders, {k: p for k, p, _ in sides}, missing_ids)
    for (key, parent, marker), hot in zip(sides, _hot(orders, hot_share)):
        if key in missing:
            df = _mark_found(df, missing[key], key, marker)
        else:
            df = _lookup(df, parent, key, key, marker, hot=hot)
    annotated = _with_ref_issues(df.select(*cols, _CUST_OK, _PROD_OK))
    return valid_orders(annotated), order_issue_report(annotated)


def annotate_orders(orders: DataFrame, customer_dim: DataFrame, product_dim: DataFrame,
                    order_key: Sequence[str] | None = DEFAULT_ORDER_KEY,
                    dedup: str = "aggregate",
                    hot_share: float | None = None,
                    rebalance_dims: bool = True) -> DataFrame:
    """Prepared orders with ``Issues`` and the dimension attributes, from one
    left join per dimension (keys ``CustomerID`` / ``ProductID``).
    ``rebalance_dims=False`` skips the rebalance of the dimension side, for
    dimensions read from files (see ``skew.left_lookup``)."""
    df = prepare_orders(orders, order_key, dedup)
    cols = df.columns
    cust_attrs = [c for c in customer_dim.columns if c != "CustomerID"]
    prod_attrs = [c for c in product_dim.columns if c != "ProductID"]
    hot_c, hot_p = _hot(orders, hot_share)
    df = _lookup(df, customer_dim, S.CUSTOMER_ID, "CustomerID", _CUST_OK, cust_attrs, hot_c,
                 rebalance_dims)
    df = _lookup(df, product_dim, S.PRODUCT_ID, "ProductID", _PROD_OK, prod_attrs, hot_p,
                 rebalance_dims)
    return _with_ref_issues(df.select(*cols, *cust_attrs, *prod_attrs, _CUST_OK, _PROD_OK))
