"""The enriched order fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import schemas as S
from salesmart.functions.scalar import parse_dmy, round2, to_double
from salesmart.operators.skew import hot_keys, left_lookup


def _finish(df: DataFrame) -> DataFrame:
    """Rounded profit, order year and the fact's column list (absent optional
    columns skipped)."""
    df = df.withColumns({"ProfitRounded": round2(to_double(F.col(S.PROFIT))),
                         "Year": F.year(F.col("OrderDate"))})
    present = set(df.columns)
    return df.selectExpr(*[S.q(c) for c in S.ENRICHED_COLUMNS if c in present])


def _renamed(orders: DataFrame) -> DataFrame:
    df = orders.withColumnsRenamed({S.CUSTOMER_ID: "CustomerID", S.PRODUCT_ID: "ProductID"})
    if "OrderDate" not in df.columns:
        df = df.withColumn("OrderDate", parse_dmy(F.col(S.ORDER_DATE)))
    return df


def build_orders_enriched(orders: DataFrame, customer_dim: DataFrame, product_dim: DataFrame,
                          hot_share: float | None = None) -> DataFrame:
    """Orders left-joined with both dimensions; orders without a matching
    dimension row are kept with null attributes.

    With ``hot_share`` (e.g. ``skew.DEFAULT_HOT_SHARE``) keys holding more
    than that share of the orders are salted; their count is taken over
    ``orders``, so pass it when ``orders`` is cheap to recompute.  The
    pipeline's default fused path salts both joins with keys counted on the
    raw order lines (``refs.annotate_orders``)."""
    df = _renamed(orders)
    hot_c = hot_p = None
    if hot_share is not None:
        hot_c, hot_p = hot_keys(df, "CustomerID", hot_share), hot_keys(df, "ProductID", hot_share)
    df = left_lookup(df, customer_dim, "CustomerID", hot_c)
    df = left_lookup(df, product_dim, "ProductID", hot_p)
    return _finish(df)


def enriched_from_annotated(annotated: DataFrame) -> DataFrame:
    """The fact from orders that already carry the dimension attributes
    (``refs.annotate_orders``), keeping only the valid ones."""
    return _finish(_renamed(annotated.where(F.size("Issues") == 0)))
