"""Customer and product dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import schemas as S


def build_customer_dim(customers: DataFrame) -> DataFrame:
    """CustomerID, CustomerName, Country; each found through its alias set,
    the last matching column winning."""
    cols = customers.columns
    return customers.select(
        F.col(S.resolve_alias(cols, S.CUSTOMER_ID_ALIASES, pick="last")).alias("CustomerID"),
        F.col(S.resolve_alias(cols, S.CUSTOMER_NAME_ALIASES, pick="last")).alias("CustomerName"),
        F.col(S.resolve_alias(cols, S.COUNTRY_ALIASES, pick="last")).alias("Country"),
    )


def build_product_dim(products: DataFrame) -> DataFrame:
    return products.select(F.col(S.PRODUCT_ID).alias("ProductID"),
                           F.col(S.CATEGORY),
                           F.col(S.SUB_CATEGORY).alias("SubCategory"))
