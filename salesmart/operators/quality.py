"""Cleaning of the customer and product tables.

Each step is split in two: ``annotate_*`` does the key check, dedup, typing
and rule evaluation once; the clean and issue tables are then two filters of
that one annotated frame, so a pipeline can persist it and feed both sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import schemas as S
from salesmart.functions.rules import NEGATIVE_UNIT_PRICE, customer_rules, issues_of
from salesmart.functions.scalar import impute_name, to_double
from salesmart.operators.dedup import keep_one_per_key

ISSUES = "Issues"

# Text columns of the customer table that are trimmed and validated.
CUSTOMER_TEXT = (S.CUSTOMER_NAME, S.EMAIL, S.PHONE, S.POSTAL_CODE, S.REGION)


def annotate_customers(df: DataFrame, dedup: str = "aggregate") -> DataFrame:
    """Keyed, de-duplicated, trimmed customers with their ``Issues`` array.

    The id is neither trimmed nor validated; the dedup runs on the raw rows.
    """
    df = keep_one_per_key(df.dropna(subset=[S.CUSTOMER_ID]), [S.CUSTOMER_ID], dedup)
    df = df.withColumns({c: F.expr(f"trim(CAST({S.q(c)} AS STRING))") for c in CUSTOMER_TEXT})
    rules = customer_rules(*[F.col(c) for c in CUSTOMER_TEXT])
    return df.withColumn(ISSUES, issues_of(rules))


def customer_issue_report(annotated: DataFrame) -> DataFrame:
    """Rows with at least one issue, names as read (before imputation)."""
    return (annotated
            .select(F.col(S.CUSTOMER_ID).alias("CustomerID"),
                    F.col(S.CUSTOMER_NAME).alias("CustomerName"),
                    F.col(S.EMAIL).alias("Email"),
                    F.col(S.PHONE).alias("Phone"),
                    F.col(S.POSTAL_CODE).alias("PostalCode"),
                    F.col(S.REGION),
                    F.col(ISSUES))
            .where(F.size(ISSUES) > 0))


def impute_customer_names(annotated: DataFrame) -> DataFrame:
    """All annotated customers, a missing name replaced from the email.

    Customers with issues stay in: they are reported, not removed.
    """
    return annotated.withColumn(S.CUSTOMER_NAME,
                                impute_name(F.col(S.CUSTOMER_NAME), F.col(S.EMAIL)))


def clean_customers(df: DataFrame, dedup: str = "aggregate") -> tuple[DataFrame, DataFrame]:
    annotated = annotate_customers(df, dedup)
    return impute_customer_names(annotated), customer_issue_report(annotated)


def annotate_products(df: DataFrame, dedup: str = "aggregate") -> DataFrame:
    """Keyed, de-duplicated products with the price column named ``UnitPrice``
    and typed as double (malformed text becomes null)."""
    df = keep_one_per_key(df.dropna(subset=[S.PRODUCT_ID]), [S.PRODUCT_ID], dedup)
    price = S.resolve_alias(df.columns, S.PRICE_ALIASES, pick="first")
    if price != S.UNIT_PRICE:
        if S.UNIT_PRICE in df.columns:
            raise ValueError(f"price column {price!r} would clash with the existing "
                             f"{S.UNIT_PRICE!r} column")
        df = df.withColumnRenamed(price, S.UNIT_PRICE)
    return df.withColumn(S.UNIT_PRICE, to_double(F.col(S.UNIT_PRICE)))


def valid_products(annotated: DataFrame) -> DataFrame:
    """Products with a price of zero or more.  A null price is neither valid
    nor reported."""
    return annotated.where(F.col(S.UNIT_PRICE) >= 0)


def product_issue_report(annotated: DataFrame) -> DataFrame:
    return (annotated.where(F.col(S.UNIT_PRICE) < 0)
                     .withColumn(ISSUES, F.array(F.lit(NEGATIVE_UNIT_PRICE))))


def clean_products(df: DataFrame, dedup: str = "aggregate") -> tuple[DataFrame, DataFrame]:
    annotated = annotate_products(df, dedup)
    return valid_products(annotated), product_issue_report(annotated)
