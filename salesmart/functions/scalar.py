"""Scalar helpers shared by the cleaning and enrichment steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day-first date format of the raw orders and the prefix
# of an imputed customer name.
DATE_FORMAT = "d/M/yyyy"
IMPUTED_PREFIX = "IMPUTED_"


def parse_dmy(c: Column) -> Column:
    """Day-first text date to ``date``; malformed text gives null."""
    return F.try_to_date(c.cast("string"), DATE_FORMAT)


def to_double(c: Column) -> Column:
    """Number or numeric text to ``double``; malformed text gives null."""
    return c.try_cast("double")


def round2(c: Column) -> Column:
    """Round half up to two decimals."""
    return F.round(c, 2)


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def impute_name(name: Column, email: Column) -> Column:
    """Keep ``name``; when it is null or blank, use the prefix plus the text
    of ``email`` before ``@`` (just the prefix when the email is null)."""
    local_part = F.regexp_extract(email, r"^([^@]+)", 1)
    return F.when(is_blank(name), F.concat_ws("", F.lit(IMPUTED_PREFIX), local_part)).otherwise(name)
