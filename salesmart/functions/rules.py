"""Data-quality rules as Spark column predicates.

A rule is a code plus a boolean ``Column`` that is true when the row fails.
``issues_of`` turns a rule list into one ``array<string>`` column holding the
codes of the failed rules, in rule order.  A rule whose predicate is null
(for example a regex test on a null value) counts as passed: only
``missing_name`` checks for null explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Issue codes, patterns and the accepted regions.
MISSING_NAME = "missing_name"
INVALID_NAME = "invalid_name"
INVALID_EMAIL = "invalid_email"
INVALID_PHONE = "invalid_phone"
INVALID_POSTAL = "invalid_postal"
INVALID_REGION = "invalid_region"
NEGATIVE_UNIT_PRICE = "negative_unit_price"
INVALID_CUSTOMER_ID = "invalid_customer_id"
INVALID_PRODUCT_ID = "invalid_product_id"

NAME_PATTERN = r"^[\p{L} ]+$"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_PATTERN = r"^(\d{10}|\(\d{3}\)-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|\d{3}-\d{3}-\d{4})$"
POSTAL_PATTERN = r"^\d{5}(-\d{4})?$"
VALID_REGIONS = ("NORTH", "SOUTH", "EAST", "WEST", "CENTRAL")


@dataclass(frozen=True)
class Rule:
    code: str
    fails: Column


def customer_rules(name: Column, email: Column, phone: Column,
                   postal: Column, region: Column) -> list[Rule]:
    """The six customer rules, applied to already trimmed columns."""
    return [
        Rule(MISSING_NAME, name.isNull() | (name == "")),
        Rule(INVALID_NAME, ~name.rlike(NAME_PATTERN)),
        Rule(INVALID_EMAIL, ~email.rlike(EMAIL_PATTERN)),
        Rule(INVALID_PHONE, ~phone.rlike(PHONE_PATTERN)),
        Rule(INVALID_POSTAL, ~postal.rlike(POSTAL_PATTERN)),
        Rule(INVALID_REGION, ~F.upper(region).isin(*VALID_REGIONS)),
    ]


def issues_of(rules: list[Rule]) -> Column:
    """Codes of the failed rules as an array without nulls."""
    return F.array_compact(F.array(*[F.when(r.fails, F.lit(r.code)) for r in rules]))
