"""Column expressions: validation rules and scalar helpers."""

from salesmart.functions.rules import (
    Rule,
    customer_rules,
    issues_of,
    VALID_REGIONS,
)
from salesmart.functions.scalar import impute_name, parse_dmy, round2, to_double

__all__ = [
    "Rule",
    "customer_rules",
    "issues_of",
    "VALID_REGIONS",
    "impute_name",
    "parse_dmy",
    "round2",
    "to_double",
]
