"""Contract fields: classifiers for free text (N5, N6) and standard codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: (substring, code), first match wins.
CONTRACT_TIME_RULES = [("full", "FULL_TIME"), ("part", "PART_TIME")]
CONTRACT_TYPE_RULES = [("contract", "CONTRACT"), ("permanent", "PERMANENT"),
                       ("temporary", "TEMPORARY")]
UNKNOWN = "UNKNOWN"
CONTRACT_TIME_DOMAIN = ["FULL_TIME", "PART_TIME", "UNKNOWN"]
CONTRACT_TYPE_DOMAIN = ["CONTRACT", "UNKNOWN", "PERMANENT", "TEMPORARY"]


def _classify(text, rules) -> Column:
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    expr = None
    for needle, code in rules:
        cond = lowered.contains(needle)
        expr = F.when(cond, code) if expr is None else expr.when(cond, code)
    return expr.otherwise(F.lit(None).cast("string"))


def classify_contract_time(text) -> Column:
    """FULL_TIME / PART_TIME / NULL from free text."""
    return _classify(text, CONTRACT_TIME_RULES)


def classify_contract_type(text) -> Column:
    """CONTRACT / PERMANENT / TEMPORARY / NULL from free text."""
    return _classify(text, CONTRACT_TYPE_RULES)


def standardize_code(c) -> Column:
    """NULL -> UNKNOWN, else upper(trim(x)). trim strips spaces only."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.upper(F.trim(c)), F.lit(UNKNOWN))
