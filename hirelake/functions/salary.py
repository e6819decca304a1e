"""Salary expressions: text parser (N4), scaling (N11), Gold salary fields."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# a number with an optional fraction, optional spaces, then an optional "k"
# that multiplies by 1000. Text is lower-cased and commas are dropped first.
# (?U) makes \s match Unicode spaces such as NBSP, as Python's re does.
SALARY_NUMBER_PATTERN = r"(?U)(\d+(?:\.\d+)?)\s*(k)?"
THOUSANDS_SUFFIX = "k"
SALARY_SCALE_BELOW = 1000
SALARY_SCALE_FACTOR = 1000
NOT_AVAILABLE = "Not available"

# Decimal digits of every script and the ASCII digits of the same values.
OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1))
                       if unicodedata.category(c) == "Nd")
SAME_DIGITS = "".join(str(unicodedata.decimal(c)) for c in OTHER_DIGITS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def salary_numbers(text) -> Column:
    """Every number in the text, "k" applied, in order of appearance.

    Digits of other scripts count by their values; only texts that are not ASCII
    are translated.
    """
    lowered = F.regexp_replace(F.lower(_col(text)), ",", "")
    cleaned = F.when(lowered.rlike(r"[^\x00-\x7F]"),
                     F.translate(lowered, OTHER_DIGITS, SAME_DIGITS)).otherwise(lowered)
    numbers = F.regexp_extract_all(cleaned, F.lit(SALARY_NUMBER_PATTERN), 1)
    suffixes = F.regexp_extract_all(cleaned, F.lit(SALARY_NUMBER_PATTERN), 2)
    return F.zip_with(
        numbers, suffixes,
        lambda n, k: n.try_cast("double")
        * F.when(k == THOUSANDS_SUFFIX, F.lit(1000.0)).otherwise(F.lit(1.0)))


def parse_salary_text(text) -> Column:
    """struct(min double, max double) over all numbers of a salary text.

    No number (or empty/NULL text) gives (NULL, NULL); one number n gives (n, n).
    Native replacement of a row-at-a-time Python UDF: stays in codegen.
    """
    values = salary_numbers(text)
    return F.struct(F.array_min(values).alias("min"), F.array_max(values).alias("max"))


def scale_salary(c) -> Column:
    """Values below 1000 are taken as thousands; NULL stays NULL."""
    c = _col(c)
    return F.when(c < SALARY_SCALE_BELOW, c * SALARY_SCALE_FACTOR).otherwise(c)


def salary_avg(lo="salary_min", hi="salary_max") -> Column:
    """G1: midpoint of the range; NULL unless both ends are present."""
    return (_col(lo) + _col(hi)) / 2


def is_salary_available(lo="salary_min", hi="salary_max") -> Column:
    """Both ends present."""
    return _col(lo).isNotNull() & _col(hi).isNotNull()


def salary_range(lo="salary_min", hi="salary_max") -> Column:
    """G2: "min - max" by cast to text, else "Not available"."""
    return (F.when(is_salary_available(lo, hi),
                   F.concat_ws(" - ", _col(lo).cast("string"), _col(hi).cast("string")))
            .otherwise(F.lit(NOT_AVAILABLE)))
