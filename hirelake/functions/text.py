"""Search text (G5) and keyword matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEARCH_COLUMNS = ["title", "company_name", "category_label", "location_name",
                  "contract_time", "contract_type"]


def search_text(*cols, null_as_empty: bool = False) -> Column:
    """Lower-case text of the columns joined by one space.

    G5 skips NULLs (concat_ws); the dashboard fallback (D14) keeps them as ""
    so a NULL still adds a separator.
    """
    cols = cols or tuple(SEARCH_COLUMNS)
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if null_as_empty:
        parts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.lower(F.concat_ws(" ", *parts))


def keyword_match(text, keyword: str, literal: bool = False) -> Column:
    """Case-insensitive match of a lower-cased keyword; NULL text never matches.

    By default the keyword is a regular expression found anywhere in the text,
    as in the dashboard; ``literal=True`` matches it as plain text.
    """
    text = F.col(text) if isinstance(text, str) else text
    kw = keyword.lower()
    if literal:
        cond = F.lower(text).contains(kw)
    else:
        cond = text.rlike("(?iu)" + kw)
    return F.coalesce(cond, F.lit(False))
