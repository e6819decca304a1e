"""Hashed entity keys (N12): SHA-256 hex, NULL parts as empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CATEGORY_KEY_SEPARATOR = "||"


def _text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def entity_key(c) -> Column:
    return F.sha2(_text(c), 256)


def category_key(label="category_label", tag="category_tag") -> Column:
    return F.sha2(F.concat_ws(CATEGORY_KEY_SEPARATOR, _text(label), _text(tag)), 256)
