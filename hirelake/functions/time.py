"""Timestamps of the feeds (H1) and run-date forms."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_created(c) -> Column:
    """Nested feed `created`: epoch seconds or ISO text; bad input gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c.rlike(r"^-?[0-9]+$"), F.timestamp_seconds(c.try_cast("long")))
            .otherwise(c.try_cast("timestamp")))


def parse_updated(c) -> Column:
    """Flat feed `updated`: ISO text; bad input gives NULL instead of failing."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c)


def to_dt(date_text: str) -> str:
    """Run date as `YYYY-MM-DD` (partition value); accepts `YYYY/MM/DD` too."""
    return _dt.date.fromisoformat(date_text.replace("/", "-")).isoformat()


def to_date_path(date_text: str) -> str:
    """`YYYY-MM-DD` -> `YYYY/MM/DD`, the form stored in `ingestion_date`."""
    return to_dt(date_text).replace("-", "/")
