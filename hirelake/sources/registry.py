"""Source registry (S7): one spec per feed drives reading, paging and mapping."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from hirelake.operators.normalize import (FLAT_SOURCE, NESTED_SOURCE, normalize_flat,
                                          normalize_nested)
from hirelake.schemas import FLAT_RECORD, NESTED_RECORD, envelope


@dataclass(frozen=True)
class SourceSpec:
    name: str
    record_schema: StructType
    page_array: str            # name of the result array in one API page
    normalizer: Callable[[DataFrame, str], DataFrame]
    country_tag: bool = False  # add `_source_country` to each record (S5)

    @property
    def envelope_schema(self) -> StructType:
        return envelope(self.record_schema)


# Fixed values that must equal the reference's: the array each API page holds.
SOURCES: dict[str, SourceSpec] = {
    NESTED_SOURCE: SourceSpec(NESTED_SOURCE, NESTED_RECORD, "results", normalize_nested,
                              country_tag=True),
    FLAT_SOURCE: SourceSpec(FLAT_SOURCE, FLAT_RECORD, "jobs", normalize_flat),
}


def source_spec(name: str) -> SourceSpec:
    if name not in SOURCES:
        raise ValueError(f"Unknown source: {name}. Available: {list(SOURCES)}")
    return SOURCES[name]


def flatten_source_pages(pages: DataFrame, source: str, max_pages: int | None = None,
                         country: str = "country", page: str = "page") -> DataFrame:
    """S4/S5 for a registered feed: its page array, and the country tag when
    the feed has one."""
    from hirelake.operators.batches import flatten_pages
    spec = source_spec(source)
    return flatten_pages(pages, spec.page_array, max_pages=max_pages,
                         country_tag=spec.country_tag, country=country, page=page)
