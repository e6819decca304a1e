"""Explicit schemas for every layer.

Bronze is read with a fixed schema per source: inference costs a full extra pass
over the raw JSON and drifts between batches (an all-NULL column or a number
that arrives as text once is enough).
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType,
                               StringType, StructField, StructType, TimestampType)


def _s(name, dtype=None):
    return StructField(name, dtype or StringType(), True)


# A2: one record of the nested feed. `created` is kept as text: it arrives as an
# ISO string from the API and as epoch seconds in older batches.
NESTED_RECORD = StructType([
    _s("id"),
    _s("title"),
    _s("description"),
    StructField("category", StructType([_s("label"), _s("tag")]), True),
    StructField("company", StructType([_s("display_name")]), True),
    StructField("location", StructType([_s("display_name"),
                                        StructField("area", ArrayType(StringType()), True)]), True),
    _s("contract_time"),
    _s("contract_type"),
    _s("created"),
    _s("salary_is_predicted"),
    _s("salary_min", DoubleType()),
    _s("salary_max", DoubleType()),
    _s("latitude", DoubleType()),
    _s("longitude", DoubleType()),
    _s("redirect_url"),
    _s("_source_country"),
])

# A3: one record of the flat feed. `id` is text so numeric and string ids both load.
FLAT_RECORD = StructType([
    _s("id"),
    _s("title"),
    _s("company"),
    _s("location"),
    _s("salary"),
    _s("type"),
    _s("link"),
    _s("updated"),
    _s("snippet"),
    _s("source"),
])


def envelope(record: StructType) -> StructType:
    """A1: the Bronze batch envelope around an array of records."""
    return StructType([
        _s("batch_id"),
        _s("source"),
        _s("ingested_at"),
        _s("record_count", LongType()),
        StructField("records", ArrayType(record), True),
    ])


REQUIRED_ENVELOPE_KEYS = ("records", "batch_id", "source", "ingested_at")

# A5: the common job row every normalizer yields, in this order.
COMMON = StructType([
    _s("job_id"),
    _s("title"),
    _s("company_name"),
    _s("location_name"),
    _s("salary_min", DoubleType()),
    _s("salary_max", DoubleType()),
    _s("salary_is_predicted", BooleanType()),
    _s("contract_time"),
    _s("contract_type"),
    _s("category_label"),
    _s("category_tag"),
    _s("latitude", DoubleType()),
    _s("longitude", DoubleType()),
    _s("job_url"),
    _s("posted_at", TimestampType()),
    _s("source"),
    _s("ingestion_date"),
])
COMMON_COLUMNS = [f.name for f in COMMON.fields]

# Envelope columns carried through explode so that deduplication can pick the
# latest copy of a job deterministically.
LINEAGE_COLUMNS = ["batch_id", "ingested_at"]

# Silver = common row + hashed entity keys.
SILVER_COLUMNS = COMMON_COLUMNS + ["category_id", "company_id", "location_id"]

# Gold jobs_detail, fixed order.
JOBS_DETAIL_COLUMNS = [
    "job_id", "title", "company_name", "category_label", "location_name",
    "contract_time", "contract_type", "posted_at", "posted_date",
    "salary_min", "salary_max", "salary_avg", "salary_range",
    "salary_is_predicted", "is_salary_available", "latitude", "longitude",
    "category_tag", "category_id", "company_id", "location_id", "job_url",
    "source", "job_search_text", "ingestion_date",
]

# Gold jobs_summary.
JOBS_SUMMARY_COLUMNS = [
    "ingestion_date", "category_label", "total_jobs", "avg_salary", "min_salary",
    "max_salary", "median_salary", "pct_full_time", "pct_part_time", "pct_unknown",
]

# Gold salary_analysis.
SALARY_ANALYSIS_COLUMNS = [
    "contract_time", "job_count", "avg_salary_min", "avg_salary_max",
    "median_salary", "max_salary", "min_salary",
]
