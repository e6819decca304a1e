"""Per-feed normalizers (N2, N3) to the common job row, and dispatch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions.contract import classify_contract_time, classify_contract_type
from hirelake.functions.salary import parse_salary_text
from hirelake.functions.time import parse_created, parse_updated
from hirelake.schemas import LINEAGE_COLUMNS

# Fixed values that must equal the reference's: feed names (they prefix every
# job_id and fill `source`) and the category given to the flat feed.
NESTED_SOURCE = "adzuna"
FLAT_SOURCE = "jooble"
FLAT_CATEGORY = "Uncategorized"


def _lineage(df: DataFrame) -> list:
    return [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in LINEAGE_COLUMNS]


def normalize_nested(jobs: DataFrame, ingestion_date: str,
                     source: str = NESTED_SOURCE) -> DataFrame:
    """Nested record in column ``job`` -> common row (+ lineage columns)."""
    j = lambda path: F.col(f"job.{path}")
    return jobs.select(
        F.concat(F.lit(f"{source}_"), j("id")).alias("job_id"),
        j("title").alias("title"),
        j("company.display_name").alias("company_name"),
        j("location.display_name").alias("location_name"),
        j("salary_min").cast("double").alias("salary_min"),
        j("salary_max").cast("double").alias("salary_max"),
        (j("salary_is_predicted") == "1").alias("salary_is_predicted"),
        j("contract_time").alias("contract_time"),
        j("contract_type").alias("contract_type"),
        j("category.label").alias("category_label"),
        j("category.tag").alias("category_tag"),
        j("latitude").cast("double").alias("latitude"),
        j("longitude").cast("double").alias("longitude"),
        j("redirect_url").alias("job_url"),
        parse_created(j("created")).alias("posted_at"),
        F.lit(source).alias("source"),
        F.lit(ingestion_date).alias("ingestion_date"),
        *_lineage(jobs),
    )


def normalize_flat(jobs: DataFrame, ingestion_date: str,
                   source: str = FLAT_SOURCE) -> DataFrame:
    """Flat record in column ``job`` -> common row (+ lineage columns).

    Salary text is parsed natively (N4); contract fields are classified from
    the free-text ``type`` (N5, N6).
    """
    j = lambda path: F.col(f"job.{path}")
    salary = parse_salary_text(j("salary"))
    return jobs.select(
        F.concat(F.lit(f"{source}_"), j("id").cast("string")).alias("job_id"),
        j("title").alias("title"),
        j("company").alias("company_name"),
        j("location").alias("location_name"),
        salary.getField("min").alias("salary_min"),
        salary.getField("max").alias("salary_max"),
        F.lit(None).cast("boolean").alias("salary_is_predicted"),
        classify_contract_time(j("type")).alias("contract_time"),
        classify_contract_type(j("type")).alias("contract_type"),
        F.lit(FLAT_CATEGORY).alias("category_label"),
        F.lit(None).cast("string").alias("category_tag"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        j("link").alias("job_url"),
        parse_updated(j("updated")).alias("posted_at"),
        F.lit(source).alias("source"),
        F.lit(ingestion_date).alias("ingestion_date"),
        *_lineage(jobs),
    )
