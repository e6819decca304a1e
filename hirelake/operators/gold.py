"""Gold operators: jobs_detail (G1-G6), jobs_summary (G7-G10), salary_analysis
(G11-G12)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.salary import (is_salary_available, salary_avg, salary_range)
from hirelake.operators.selection import exact_quantiles
from hirelake.functions.text import SEARCH_COLUMNS, search_text
from hirelake.schemas import (JOBS_DETAIL_COLUMNS, JOBS_SUMMARY_COLUMNS,
                              SALARY_ANALYSIS_COLUMNS)

CONTRACT_TIME_SHARES = [("FULL_TIME", "pct_full_time"), ("PART_TIME", "pct_part_time"),
                        ("UNKNOWN", "pct_unknown")]


def sketched_median(c) -> Column:
    """The reference's median (``percentile_approx``, accuracy 10000): a fixed-size
    sketch whose element near the middle depends on how the rows are partitioned."""
    return F.percentile_approx(c, 0.5)


def with_median(df: DataFrame, keys: list[str], value: str, exact: bool, *aggs) -> DataFrame:
    """``df`` grouped by ``keys`` with ``aggs`` and ``median_salary``, the lower
    median of ``value`` (an element of the group, not the midpoint).

    ``exact`` selects it by narrowing, the same on any partitioning and with bounded
    memory; it reads ``keys`` and ``value`` once before the aggregate. Medians, a row a
    group, meet the groups of the aggregate, which are as few.
    """
    if not exact:
        return df.groupBy(*keys).agg(sketched_median(value).alias("median_salary"), *aggs)
    medians = exact_quantiles(df, keys, value).select(
        *[F.col(k).alias(f"_m_{k}") for k in keys], F.col(value).alias("median_salary"))
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])
    return df.groupBy(*keys).agg(*aggs).join(medians, same, "left").drop(
        *[f"_m_{k}" for k in keys])


def jobs_detail(silver: DataFrame) -> DataFrame:
    """One row per job with derived salary, date and search fields."""
    return (silver
            .withColumns({
                "salary_avg": salary_avg(),
                "salary_range": salary_range(),
                "is_salary_available": is_salary_available(),
                "posted_date": F.to_date(F.col("posted_at")),
                "job_search_text": search_text(*SEARCH_COLUMNS),
            })
            .select(*JOBS_DETAIL_COLUMNS))


def jobs_summary(silver: DataFrame, exact_median: bool = True) -> DataFrame:
    """Per (ingestion_date, category_label): volume, salary figures and
    contract-time shares. A NULL category is its own group.

    All aggregates combine map-side, so the flat feed's single category (every
    one of its rows) does not land whole in one task.
    """
    row_avg = "_avg_salary_row"
    counts = [F.sum(F.when(F.col("contract_time") == code, 1).otherwise(0)).alias(f"_n_{code}")
              for code, _ in CONTRACT_TIME_SHARES]
    agg = with_median(
        silver.withColumn(row_avg, salary_avg()), ["ingestion_date", "category_label"], row_avg,
        exact_median,
        F.count(F.lit(1)).alias("total_jobs"), F.avg(row_avg).alias("avg_salary"),
        F.min("salary_min").alias("min_salary"), F.max("salary_max").alias("max_salary"), *counts)
    shares = {pct: F.col(f"_n_{code}") / F.col("total_jobs") for code, pct in CONTRACT_TIME_SHARES}
    return agg.withColumns(shares).select(*JOBS_SUMMARY_COLUMNS)


def salary_analysis(silver: DataFrame, exact_median: bool = True,
                    by_date: bool = False) -> DataFrame:
    """Per contract_time, ordered by avg_salary_max descending.

    ``by_date=True`` adds ingestion_date as a key (the reference's table has no
    date, so days cannot be told apart once stored together).
    """
    keys = (["ingestion_date"] if by_date else []) + ["contract_time"]
    out = with_median(
        silver, keys, "salary_max", exact_median, F.count(F.lit(1)).alias("job_count"),
        F.avg("salary_min").alias("avg_salary_min"), F.avg("salary_max").alias("avg_salary_max"),
        F.max("salary_max").alias("max_salary"), F.min("salary_min").alias("min_salary"))
    cols = (["ingestion_date"] if by_date else []) + SALARY_ANALYSIS_COLUMNS
    return out.select(*cols).orderBy(F.desc_nulls_last("avg_salary_max"),
                                     F.asc_nulls_last("contract_time"))
