"""Gold aggregates kept up to date (G7, G11): states by Silver bucket.

A state is an aggregate by bucket, group and value: how many jobs, their sums and
extremes. The states of all buckets add up to ``jobs_summary`` and ``salary_analysis``,
medians included, as the values are still apart. When a batch replaces Silver buckets
only the states of these are built anew (``plans/pipeline.py: fresh_states``), so a copy
that was replaced is taken back with its bucket, and extremes and medians stay exact.

Means are sums over values divided by counts; they may differ from one aggregate over
all rows in their last bits.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.salary import salary_avg
from hirelake.operators.gold import CONTRACT_TIME_SHARES
from hirelake.operators.selection import exact_quantiles
from hirelake.schemas import JOBS_SUMMARY_COLUMNS, SALARY_ANALYSIS_COLUMNS

SUMMARY_KEYS = ["ingestion_date", "category_label"]
SALARY_KEYS = ["contract_time"]


def summary_state(silver: DataFrame) -> DataFrame:
    """``jobs_summary``'s state of Silver rows with their ``bucket``."""
    return silver.groupBy("bucket", *SUMMARY_KEYS, salary_avg().alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.min("salary_min").alias("low"), F.max("salary_max").alias("high"),
        *[F.count_if(F.col("contract_time") == code).alias(pct) for code, pct in CONTRACT_TIME_SHARES])


def salary_state(silver: DataFrame) -> DataFrame:
    """``salary_analysis``'s state of Silver rows with their ``bucket``."""
    return silver.groupBy("bucket", *SALARY_KEYS, F.col("salary_max").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.min("salary_min").alias("low"),
        F.count("salary_min").alias("n_low"), F.sum("salary_min").alias("sum_low"))


def _with_median(state: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    medians = exact_quantiles(state, keys, "value", weight="n").select(
        *[F.col(k).alias(f"_m_{k}") for k in keys], F.col("value").alias("median_salary"))
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])
    return state.groupBy(*keys).agg(*aggs).join(medians, same, "left")


def _mean() -> Column:
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    return F.sum(F.col("value") * F.col("n")) / F.sum(known)


def summary_of(state: DataFrame) -> DataFrame:
    """``jobs_summary`` from the states of all buckets."""
    out = _with_median(
        state, SUMMARY_KEYS, F.sum("n").alias("total_jobs"), _mean().alias("avg_salary"),
        F.min("low").alias("min_salary"), F.max("high").alias("max_salary"),
        *[(F.sum(pct) / F.sum("n")).alias(pct) for _, pct in CONTRACT_TIME_SHARES])
    return out.select(*JOBS_SUMMARY_COLUMNS)


def salary_of(state: DataFrame) -> DataFrame:
    """``salary_analysis`` from the states of all buckets."""
    out = _with_median(
        state, SALARY_KEYS, F.sum("n").alias("job_count"),
        (F.sum("sum_low") / F.sum("n_low")).alias("avg_salary_min"), _mean().alias("avg_salary_max"),
        F.max("value").alias("max_salary"), F.min("low").alias("min_salary"))
    return out.select(*SALARY_ANALYSIS_COLUMNS)
