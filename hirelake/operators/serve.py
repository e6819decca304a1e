"""Serving analytics over the Gold tables (D1-D27), as lazy DataFrame functions
(a default facet filter runs one ``take(1)`` probe when it is built).

The dashboard's pandas rules are kept: group keys drop NULL, sums and means
skip NULL, sorts put NULL last in both directions, ``between`` includes both
ends and drops NULL, ``isin`` drops NULL. Ties of a top-n get a unique last
sort key so that results are deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.functions.salary import NOT_AVAILABLE
from hirelake.functions.text import SEARCH_COLUMNS, keyword_match, search_text
from hirelake.functions.time import to_dt
from hirelake.operators.gold import CONTRACT_TIME_SHARES

# Fixed values that must equal the reference's: card defaults for absent
# columns, the explorer table columns, the salary table columns, sort names.
CARD_DEFAULTS = {
    "title": "Unknown title",
    "company_name": "Unknown company",
    "location_name": "Unknown location",
    "category_label": "Unknown category",
    "contract_time": "UNKNOWN",
    "contract_type": "UNKNOWN",
    "posted_date": "Unknown",
    "salary_range": NOT_AVAILABLE,
    "source": None,
}
JOB_TABLE_COLUMNS = ["job_id", "title", "company_name", "category_label", "location_name",
                     "contract_time", "contract_type", "posted_date", "salary_min",
                     "salary_max", "salary_avg", "salary_range", "salary_is_predicted",
                     "source", "ingestion_date"]
SALARY_TABLE_COLUMNS = ["contract_time", "job_count", "avg_salary_min", "avg_salary_max",
                        "median_salary", "max_salary", "min_salary"]
SORT_NEWEST, SORT_HIGHEST, SORT_LOWEST, SORT_DEFAULT = (
    "Newest", "Highest Salary", "Lowest Salary", "Default")
TOP_N = 10
CARD_COUNTS = list(range(5, 55, 5))


class MissingColumns(ValueError):
    """A view needs columns the frame does not have."""


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Fail at analysis time if a view's columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {missing}")
    return df


# ---------------------------------------------------------------- facets

def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values of a facet."""
    return (df.where(F.col(column).isNotNull()).select(column).distinct()
            .orderBy(column))


FACET_COLUMNS = ["ingestion_date", "category_label", "contract_time", "source"]


def facet_table(silver: DataFrame) -> DataFrame:
    """D1 for all facets in one scan: ``facet, place, value, jobs``, the non-NULL values
    of each facet in order (``place`` from 1) with their jobs.

    Summary and salary table group the same Silver, so their values are these. One
    aggregate over grouping sets, counted map-side; the window sees a row a value.
    """
    which = F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in FACET_COLUMNS])
    counted = silver.groupingSets([[F.col(c)] for c in FACET_COLUMNS],
                                  *[F.col(c) for c in FACET_COLUMNS]).agg(
        which.alias("facet"), F.count(F.lit(1)).alias("jobs"))
    values = counted.select("facet", F.coalesce(*FACET_COLUMNS).alias("value"), "jobs").where(
        "value IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("facet").orderBy("value"))
    return values.select("facet", place.cast("long").alias("place"), "value", "jobs")


def has_values(df: DataFrame, column: str) -> bool:
    """Whether a facet has any non-NULL value: a one-row probe (``take(1)``)."""
    return len(df.where(F.col(column).isNotNull()).select(column).take(1)) > 0


def filter_facet(target: DataFrame, column: str, values=None,
                 source: DataFrame | None = None) -> DataFrame:
    """Keep rows whose ``column`` is among the chosen values.

    ``values`` is a list: ``[]`` means no filter; a non-empty list is an
    ``isin`` that reaches the Parquet scan. ``None`` means the dashboard
    default, every known value of ``source`` (default: ``target``) chosen:
    NULL rows, and rows whose value ``source`` lacks, are hidden; if ``source``
    has no value at all, nothing is filtered. A one-row probe tells that case
    apart; otherwise the filter is a left-semi join with the distinct known
    values (few, so AQE broadcasts them once their size is known), or just
    ``isNotNull`` when the values come from ``target`` itself.
    """
    if column not in target.columns:
        return target
    src = target if source is None else source
    if column not in src.columns:
        return target
    if values is not None:
        values = list(values)
        return target.where(F.col(column).isin(values)) if values else target
    if not has_values(src, column):
        return target
    if src is target:
        return target.where(F.col(column).isNotNull())
    known = src.where(F.col(column).isNotNull()).select(column).distinct()
    return target.join(known, on=column, how="left_semi")


def _days(df: DataFrame, dates) -> DataFrame:
    """Chosen dates on the partition column ``dt`` too, if the frame kept it, so
    that only these days' folders are opened."""
    if not dates or "dt" not in df.columns:
        return df
    kind = df.schema["dt"].dataType
    return df.where(F.col("dt").isin([F.lit(to_dt(d)).cast(kind) for d in dates]))


@dataclass
class Views:
    """The three Gold frames after the sidebar filters."""
    summary: DataFrame
    salary: DataFrame
    detail: DataFrame


def apply_filters(summary: DataFrame, salary: DataFrame, detail: DataFrame,
                  dates=None, categories=None, contract_times=None, sources=None) -> Views:
    """D2-D6 in the dashboard's order.

    Dates come from the summary and filter summary and detail; categories come
    from the date-filtered summary; contract times from the salary table and
    filter salary and detail (not summary); sources from the detail only.
    """
    summary, salary, detail = (df.drop("dt") for df in (_days(summary, dates), salary,
                                                        _days(detail, dates)))
    s = filter_facet(summary, "ingestion_date", dates)
    d = filter_facet(detail, "ingestion_date", dates, source=summary)
    s_before = s
    s = filter_facet(s, "category_label", categories)
    d = filter_facet(d, "category_label", categories, source=s_before)
    sa = filter_facet(salary, "contract_time", contract_times)
    d = filter_facet(d, "contract_time", contract_times, source=salary)
    d = filter_facet(d, "source", sources)
    return Views(s, sa, d)


# ------------------------------------------------------------------ KPIs

def kpis(summary: DataFrame, detail: DataFrame) -> DataFrame:
    """D7-D9 as one row: total_jobs, total_categories, avg_salary, median_salary.

    total_jobs is the summary's sum, or the number of detail rows when the
    summary is empty; the salary figures are unweighted means over summary rows
    (0 when there are none). A one-row probe tells whether the summary is empty;
    only then the detail is read.
    """
    if summary.take(1):
        return summary.agg(
            F.sum("total_jobs").cast("long").alias("total_jobs"),
            F.count_distinct("category_label").alias("total_categories"),
            F.avg("avg_salary").alias("avg_salary"),
            F.avg("median_salary").alias("median_salary"))
    s = summary.select(F.lit(1).alias("_s"), F.lit(0).alias("_d"),
                       F.col("total_jobs").cast("long").alias("_jobs"),
                       F.col("category_label").alias("_label"),
                       F.col("avg_salary").alias("_avg"), F.col("median_salary").alias("_med"))
    d = detail.select(F.lit(0).alias("_s"), F.lit(1).alias("_d"),
                      F.lit(None).cast("long").alias("_jobs"),
                      F.lit(None).cast("string").alias("_label"),
                      F.lit(None).cast("double").alias("_avg"),
                      F.lit(None).cast("double").alias("_med"))
    n_summary = F.coalesce(F.sum("_s"), F.lit(0))  # an empty union sums to NULL
    return s.unionByName(d).agg(
        F.when(n_summary == 0, F.coalesce(F.sum("_d"), F.lit(0)))
        .otherwise(F.sum("_jobs")).cast("long").alias("total_jobs"),
        F.count_distinct("_label").alias("total_categories"),
        F.when(n_summary == 0, F.lit(0.0)).otherwise(F.avg("_avg")).alias("avg_salary"),
        F.when(n_summary == 0, F.lit(0.0)).otherwise(F.avg("_med")).alias("median_salary"))


# ------------------------------------------------------- overview tab

def top_categories(summary: DataFrame, n: int = TOP_N) -> DataFrame:
    """Total jobs by category, the n largest."""
    require_columns(summary, ["category_label", "total_jobs"])
    return (summary.where(F.col("category_label").isNotNull())
            .groupBy("category_label").agg(F.sum("total_jobs").alias("total_jobs"))
            .orderBy(F.desc_nulls_last("total_jobs"), F.asc("category_label")).limit(n))


def contract_distribution(summary: DataFrame) -> DataFrame:
    """Estimated jobs per contract time = sum(total_jobs * share); > 0 only."""
    require_columns(summary, ["total_jobs"] + [p for _, p in CONTRACT_TIME_SHARES])
    sums = summary.agg(*[
        F.coalesce(F.sum(F.col("total_jobs") * F.col(pct)), F.lit(0.0)).alias(code)
        for code, pct in CONTRACT_TIME_SHARES])
    return (sums.unpivot([], [code for code, _ in CONTRACT_TIME_SHARES],
                         "contract_type", "estimated_jobs")
            .where(F.col("estimated_jobs") > 0))


def category_breakdown(summary: DataFrame) -> DataFrame:
    """Per category: jobs, mean of averages, min, max, mean of medians."""
    require_columns(summary, ["category_label", "total_jobs"])
    optional = [("avg_salary", F.avg), ("min_salary", F.min), ("max_salary", F.max),
                ("median_salary", F.avg)]
    aggs = [F.sum("total_jobs").alias("total_jobs")] + [
        fn(c).alias(c) for c, fn in optional if c in summary.columns]
    return (summary.where(F.col("category_label").isNotNull())
            .groupBy("category_label").agg(*aggs)
            .orderBy(F.desc_nulls_last("total_jobs"), F.asc("category_label")))


# --------------------------------------------------------- explorer

def keyword_search(detail: DataFrame, keyword: str | None, literal: bool = False) -> DataFrame:
    """Keep jobs whose search text matches the keyword.

    Uses ``job_search_text`` when present, else joins the text columns that
    exist (NULL as ""). Empty keyword: no filter.
    """
    if not keyword:
        return detail
    if "job_search_text" in detail.columns:
        return detail.where(keyword_match("job_search_text", keyword, literal))
    cols = [c for c in SEARCH_COLUMNS if c in detail.columns]
    if not cols:
        return detail
    return detail.where(keyword_match(search_text(*cols, null_as_empty=True), keyword, literal))


def salary_bounds(detail: DataFrame) -> DataFrame:
    """Min and max of the non-NULL salary averages."""
    return detail.agg(F.min("salary_avg").alias("salary_avg_min"),
                      F.max("salary_avg").alias("salary_avg_max"))


def salary_range_filter(detail: DataFrame, lo, hi) -> DataFrame:
    """Lo <= salary_avg <= hi; NULL averages drop. ``None`` bounds: no filter.

    If no job has a salary average there is no slider, and no filter either (a
    one-row probe).
    """
    if (lo is None or hi is None or "salary_avg" not in detail.columns
            or not has_values(detail, "salary_avg")):
        return detail
    return detail.where(F.col("salary_avg").between(lo, hi))


def default_salary_range(detail: DataFrame) -> DataFrame:
    """D15 + D16 as the dashboard opens: the slider spans the full bounds, so every
    job with a salary average is inside them; all jobs where none has one."""
    if "salary_avg" not in detail.columns or not has_values(detail, "salary_avg"):
        return detail
    return detail.where(F.col("salary_avg").isNotNull())


def sort_options(detail: DataFrame) -> list[str]:
    """The sort choices offered for a frame; the first is preselected."""
    opts = [SORT_NEWEST] if "posted_date" in detail.columns else []
    if "salary_avg" in detail.columns:
        opts += [SORT_HIGHEST, SORT_LOWEST]
    return opts + [SORT_DEFAULT]


def sort_jobs(detail: DataFrame, how: str = SORT_NEWEST) -> DataFrame:
    """Newest first, highest or lowest salary; NULL last; job_id breaks ties."""
    tie = [F.asc_nulls_last("job_id")] if "job_id" in detail.columns else []
    if how == SORT_NEWEST and "posted_date" in detail.columns:
        return detail.orderBy(F.desc_nulls_last("posted_date"), *tie)
    if how == SORT_HIGHEST and "salary_avg" in detail.columns:
        return detail.orderBy(F.desc_nulls_last("salary_avg"), *tie)
    if how == SORT_LOWEST and "salary_avg" in detail.columns:
        return detail.orderBy(F.asc_nulls_last("salary_avg"), *tie)
    return detail


def top_jobs(detail: DataFrame, how: str = SORT_NEWEST, n: int = 10) -> DataFrame:
    """The first n jobs of a sort (5..50 by 5): a per-partition top-n."""
    if n not in CARD_COUNTS:
        raise ValueError(f"n must be one of {CARD_COUNTS}")
    return sort_jobs(detail, how).limit(n)


def card_fields(detail: DataFrame) -> DataFrame:
    """The nine card fields; defaults only for columns that are absent."""
    return detail.select(*[
        F.col(c) if c in detail.columns else F.lit(d).cast("string").alias(c)
        for c, d in CARD_DEFAULTS.items()])


def job_table(detail: DataFrame) -> DataFrame:
    """The explorer table, the listed columns that exist."""
    return detail.select(*[c for c in JOB_TABLE_COLUMNS if c in detail.columns])


def result_count(detail: DataFrame) -> int:
    """Number of jobs left (an action)."""
    return detail.count()


def result_count_frame(detail: DataFrame) -> DataFrame:
    """D17 as a one-row frame (``result_count``), for composition."""
    return detail.agg(F.count(F.lit(1)).alias("result_count"))


# ---------------------------------------------------------- salary tab

def salary_melt(salary: DataFrame) -> DataFrame:
    """avg_salary_min/max as (salary_type, salary) rows."""
    require_columns(salary, ["contract_time", "avg_salary_min", "avg_salary_max"])
    return salary.unpivot(["contract_time"], ["avg_salary_min", "avg_salary_max"],
                          "salary_type", "salary")


def median_ranking(salary: DataFrame) -> DataFrame:
    """Contract times by median salary, highest first."""
    require_columns(salary, ["contract_time", "median_salary"])
    return salary.orderBy(F.desc_nulls_last("median_salary"), F.asc_nulls_last("contract_time"))


def jobs_by_contract(salary: DataFrame) -> DataFrame:
    """Contract times with at least one job."""
    require_columns(salary, ["contract_time", "job_count"])
    return salary.where(F.col("job_count") > 0).select("contract_time", "job_count")


def salary_table(salary: DataFrame) -> DataFrame:
    """The salary table, the listed columns that exist."""
    return salary.select(*[c for c in SALARY_TABLE_COLUMNS if c in salary.columns])


def salary_by_top_categories(summary: DataFrame, n: int = TOP_N) -> DataFrame:
    """Mean of averages and of medians for the n categories with most jobs,
    as (category_label, salary_type, salary) rows."""
    require_columns(summary, ["category_label", "avg_salary", "median_salary", "total_jobs"])
    top = (summary.where(F.col("category_label").isNotNull())
           .groupBy("category_label")
           .agg(F.avg("avg_salary").alias("avg_salary"),
                F.avg("median_salary").alias("median_salary"),
                F.sum("total_jobs").alias("total_jobs"))
           .orderBy(F.desc_nulls_last("total_jobs"), F.asc("category_label")).limit(n))
    return top.unpivot(["category_label"], ["avg_salary", "median_salary"],
                       "salary_type", "salary")
