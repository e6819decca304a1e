"""The dashboard as one call: Gold tables of the lake, the
sidebar filters, and every view of the four tabs as lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.operators import serve
from hirelake.sources import export, lake


def gold_views(spark: SparkSession, gold_root: str, dt: str | None = None):
    """(summary, salary, detail) of one day, or of all days with the partition column
    ``dt``, by which ``serve.apply_filters`` opens only the chosen days' folders."""
    return tuple(lake.read_gold(spark, gold_root, t, dt, keep_dt=dt is None)
                 for t in lake.GOLD_TABLES)


def export_dashboard(spark: SparkSession, gold_root: str, folder: str, **choice) -> dict[str, str]:
    """Every dashboard view for one selection as a folder of CSV files (the three
    downloads under their fixed names); returns view -> path."""
    views = dashboard(*gold_views(spark, gold_root), **choice)
    paths = {}
    for name, df in views.items():
        paths[name] = f"{folder.rstrip('/')}/{export.VIEW_FILES.get(name, name)}"
        export.write_csv(df, paths[name])
    return paths


def dashboard(summary: DataFrame, salary: DataFrame, detail: DataFrame, *,
              dates=None, categories=None, contract_times=None, sources=None,
              keyword: str | None = None, salary_range: tuple | None = None,
              sort: str = serve.SORT_NEWEST, cards: int = 10) -> dict[str, DataFrame]:
    """Every dashboard view for one filter selection.

    Filters follow the sidebar (``None`` = every known value chosen, ``[]`` =
    no filter). The explorer applies the keyword, then the salary range
    (``(lo, hi)``), then the sort. Default facets (``None``) run a one-row
    probe each while the views are built; the views themselves run when used.
    """
    v = serve.apply_filters(summary, salary, detail, dates=dates, categories=categories,
                            contract_times=contract_times, sources=sources)
    explorer = serve.keyword_search(v.detail, keyword)
    if salary_range is not None:
        explorer = serve.salary_range_filter(explorer, *salary_range)
    explorer = serve.sort_jobs(explorer, sort)
    views = {
        "kpis": serve.kpis(v.summary, v.detail),
        "top_categories": serve.top_categories(v.summary),
        "contract_distribution": serve.contract_distribution(v.summary),
        "category_breakdown": serve.category_breakdown(v.summary),
        "salary_bounds": serve.salary_bounds(serve.keyword_search(v.detail, keyword)),
        "result_count": serve.result_count_frame(explorer),
        "job_cards": serve.card_fields(explorer.limit(cards)),
        "job_table": serve.job_table(explorer),
        "salary_melt": serve.salary_melt(v.salary),
        "median_ranking": serve.median_ranking(v.salary),
        "jobs_by_contract": serve.jobs_by_contract(v.salary),
        "salary_table": serve.salary_table(v.salary),
        "salary_by_category": serve.salary_by_top_categories(v.summary),
        "detail": v.detail, "summary": v.summary, "salary": v.salary,
    }
    return views
