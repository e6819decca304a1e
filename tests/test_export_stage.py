"""The dashboard as a job: a selection over several stored days as CSV folders."""

import os

from conftest import SF_SMALL, rows_of
from hirelake.operators import gold
from hirelake.plans import catalog, serving
from hirelake.plans.pipeline import parse_args, run_stage
from hirelake.sources import lake
from pyspark.sql import functions as F

DAYS = ("2026-05-19", "2026-05-20", "2026-05-21")


def _store_days(spark, root):
    """Three days of Gold that differ in their rows."""
    s = catalog.written_silver(spark, SF_SMALL)
    for i, dt in enumerate(DAYS):
        day = s.where(F.pmod(F.crc32("job_id"), F.lit(3)) <= i).withColumn(
            "ingestion_date", F.lit(dt.replace("-", "/")))
        for name, df in (("jobs_summary", gold.jobs_summary(day)),
                         ("salary_analysis", gold.salary_analysis(day)),
                         ("jobs_detail", gold.jobs_detail(day))):
            lake.write_gold(df, root, name, dt)


def _dates_chosen(df, date):
    return rows_of(df.where(F.col("ingestion_date") == date))


def test_chosen_days_open_their_folders_alone_and_export(spark, tmp_dir):
    root, out = os.path.join(tmp_dir, "gold"), os.path.join(tmp_dir, "csv")
    _store_days(spark, root)
    date = DAYS[1].replace("-", "/")
    summary, salary, detail = serving.gold_views(spark, root)
    views = serving.dashboard(summary, salary, detail, dates=[date], categories=[],
                              contract_times=[], sources=[])
    assert "dt" not in views["detail"].columns and "dt" not in views["salary"].columns
    assert rows_of(views["detail"]) == _dates_chosen(detail.drop("dt"), date)
    assert rows_of(views["summary"]) == _dates_chosen(summary.drop("dt"), date)
    assert 0 < views["detail"].count() < detail.where(F.col("dt") == DAYS[2]).count()
    plan = views["detail"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dt#" in plan.split("PartitionFilters: [")[1].split("]")[0]

    args = parse_args(["--date", DAYS[2], "--stage", "export", "--gold-root", root,
                       "--export-root", out, "--dates", date, "--categories",
                       "--contract-times", "--job-sources", "--keyword", "urgent"])
    paths = run_stage(spark, args)
    assert os.path.basename(paths["detail"]) == "jobs_detail_filtered"
    written = spark.read.option("header", True).csv(paths["summary"])
    assert written.count() == views["summary"].count()
    assert {"kpis", "job_cards", "median_ranking"} <= set(os.listdir(out))
    hits = spark.read.option("header", True).csv(paths["result_count"]).first()[0]
    assert int(hits) == detail.where((F.col("dt") == DAYS[1])
                                     & F.col("job_search_text").contains("urgent")).count()
