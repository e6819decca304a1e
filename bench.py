"""Benchmark: the pipeline and the headline queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Each query is forced to completion with the ``noop``
sink (no collect to the driver). Landing the feeds as Bronze JSON is setup,
not timed; the Silver and Gold builds then run from those files. One small
untimed run of the pipeline at sf0.001 first warms the JVM (code generation
and class loading); timings vary by about 20 % between runs on one machine.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from hirelake.operators import quality, serve  # noqa: E402
from hirelake.plans import feeds  # noqa: E402
from hirelake.plans.catalog import CATALOG, served_gold  # noqa: E402
from hirelake.plans.pipeline import run_gold, run_silver  # noqa: E402
from hirelake.session import build_session  # noqa: E402
from hirelake.sources import lake  # noqa: E402

WARMUP_SF_DIR = "/root/testdata/sf0.001"
CATALOG_QUERIES = ["n14_silver", "g6_jobs_detail", "g7_jobs_summary", "g11_salary_analysis",
                   "q7_report", "d6_default_filters", "s3_batches", "s4_pages"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    work = tempfile.mkdtemp(prefix="hirelake-bench-")
    spark = build_session(f"local[{cpus}]", "hirelake-bench", {
        "spark.sql.shuffle.partitions": str(max(8, 2 * cpus)),
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": f"{work}/checkpoints",
    })
    spark.sparkContext.setLogLevel("ERROR")
    bronze, silver, gold_root = f"{work}/bronze", f"{work}/silver", f"{work}/gold"
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # setup (untimed): warm the JVM's generated code with one small run of the
    # pipeline, then land the feeds of the measured scale as Bronze JSON Lines
    warm = f"{work}/warm"
    feeds.land_feeds(spark, WARMUP_SF_DIR, f"{warm}/bronze", one_document_per_file=False)
    run_silver(spark, ["adzuna", "jooble"], feeds.RUN_DATE, f"{warm}/bronze", f"{warm}/silver",
               fail_on=None, multi_line=False)
    run_gold(spark, feeds.RUN_DATE, f"{warm}/silver", f"{warm}/gold")
    feeds.land_feeds(spark, sf_dir, bronze, one_document_per_file=False)

    timed("silver_build", lambda: run_silver(spark, ["adzuna", "jooble"], feeds.RUN_DATE,
                                             bronze, silver, fail_on=None,
                                             multi_line=False))
    timed("gold_build", lambda: run_gold(spark, feeds.RUN_DATE, silver, gold_root))
    # the step the reference publishes a time for: the Silver quality pass
    timed("silver_quality_report", lambda: run(quality.quality_report(
        lake.read_silver(spark, silver, feeds.RUN_DATE))))

    summary = lake.read_gold(spark, gold_root, "jobs_summary", feeds.RUN_DATE)
    salary = lake.read_gold(spark, gold_root, "salary_analysis", feeds.RUN_DATE)
    detail = lake.read_gold(spark, gold_root, "jobs_detail", feeds.RUN_DATE)
    views = serve.apply_filters(summary, salary, detail)
    timed("serve_filters_kpis", lambda: run(serve.kpis(views.summary, views.detail)))
    timed("serve_top_categories", lambda: run(serve.top_categories(views.summary)))
    timed("serve_keyword_search", lambda: run(serve.keyword_search(views.detail, "high|urgent")))
    timed("serve_salary_range", lambda: run(serve.salary_range_filter(
        views.detail, 150000.0, 300000.0)))
    timed("serve_top_jobs", lambda: run(serve.top_jobs(views.detail, serve.SORT_HIGHEST, 10)))
    timed("serve_category_breakdown", lambda: run(serve.category_breakdown(views.summary)))
    timed("serve_salary_by_category", lambda: run(serve.salary_by_top_categories(views.summary)))
    timed("serve_page_of_jobs", lambda: run(serve.job_table(serve.top_jobs(
        serve.keyword_search(detail, "machinery"), serve.SORT_NEWEST, 50))))

    timed("served_gold_build", lambda: served_gold(spark, sf_dir))   # what d6 reads
    for name in CATALOG_QUERIES:
        timed(name, lambda n=name: run(CATALOG[n].run(spark, sf_dir)))

    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))


if __name__ == "__main__":
    main()
