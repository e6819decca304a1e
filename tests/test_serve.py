import datetime
import re

import pytest
from pyspark.sql import functions as F

from hirelake.operators import serve

SUMMARY = ("ingestion_date string, category_label string, total_jobs long, avg_salary double, "
           "min_salary double, max_salary double, median_salary double, pct_full_time double, "
           "pct_part_time double, pct_unknown double")
DETAIL = ("job_id string, title string, company_name string, category_label string, "
          "location_name string, contract_time string, contract_type string, "
          "posted_date date, salary_avg double, salary_range string, source string, "
          "ingestion_date string, job_search_text string")
SALARY = ("contract_time string, job_count long, avg_salary_min double, avg_salary_max double, "
          "median_salary double, max_salary double, min_salary double")


@pytest.fixture()
def tables(spark):
    summary = spark.createDataFrame([
        ("2026/05/20", "IT", 10, 100.0, 50.0, 200.0, 90.0, 0.5, 0.5, 0.0),
        ("2026/05/20", "Sales", 5, 50.0, 10.0, 90.0, 40.0, 0.2, 0.0, 0.8),
        ("2026/05/27", "IT", 4, 200.0, 80.0, 300.0, 150.0, 1.0, 0.0, 0.0),
        ("2026/05/27", None, 3, None, None, None, None, 0.0, 0.0, 0.0)], SUMMARY)
    d = datetime.date
    detail = spark.createDataFrame([
        ("1", "Data Engineer", "ABC", "IT", "HCM", "FULL_TIME", "PERMANENT", d(2026, 5, 1),
         150.0, "100.0 - 200.0", "adzuna", "2026/05/20", "data engineer abc it hcm"),
        ("2", "Sales Rep", None, "Sales", "Hanoi", "PART_TIME", "CONTRACT", d(2026, 5, 3),
         None, "Not available", "jooble", "2026/05/20", "sales rep sales hanoi"),
        ("3", "Engineer", "XYZ", "IT", None, "UNKNOWN", "UNKNOWN", None, 80.0,
         "60.0 - 100.0", None, "2026/05/27", "engineer xyz it"),
        ("4", "Analyst", "Q", None, "HCM", None, "UNKNOWN", d(2026, 5, 2), 120.0,
         "x", "adzuna", None, "analyst q hcm")], DETAIL)
    salary = spark.createDataFrame([
        ("FULL_TIME", 3, 10.0, 20.0, 15.0, 30.0, 5.0),
        ("PART_TIME", 0, None, None, None, None, None),
        ("UNKNOWN", 2, 5.0, 50.0, 40.0, 60.0, 1.0)], SALARY)
    return summary, salary, detail


def test_facet_values(tables):
    summary, _, _ = tables
    assert [r[0] for r in serve.facet_values(summary, "category_label").collect()] == ["IT", "Sales"]


def test_default_filters_hide_nulls(tables):
    summary, salary, detail = tables
    v = serve.apply_filters(summary, salary, detail)
    assert sorted(r["job_id"] for r in v.detail.collect()) == ["1", "2"]
    assert v.summary.count() == 3


def test_explicit_and_empty_filters(tables):
    summary, salary, detail = tables
    v = serve.apply_filters(summary, salary, detail, dates=[], categories=["IT"],
                            contract_times=[], sources=[])
    assert sorted(r["job_id"] for r in v.detail.collect()) == ["1", "3"]
    assert v.salary.count() == 3


def test_facet_without_values_does_not_filter(spark, tables):
    _, _, detail = tables
    no_source = detail.withColumn("source", F.lit(None).cast("string"))
    assert serve.filter_facet(no_source, "source").count() == 4


def test_kpis(spark, tables):
    summary, _, detail = tables
    k = serve.kpis(summary, detail).first()
    assert (k["total_jobs"], k["total_categories"]) == (22, 2)
    assert k["avg_salary"] == pytest.approx(350.0 / 3)
    empty = serve.kpis(summary.limit(0), detail).first()
    assert (empty["total_jobs"], empty["total_categories"], empty["avg_salary"]) == (4, 0, 0.0)
    none = serve.kpis(summary.limit(0), detail.limit(0)).first()
    assert (none["total_jobs"], none["total_categories"], none["avg_salary"],
            none["median_salary"]) == (0, 0, 0.0, 0.0)


def test_overview_views(tables):
    summary, _, _ = tables
    top = [tuple(r) for r in serve.top_categories(summary).collect()]
    assert top == [("IT", 14), ("Sales", 5)]
    dist = {r["contract_type"]: r["estimated_jobs"]
            for r in serve.contract_distribution(summary).collect()}
    assert set(dist) == {"FULL_TIME", "PART_TIME", "UNKNOWN"}
    assert dist["FULL_TIME"] == pytest.approx(10 * 0.5 + 5 * 0.2 + 4 * 1.0)
    br = serve.category_breakdown(summary).collect()
    assert [r["category_label"] for r in br] == ["IT", "Sales"]
    assert br[0]["avg_salary"] == 150.0 and br[0]["min_salary"] == 50.0


def test_search_sort_and_top(tables):
    _, _, detail = tables
    assert sorted(r["job_id"] for r in serve.keyword_search(detail, "ENGINEER").collect()) == ["1", "3"]
    assert serve.keyword_search(detail, "").count() == 4
    fb = serve.keyword_search(detail.drop("job_search_text"), "hanoi")
    assert [r["job_id"] for r in fb.collect()] == ["2"]
    b = serve.salary_bounds(detail).first()
    assert (b["salary_avg_min"], b["salary_avg_max"]) == (80.0, 150.0)
    assert sorted(r["job_id"] for r in serve.salary_range_filter(detail, 80.0, 120.0).collect()) == ["3", "4"]
    assert [r["job_id"] for r in serve.sort_jobs(detail, serve.SORT_NEWEST).collect()] == ["2", "4", "1", "3"]
    assert [r["job_id"] for r in serve.sort_jobs(detail, serve.SORT_LOWEST).collect()] == ["3", "4", "1", "2"]
    assert [r["job_id"] for r in serve.top_jobs(detail, serve.SORT_HIGHEST, 5).collect()] == ["1", "4", "3", "2"]
    with pytest.raises(ValueError):
        serve.top_jobs(detail, n=7)
    assert serve.sort_options(detail) == ["Newest", "Highest Salary", "Lowest Salary", "Default"]


def test_cards_and_projections(tables):
    _, salary, detail = tables
    cards = serve.card_fields(detail.drop("salary_range", "posted_date"))
    assert cards.columns == list(serve.CARD_DEFAULTS)
    row = cards.collect()[1]
    assert row["salary_range"] == "Not available" and row["posted_date"] == "Unknown"
    assert row["company_name"] is None  # present column: NULL kept
    assert serve.job_table(detail).columns == [c for c in serve.JOB_TABLE_COLUMNS if c in detail.columns]
    assert serve.salary_table(salary).columns == serve.SALARY_TABLE_COLUMNS


def test_salary_views(tables):
    summary, salary, _ = tables
    melt = serve.salary_melt(salary)
    assert melt.count() == 6 and melt.columns == ["contract_time", "salary_type", "salary"]
    assert [r["contract_time"] for r in serve.median_ranking(salary).collect()] == \
        ["UNKNOWN", "FULL_TIME", "PART_TIME"]
    assert sorted(r["contract_time"] for r in serve.jobs_by_contract(salary).collect()) == \
        ["FULL_TIME", "UNKNOWN"]
    by_cat = serve.salary_by_top_categories(summary).collect()
    assert len(by_cat) == 4
    with pytest.raises(serve.MissingColumns):
        serve.salary_melt(salary.drop("avg_salary_min"))


def test_export_views(spark, tables, tmp_dir):
    from hirelake.sources.export import export_views
    summary, salary, detail = tables
    v = serve.apply_filters(summary, salary, detail, categories=["IT"])
    paths = export_views(v, tmp_dir)
    assert set(paths) == {"detail", "summary", "salary"}
    back = spark.read.option("header", True).csv(paths["summary"])
    assert back.count() == 2 and "total_jobs" in back.columns
    assert spark.read.option("header", True).csv(paths["detail"]).count() == v.detail.count()


def test_dashboard_views(spark, tables):
    from hirelake.plans.serving import dashboard
    summary, salary, detail = tables
    views = dashboard(summary, salary, detail, keyword="engineer", salary_range=(0.0, 1000.0),
                      sort=serve.SORT_HIGHEST, cards=5)
    assert views["result_count"].first()["result_count"] == 1
    assert [r["title"] for r in views["job_cards"].collect()] == ["Data Engineer"]
    # default filters hide the summary row without a category (3 jobs)
    assert views["kpis"].first()["total_jobs"] == 19
    assert views["salary_table"].count() == 3


def test_default_salary_range(tables):
    _, _, detail = tables
    got = sorted(r["job_id"] for r in serve.default_salary_range(detail).collect())
    assert got == ["1", "3", "4"]  # every job with a salary average


def test_no_salary_no_salary_filter(spark):
    jobs = spark.createDataFrame([("a", None), ("b", None)], "job_id string, salary_avg double")
    assert serve.default_salary_range(jobs).count() == 2
    assert serve.salary_range_filter(jobs, 1.0, 2.0).count() == 2
    some = jobs.unionByName(spark.createDataFrame([("c", 5.0)], jobs.schema))
    assert [r.job_id for r in serve.default_salary_range(some).collect()] == ["c"]
    assert serve.salary_range_filter(some, 1.0, 2.0).count() == 0


def test_chosen_values_filter_nothing_without_the_source_column(spark):
    jobs = spark.createDataFrame([("a", "x")], "job_id string, category_label string")
    other = spark.createDataFrame([(1,)], "n int")
    assert serve.filter_facet(jobs, "category_label", ["y"], source=other).count() == 1
    assert serve.filter_facet(jobs, "category_label", ["y"]).count() == 0


def test_date_filter_prunes_days_and_kpis_leave_detail_alone(spark, tmp_dir):
    from hirelake.plans import catalog
    from hirelake.sources import lake
    from conftest import SF_SMALL
    summary, salary, detail = catalog.gold_tables(spark, SF_SMALL)
    for dt in ("2026-05-19", "2026-05-20"):
        for name, df in (("jobs_summary", summary), ("jobs_detail", detail)):
            lake.write_gold(df.withColumn("ingestion_date", F.lit(dt.replace("-", "/"))),
                            tmp_dir, name, dt)
    kept = [lake.read_gold(spark, tmp_dir, t, keep_dt=True) for t in ("jobs_summary", "jobs_detail")]
    views = serve.apply_filters(kept[0], salary, kept[1], dates=["2026/05/20"], categories=[],
                                contract_times=[], sources=[])
    for view in (views.summary, views.detail):
        plan = spark._jvm.PythonSQLUtils.explainString(view._jdf.queryExecution(), "formatted")
        (filters,) = re.findall(r"PartitionFilters: (.*)", plan)
        assert "dt#" in filters
        assert view.select("ingestion_date").distinct().collect()[0][0] == "2026/05/20"
    kpis = serve.kpis(views.summary, views.detail)
    plan = spark._jvm.PythonSQLUtils.explainString(kpis._jdf.queryExecution(), "formatted")
    assert "jobs_summary" in plan and "jobs_detail" not in plan


def test_csv_keeps_quotes_commas_and_line_breaks(spark, tmp_dir):
    from hirelake.sources import export
    rows = [('a "big" one', "x,y", 1.5), ("two\nlines", None, None), (" spaced ", '"', 2.0),
            ("", "z", 0.0)]
    df = spark.createDataFrame(rows, "title string, note string, n double")
    views = serve.Views(summary=df, salary=df, detail=df)
    for path in export.export_views(views, tmp_dir).values():
        got = export.read_csv(spark, path, df.schema).collect()
        want = [(a or None, b, n) for a, b, n in rows]     # empty text and NULL are one
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_csv_files_hold_bounded_rows(spark, tmp_dir, monkeypatch):
    import glob
    from hirelake.sources import export
    monkeypatch.setattr(export, "FILE_ROWS", 10)
    df = spark.range(35).selectExpr("id", "concat('a\n', id) AS title").coalesce(1)
    export.write_csv(df, f"{tmp_dir}/bounded")
    assert len(glob.glob(f"{tmp_dir}/bounded/*.csv")) == 4
    back = export.read_csv(spark, f"{tmp_dir}/bounded", df.schema)
    assert sorted(map(tuple, back.collect())) == [(i, f"a\n{i}") for i in range(35)]
