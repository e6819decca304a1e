import pytest
from pyspark.sql import functions as F

from hirelake.operators import gold, quality

QUALITY_ROWS = [
    ("1", "Data Engineer", "ABC", 1000, 2000, "FULL_TIME", "PERMANENT"),
    ("1", "Data Engineer", None, 3000, 1000, "INVALID_TYPE", "RANDOM"),
    ("2", None, "ABC", 1000, 2000, "UNKNOWN", "INVALID"),
    (None, "x", "y", None, 5, None, None),
]
QSCHEMA = ("job_id string, title string, company_name string, salary_min long, "
           "salary_max long, contract_time string, contract_type string")


def test_quality_report(spark):
    df = spark.createDataFrame(QUALITY_ROWS, QSCHEMA)
    rep = {(r["check"], r["column"]): r["failed"] for r in quality.quality_report(df).collect()}
    assert rep[("required_field", "job_id")] == 1
    assert rep[("required_field", "title")] == 1
    assert rep[("required_field", "company_name")] == 1
    assert rep[("salary_order", "salary_min,salary_max")] == 1
    assert rep[("contract_type_domain", "contract_type")] == 2  # NULL not counted
    assert rep[("contract_time_domain", "contract_time")] == 1
    assert rep[("duplicates", "job_id")] == 1


def test_duplicates_count_null_key(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "job_id string")
    assert quality.duplicate_keys(df).first()["duplicate_keys"] == 1


def test_offenders_and_severity(spark):
    df = spark.createDataFrame(QUALITY_ROWS, QSCHEMA)
    off = [tuple(r) for r in quality.offenders(df, "contract_type").collect()]
    assert off == [("INVALID", 1), ("RANDOM", 1)]
    rows = quality.quality_report(df, severities={"salary_order": "critical"}).collect()
    quality.enforce(rows, fail_on=None)
    with pytest.raises(quality.QualityError, match="salary_order"):
        quality.enforce(rows)


SILVER_SCHEMA = ("job_id string, title string, company_name string, category_label string, "
                 "location_name string, contract_time string, contract_type string, "
                 "posted_at timestamp, salary_min double, salary_max double, "
                 "salary_is_predicted boolean, latitude double, longitude double, "
                 "category_tag string, category_id string, company_id string, "
                 "location_id string, job_url string, source string, ingestion_date string")


def _silver(spark, rows):
    import datetime
    base = dict(job_id="1", title="Data Engineer", company_name="ABC", category_label="IT",
                location_name="HCM", contract_time="FULL_TIME", contract_type="PERMANENT",
                posted_at=datetime.datetime(2026, 5, 20, 10, 0), salary_min=30000.0,
                salary_max=50000.0, salary_is_predicted=False, latitude=1.0, longitude=2.0,
                category_tag="it", category_id="c", company_id="co", location_id="l",
                job_url="u", source="adzuna", ingestion_date="2026/05/20")
    return spark.createDataFrame([{**base, **r} for r in rows], SILVER_SCHEMA)


def test_jobs_detail_golden(spark):
    df = _silver(spark, [{}, {"job_id": "2", "salary_min": None, "salary_max": None,
                              "company_name": None}])
    rows = {r["job_id"]: r for r in gold.jobs_detail(df).collect()}
    assert len(gold.jobs_detail(df).columns) == 25
    a, b = rows["1"], rows["2"]
    assert (a["salary_avg"], a["salary_range"], a["is_salary_available"]) == \
        (40000.0, "30000.0 - 50000.0", True)
    assert (b["salary_avg"], b["salary_range"], b["is_salary_available"]) == \
        (None, "Not available", False)
    assert str(a["posted_date"]) == "2026-05-20"
    assert a["job_search_text"] == "data engineer abc it hcm full_time permanent"
    assert b["job_search_text"] == "data engineer it hcm full_time permanent"


def test_jobs_summary_golden(spark):
    df = _silver(spark, [
        {"job_id": "1", "salary_min": 1000.0, "salary_max": 2000.0, "contract_time": "FULL_TIME"},
        {"job_id": "2", "salary_min": 3000.0, "salary_max": 4000.0, "contract_time": "PART_TIME"},
        {"job_id": "3", "category_label": "Sales", "contract_time": "UNKNOWN"},
        {"job_id": "4", "category_label": None, "contract_time": "OTHER"}])
    s = {r["category_label"]: r for r in gold.jobs_summary(df).collect()}
    it = s["IT"]
    assert it["total_jobs"] == 2 and it["avg_salary"] == 2500.0
    assert (it["min_salary"], it["max_salary"], it["median_salary"]) == (1000.0, 4000.0, 1500.0)
    assert (it["pct_full_time"], it["pct_part_time"], it["pct_unknown"]) == (0.5, 0.5, 0.0)
    assert s["Sales"]["pct_unknown"] == 1.0
    assert s[None]["pct_full_time"] + s[None]["pct_unknown"] == 0.0
    exact = {r["category_label"]: r["median_salary"]
             for r in gold.jobs_summary(df, exact_median=True).collect()}
    assert exact["IT"] == 1500.0


def test_salary_analysis_order(spark):
    df = _silver(spark, [
        {"job_id": "1", "contract_time": "FULL_TIME", "salary_min": 1000.0, "salary_max": 5000.0},
        {"job_id": "2", "contract_time": "PART_TIME", "salary_min": 1000.0, "salary_max": 9000.0},
        {"job_id": "3", "contract_time": "UNKNOWN", "salary_min": None, "salary_max": None}])
    rows = gold.salary_analysis(df).collect()
    assert [r["contract_time"] for r in rows] == ["PART_TIME", "FULL_TIME", "UNKNOWN"]
    assert rows[0]["job_count"] == 1 and rows[0]["median_salary"] == 9000.0
    by_date = gold.salary_analysis(df, by_date=True)
    assert by_date.columns[0] == "ingestion_date"
