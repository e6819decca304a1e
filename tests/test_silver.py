import hashlib

from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import rows_of
from hirelake.operators import normalize, silver
from hirelake.schemas import COMMON_COLUMNS, FLAT_RECORD, NESTED_RECORD, SILVER_COLUMNS

NESTED = {"id": "41", "title": "Baker", "contract_time": "part_time",
          "contract_type": "contract", "created": "1700000000", "salary_min": 21500.0,
          "salary_max": 24800.0, "salary_is_predicted": "0", "latitude": 47.4,
          "longitude": 8.5, "redirect_url": "u",
          "category": {"label": "Food", "tag": "food-jobs"},
          "company": {"display_name": "Backhaus Nord"},
          "location": {"display_name": "Altdorf", "area": ["CH"]}}
FLAT = {"id": "88", "title": "Tram Driver", "company": "City Lines", "location": "Porto",
        "salary": "28k - 31k", "type": "Full-time, Permanent", "link": "l",
        "updated": "2026-04-03T06:15:00"}


def jobs(spark, record_schema, records, batch="b1", ingested="2026-05-20T00:00:00"):
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField("batch_id", StringType()),
                         StructField("ingested_at", StringType()),
                         StructField("job", record_schema)])
    return spark.createDataFrame([(batch, ingested, r) for r in records], schema)


def test_normalizers_and_union(spark):
    n = normalize.normalize_nested(jobs(spark, NESTED_RECORD, [NESTED]), "2026/05/20")
    f = normalize.normalize_flat(jobs(spark, FLAT_RECORD, [FLAT]), "2026/05/20")
    assert n.columns[:17] == COMMON_COLUMNS and f.columns[:17] == COMMON_COLUMNS
    out = silver.silver_transform([n, f])
    assert out.columns == SILVER_COLUMNS
    rows = {r["job_id"]: r for r in out.collect()}
    a, j = rows["adzuna_41"], rows["jooble_88"]
    assert a["company_name"] == "Backhaus Nord" and a["category_label"] == "Food"
    assert str(a["posted_at"]) == "2023-11-14 22:13:20"
    assert a["salary_is_predicted"] is False
    assert (j["salary_min"], j["salary_max"]) == (28000.0, 31000.0)
    assert (j["contract_time"], j["contract_type"]) == ("FULL_TIME", "PERMANENT")
    assert j["category_label"] == "Uncategorized" and j["salary_is_predicted"] is None
    assert a["company_id"] == hashlib.sha256(b"Backhaus Nord").hexdigest()


def test_bad_timestamps_give_null(spark):
    rec = dict(NESTED, created="not a date")
    n = normalize.normalize_nested(jobs(spark, NESTED_RECORD, [rec]), "d")
    assert n.first()["posted_at"] is None
    recf = dict(FLAT, updated="")
    f = normalize.normalize_flat(jobs(spark, FLAT_RECORD, [recf]), "d")
    assert f.first()["posted_at"] is None


def _common(spark, rows):
    base = {c: None for c in COMMON_COLUMNS + ["batch_id", "ingested_at"]}
    return spark.createDataFrame([Row(**{**base, **r}) for r in rows],
                                 "job_id string, title string, company_name string, "
                                 "location_name string, salary_min double, salary_max double, "
                                 "salary_is_predicted boolean, contract_time string, "
                                 "contract_type string, category_label string, "
                                 "category_tag string, latitude double, longitude double, "
                                 "job_url string, posted_at timestamp, source string, "
                                 "ingestion_date string, batch_id string, ingested_at string")


def test_null_ids_dropped_with_observed_count(spark):
    df = _common(spark, [{"job_id": None}, {"job_id": "1"}, {"job_id": "1"}])
    m = silver.SilverMetrics()
    out = silver.silver_transform(df, m)
    assert out.count() == 1
    assert m.as_dict() == {"input_rows": 3, "null_job_ids": 1, "duplicates_removed": 1,
                           "silver_rows": 1, "posted_at_null": 1}


def test_dedup_keeps_latest_copy_deterministically(spark):
    rows = [
        {"job_id": "a", "title": "old", "ingested_at": "2026-05-20T08:00:00+00:00", "batch_id": "x"},
        {"job_id": "a", "title": "new", "ingested_at": "2026-05-20T20:00:00+00:00", "batch_id": "a"},
        {"job_id": "b", "title": "b1", "ingested_at": "2026-05-20T08:00:00+00:00", "batch_id": "1"},
        {"job_id": "b", "title": "b2", "ingested_at": "2026-05-20T08:00:00+00:00", "batch_id": "2"},
        {"job_id": "c", "title": "z", "ingested_at": "t", "batch_id": "1"},
        {"job_id": "c", "title": "y", "ingested_at": "t", "batch_id": "1"},
    ]
    df = _common(spark, rows)
    got = {r["job_id"]: r["title"] for r in silver.deduplicate_latest(df).collect()}
    assert got == {"a": "new", "b": "b2", "c": "z"}
    # input order and partitioning do not change the survivor
    shuffled = _common(spark, list(reversed(rows))).repartition(3)
    assert {r["job_id"]: r["title"] for r in silver.deduplicate_latest(shuffled).collect()} == got
    # idempotent
    once = silver.deduplicate_latest(df)
    assert sorted(map(tuple, silver.deduplicate_latest(once).collect())) == \
        rows_of(once)


def test_dedup_plan_is_partial_aggregate(spark):
    df = _common(spark, [{"job_id": "a"}])
    plan = silver.deduplicate_latest(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_standardize_is_idempotent(spark):
    df = _common(spark, [{"job_id": "1", "contract_time": " full_time ", "contract_type": None},
                         {"job_id": "2", "contract_time": "", "contract_type": "Permanent"}])
    once = silver.standardize_contract_fields(df)
    twice = silver.standardize_contract_fields(once)
    got = {r["job_id"]: (r["contract_time"], r["contract_type"]) for r in once.collect()}
    assert got == {"1": ("FULL_TIME", "UNKNOWN"), "2": ("", "PERMANENT")}
    assert rows_of(once) == rows_of(twice)


def test_salary_scale_per_column(spark):
    df = _common(spark, [{"job_id": "1", "salary_min": 30.0, "salary_max": 50000.0},
                         {"job_id": "2", "salary_min": None, "salary_max": 1000.0}])
    got = {r["job_id"]: (r["salary_min"], r["salary_max"])
           for r in silver.scale_salaries(df).collect()}
    assert got == {"1": (30000.0, 50000.0), "2": (None, 1000.0)}


def test_union_widens_numeric(spark):
    a = spark.createDataFrame([(1,)], "x long")
    b = spark.createDataFrame([(1.5,)], "x double")
    assert dict(silver.union_sources([a, b]).dtypes)["x"] == "double"


def test_dedup_sorts_bounded_partitions(spark):
    """Rows are dealt to partitions of bounded size before the fold that sorts them,
    and the fold comes before the shuffle by key."""
    df = _common(spark, [{"job_id": "a", "ingested_at": "t", "batch_id": "1"}])
    plan = silver.deduplicate_latest(df)._jdf.queryExecution().executedPlan().toString()
    final, fold, dealt = plan.index("ENSURE_REQUIREMENTS"), plan.index("partial_max"), \
        plan.index("REBALANCE_PARTITIONS_BY_COL")
    assert final < fold < dealt
