"""Bronze documents of both feeds, one per file and over several lines, go
through S1 -> B4 -> N14 with the expected Silver rows."""

import json
import os

import pytest

from hirelake.operators import quality
from hirelake.plans.pipeline import run_bronze, run_silver
from hirelake.sources import lake

DT = "2026-05-20"


def _write(root, source, name, doc):
    path = os.path.join(root, f"source={source}", f"dt={DT}")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False, indent=2)


def nested(i, title="Baker"):
    return {"id": str(i), "title": title, "contract_time": "part_time",
            "contract_type": "contract", "created": 1700000000, "salary_min": 21500,
            "salary_max": 24800, "salary_is_predicted": "1", "latitude": 47.4,
            "longitude": 8.5, "redirect_url": "https://example.invalid/ad",
            "category": {"label": "Food", "tag": "food-jobs"},
            "company": {"display_name": "Backhaus Nord"},
            "location": {"display_name": "Altdorf", "area": ["CH", "Uri"]}}


FLAT = {"id": 88, "title": "Tram Driver", "company": "City Lines", "location": "Porto",
        "salary": "28k - 31k", "type": "Part-time", "link": "https://example.invalid/job",
        "updated": "2026-04-03T06:15:00", "snippet": "early shifts", "source": "jooble"}


def test_documents_of_both_feeds(spark, tmp_dir):
    bronze, silver = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    _write(bronze, "adzuna", "batch_1.json", {
        "batch_id": "1", "source": "adzuna", "ingested_at": "2026-05-20T08:00:00+00:00",
        "record_count": 2, "records": [nested(41), nested(42)]})
    _write(bronze, "adzuna", "batch_2.json", {
        "batch_id": "2", "source": "adzuna", "ingested_at": "2026-05-20T09:00:00+00:00",
        "record_count": 1, "records": [nested(41, "Head Baker")]})
    _write(bronze, "jooble", "batch_3.json", {
        "batch_id": "3", "source": "jooble", "ingested_at": "2026-05-20T08:00:00+00:00",
        "record_count": 1, "records": [FLAT]})
    for s in ("adzuna", "jooble"):
        run_bronze(spark, s, DT, bronze, multi_line=True)
    out = run_silver(spark, ["adzuna", "jooble"], DT, bronze, silver, fail_on=None,
                     multi_line=True)
    rows = {r["job_id"]: r for r in lake.read_silver(spark, silver, DT).collect()}
    assert sorted(rows) == ["adzuna_41", "adzuna_42", "jooble_88"]
    assert rows["adzuna_41"]["title"] == "Head Baker"
    assert str(rows["adzuna_41"]["posted_at"]) == "2023-11-14 22:13:20"
    j = rows["jooble_88"]
    assert (j["salary_min"], j["salary_max"]) == (28000.0, 31000.0)
    assert (j["contract_time"], j["contract_type"], j["category_label"]) == \
        ("PART_TIME", "UNKNOWN", "Uncategorized")
    assert out["metrics"]["duplicates_removed"] == 1
    assert out["sources"] == {"adzuna": 3, "jooble": 1}


def test_critical_check_keeps_the_stored_day(spark, tmp_dir):
    """Q8: nothing is published when a critical check fails."""
    bronze, silver = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    _write(bronze, "adzuna", "batch_1.json", {
        "batch_id": "1", "source": "adzuna", "ingested_at": "2026-05-20T08:00:00+00:00",
        "record_count": 1, "records": [nested(1)]})
    run_silver(spark, ["adzuna"], DT, bronze, silver, multi_line=True)
    swapped = nested(2) | {"salary_min": 9, "salary_max": 5}
    _write(bronze, "adzuna", "batch_2.json", {
        "batch_id": "2", "source": "adzuna", "ingested_at": "2026-05-20T09:00:00+00:00",
        "record_count": 1, "records": [swapped]})
    with pytest.raises(quality.QualityError):
        run_silver(spark, ["adzuna"], DT, bronze, silver, multi_line=True,
                   severities={"salary_order": "critical"})
    assert [r["job_id"] for r in lake.read_silver(spark, silver, DT).collect()] == ["adzuna_1"]
    run_silver(spark, ["adzuna"], DT, bronze, silver, multi_line=True)
    assert lake.read_silver(spark, silver, DT).count() == 2
    # the failed run's folder is gone: the two days published are all there is
    assert len(os.listdir(f"{silver}/dt={DT}")) == 2
