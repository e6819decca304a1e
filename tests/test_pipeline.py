import os

import pytest

from conftest import SF_SMALL, rows_of
from hirelake.plans import feeds
from hirelake.plans.catalog import CATALOG
from hirelake.plans.pipeline import parse_args, run_pipeline
from hirelake.sources import lake


@pytest.mark.parametrize("one_doc", [True, False])
def test_pipeline_end_to_end_matches_in_memory(spark, tmp_dir, one_doc):
    bronze, silver, gold = (os.path.join(tmp_dir, x) for x in ("bronze", "silver", "gold"))
    feeds.land_feeds(spark, SF_SMALL, bronze, one_document_per_file=one_doc)
    out = run_pipeline(spark, ["adzuna", "jooble"], feeds.RUN_DATE, bronze, silver, gold,
                       exact_median=True, fail_on=None, multi_line=one_doc)
    expected = CATALOG["g7_jobs_summary"].run(spark, SF_SMALL)
    got = lake.read_gold(spark, gold, "jobs_summary", feeds.RUN_DATE)
    assert rows_of(got.select(*expected.columns)) == rows_of(expected)
    m = out["silver"]["metrics"]
    assert m["silver_rows"] == out["gold"]["jobs_detail"]
    assert m["input_rows"] == m["null_job_ids"] + m["duplicates_removed"] + m["silver_rows"]
    assert "contract_type" in out["silver"].get("offenders", {})
    # rerun of the same day replaces it (dynamic partition overwrite), no duplicates
    run_pipeline(spark, ["adzuna", "jooble"], feeds.RUN_DATE, bronze, silver, gold,
                 fail_on=None, multi_line=one_doc)
    assert lake.read_silver(spark, silver, feeds.RUN_DATE).count() == m["silver_rows"]


def test_arguments():
    a = parse_args(["--date", "2026/05/20", "--bronze-root", "b", "--silver-root", "s",
                    "--gold-root", "g"])
    assert a.date == "2026-05-20" and a.sources == ["adzuna", "jooble"]
    with pytest.raises(SystemExit):
        parse_args(["--date", "2026-05-20", "--sources", "other", "--bronze-root", "b",
                    "--silver-root", "s", "--gold-root", "g"])
    with pytest.raises(SystemExit):
        parse_args(["--bronze-root", "b", "--silver-root", "s", "--gold-root", "g"])


def test_gold_salary_by_date(spark, tmp_dir):
    from hirelake.plans import catalog
    from hirelake.plans.pipeline import run_gold
    silver = os.path.join(tmp_dir, "silver")
    lake.write_silver(catalog.silver_table(spark, SF_SMALL), silver, feeds.RUN_DATE)
    run_gold(spark, feeds.RUN_DATE, silver, os.path.join(tmp_dir, "gold"), salary_by_date=True)
    sal = lake.read_gold(spark, os.path.join(tmp_dir, "gold"), "salary_analysis")
    assert sal.columns[0] == "ingestion_date"
    assert {r["ingestion_date"] for r in sal.collect()} == {feeds.INGESTION_DATE}
