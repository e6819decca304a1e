"""Bounds and first jobs by the ranges of stored files: equal rows, files left closed."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows_of
from hirelake.operators import gold, serve
from hirelake.plans import catalog
from hirelake.sources import file_ranges, lake

DT = "2026-05-20"
SORTS = [serve.SORT_NEWEST, serve.SORT_HIGHEST, serve.SORT_LOWEST]


def _store(spark, root, detail):
    lake.write_gold(detail, root, "jobs_detail", DT)
    return lake.read_gold(spark, root, "jobs_detail", DT)


@pytest.fixture(scope="module")
def detail(spark):
    return gold.jobs_detail(catalog.silver_table(spark, SF_SMALL))


@pytest.mark.parametrize("by", ["salary_avg", "category_label"])
def test_rows_are_those_of_a_scan(spark, detail, tmp_path, by):
    root = str(tmp_path)
    whole = _store(spark, root, detail.repartitionByRange(12, by))
    for indexed in (False, True):
        if indexed:
            file_ranges.index_ranges(spark, root, DT)
        assert rows_of(file_ranges.salary_bounds(spark, root, DT)) == rows_of(serve.salary_bounds(whole))
        for how in SORTS + [serve.SORT_DEFAULT]:
            got, files = file_ranges.top_jobs(spark, root, DT, how, 15)
            if how in SORTS:
                assert [tuple(r) for r in got.collect()] == [
                    tuple(r) for r in serve.top_jobs(whole, how, 15).collect()], how
            assert files["read"] <= files["files"]
            if indexed and by == "salary_avg" and how in SORTS[1:]:
                assert files["files"] >= 8 and files["read"] <= 3


def test_ties_reach_into_other_files(spark, detail, tmp_path):
    # one salary in every file, so that job_id alone decides; every file may hold a first job
    same = detail.withColumn("salary_avg", F.lit(5.0)).repartition(6, "job_id")
    whole = _store(spark, str(tmp_path), same)
    file_ranges.index_ranges(spark, str(tmp_path), DT)
    got, files = file_ranges.top_jobs(spark, str(tmp_path), DT, serve.SORT_HIGHEST, 10)
    assert [r.job_id for r in got.collect()] == [
        r.job_id for r in serve.top_jobs(whole, serve.SORT_HIGHEST, 10).collect()]
    assert files["read"] == files["files"]


def test_few_or_no_values(spark, detail, tmp_path):
    few = detail.orderBy("job_id").limit(30).withColumn(
        "salary_avg", F.when(F.col("job_id") == F.lit(detail.agg(F.min("job_id")).first()[0]), 7.0))
    for name, rows in (("few", few), ("none", few.limit(0)),
                       ("nulls", few.withColumn("salary_avg", F.lit(None).cast("double")))):
        root = str(tmp_path / name)
        whole = _store(spark, root, rows)
        file_ranges.index_ranges(spark, root, DT)
        got, _ = file_ranges.top_jobs(spark, root, DT, serve.SORT_LOWEST, 10)
        assert [tuple(r) for r in got.collect()] == [
            tuple(r) for r in serve.top_jobs(whole, serve.SORT_LOWEST, 10).collect()], name
        assert rows_of(file_ranges.salary_bounds(spark, root, DT)) == rows_of(serve.salary_bounds(whole))


def test_no_stored_day(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        file_ranges.top_jobs(spark, str(tmp_path), DT)
