"""Q6 top values by sketch and recount, Q7 in one pass, D1 in one scan."""

import random
from collections import Counter

import pytest

from hirelake.functions.contract import CONTRACT_TIME_DOMAIN
from hirelake.operators import quality, serve

COLUMNS = "job_id string, title string, company_name string, salary_min double, salary_max double, " \
          "contract_type string, contract_time string"


def _frame(spark, times):
    return spark.createDataFrame(
        [(f"j{i % 50}", None if i % 7 == 0 else "t", "c", 2.0, 1.0 if i % 5 == 0 else 3.0, "PERMANENT", t)
         for i, t in enumerate(times)], COLUMNS).repartition(4)


@pytest.mark.parametrize("buckets", [1, 8, 1 << 14])
@pytest.mark.parametrize("n", [1, 5, 400])
def test_top_values_are_exact(spark, buckets, n):
    dice = random.Random(buckets + n)
    times = [f"v{min(dice.randrange(1, 300), dice.randrange(1, 300))}" for _ in range(1500)]
    times += ["hot"] * 700 + [None] * 20 + ["FULL_TIME"] * 300
    got = quality.top_offenders(_frame(spark, times), ["contract_type", "contract_time"], n, buckets)
    bad = Counter(t for t in times if t is not None and t not in CONTRACT_TIME_DOMAIN)
    want = sorted(bad.items(), key=lambda x: (-x[1], x[0]))[:n]
    rows = sorted(got.collect(), key=lambda r: r["place"])
    assert [(r["field"], r["place"], r["value"], r["count"]) for r in rows] == [
        ("contract_time", k + 1, v, c) for k, (v, c) in enumerate(want)]


def test_no_offenders(spark):
    assert quality.top_offenders(_frame(spark, ["FULL_TIME"] * 9), ["contract_time"]).collect() == []


def test_report_reads_its_input_once(spark):
    df = _frame(spark, ["x", "FULL_TIME", None] * 100)
    report = quality.quality_report(df)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
    got = {(r["check"], r["column"]): r["failed"] for r in report.collect()}
    assert got["duplicates", "job_id"] == 50
    assert got["contract_time_domain", "contract_time"] == 100
    assert got["required_field", "title"] == 43 and got["salary_order", "salary_min,salary_max"] == 60
    empty = quality.quality_report(df.limit(0))
    assert {r["failed"] for r in empty.collect()} == {0} and empty.count() == 7


def test_facets_in_one_scan(spark):
    rows = [("d1", "b", "FULL_TIME", "s"), ("d1", None, "FULL_TIME", "s"), ("d2", "a", None, "s")]
    df = spark.createDataFrame(rows, "ingestion_date string, category_label string, contract_time string, source string")
    table = serve.facet_table(df)
    assert {tuple(r) for r in table.collect()} == {
        ("ingestion_date", 1, "d1", 2), ("ingestion_date", 2, "d2", 1), ("category_label", 1, "a", 1),
        ("category_label", 2, "b", 1), ("contract_time", 1, "FULL_TIME", 2), ("source", 1, "s", 3)}
    assert table._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
