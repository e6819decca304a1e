import hashlib

import pytest
from pyspark.sql import functions as F

from hirelake.functions import (classify_contract_time, classify_contract_type, entity_key,
                                category_key, keyword_match, parse_salary_text, scale_salary,
                                search_text, standardize_code, to_date_path, to_dt)

# N4 cases: (text, min, max) as the parser must give them.
SALARY_CASES = [
    ("$64,000 - $81,000 a year", 64000.0, 81000.0),
    ("38k - 52k", 38000.0, 52000.0),
    ("70-90k", 70.0, 90000.0),
    ("$25 per hour + 401k", 25.0, 401000.0),
    ("1.5 K", 1500.0, 1500.0),
    ("10 km", 10000.0, 10000.0),
    ("$90k-$70k", 70000.0, 90000.0),
    ("1.2.3k", 1.2, 3000.0),
    ("", None, None),
    (None, None, None),
    ("DOE", None, None),
    ("45 k", 45000.0, 45000.0),
    ("30000", 30000.0, 30000.0),
]


def test_salary_parser_table(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in SALARY_CASES], "s string")
    got = [(r["s"], r["p"]["min"], r["p"]["max"]) for r in
           df.select("s", parse_salary_text("s").alias("p")).collect()]
    assert got == SALARY_CASES


def test_salary_parser_has_no_python_node(spark):
    df = spark.createDataFrame([("45k",)], "s string").select(parse_salary_text("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("value,expected", [
    (999.0, 999000.0), (1000.0, 1000.0), (0.0, 0.0), (-5.0, -5000.0), (None, None),
    (30000.0, 30000.0)])
def test_scale_salary(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(scale_salary("v").alias("x")).first()["x"] == expected


@pytest.mark.parametrize("text,time_code,type_code", [
    ("Full-time, Permanent", "FULL_TIME", "PERMANENT"),
    ("Part-time", "PART_TIME", None),
    ("Contract", None, "CONTRACT"),
    ("Temporary", None, "TEMPORARY"),
    ("Internship", None, None),
    ("permanent contract, full time", "FULL_TIME", "CONTRACT"),
    (None, None, None),
])
def test_contract_classifiers(spark, text, time_code, type_code):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(classify_contract_time("t").alias("a"),
                  classify_contract_type("t").alias("b")).first()
    assert (r["a"], r["b"]) == (time_code, type_code)


@pytest.mark.parametrize("value,expected", [
    (" full_time ", "FULL_TIME"), (None, "UNKNOWN"), ("", ""), ("\tx", "\tX"),
    ("permanent", "PERMANENT")])
def test_standardize_code(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(standardize_code("v").alias("x")).first()["x"] == expected


def test_entity_keys_are_sha256_hex(spark):
    df = spark.createDataFrame([("IT", "it-jobs", "ABC"), (None, None, None)],
                               "l string, t string, c string")
    rows = df.select(category_key("l", "t").alias("cat"), entity_key("c").alias("co")).collect()
    assert rows[0]["cat"] == hashlib.sha256(b"IT||it-jobs").hexdigest()
    assert rows[0]["co"] == hashlib.sha256(b"ABC").hexdigest()
    assert rows[1]["cat"] == hashlib.sha256(b"||").hexdigest()
    assert rows[1]["co"] == hashlib.sha256(b"").hexdigest()


def test_search_text_and_keyword(spark):
    df = spark.createDataFrame([("Data Engineer", None, "IT")], "a string, b string, c string")
    r = df.select(search_text("a", "b", "c").alias("s"),
                  search_text("a", "b", "c", null_as_empty=True).alias("f")).first()
    assert r["s"] == "data engineer it"
    assert r["f"] == "data engineer  it"
    df2 = spark.createDataFrame([("data engineer it",), (None,), ("sales",)], "s string")
    assert df2.where(keyword_match("s", "ENGINEER|sale")).count() == 2
    assert df2.where(keyword_match("s", "engineer it", literal=True)).count() == 1
    assert df2.where(keyword_match("s", "eng.neer", literal=True)).count() == 0


def test_run_dates():
    assert to_date_path("2026-05-20") == "2026/05/20"
    assert to_dt("2026/05/20") == "2026-05-20"
    with pytest.raises(ValueError):
        to_dt("2026-13-01")


def test_salary_digits_of_other_scripts(spark):
    texts = ["\u0663\u0660\u0660\u0660 - \u0664\u0665\u0660\u0660.\u0665", "\uff15\uff10k", "\U0001d7d9\U0001d7d8k a year", "\u4e09"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_salary_text("t").alias("p"))
    assert [tuple(r.p) for r in got.collect()] == [(3000.0, 4500.5), (50000.0, 50000.0), (10000.0, 10000.0),
                                                   (None, None)]
