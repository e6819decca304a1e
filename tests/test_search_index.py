"""Keyword search over stored files: equal rows, files left closed."""

import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows_of
from hirelake.operators import gold, serve
from hirelake.plans import catalog
from hirelake.sources import lake, search_index

DT = "2026-05-20"
KEYWORDS = ["high|urgent", "URGENT", "brand#1[0-9] |furniture", "machinery", "no such words at all", "ma", "",
            "(building|machinery)", "auto.*bile", "colou?red", "x{2}yz", "1-urg", "furniture ", "ürgent", "a|machinery",
            "5-low$", "^order"]


@pytest.fixture(scope="module")
def stored_gold(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    detail = gold.jobs_detail(catalog.silver_table(spark, SF_SMALL)).repartitionByRange(12, "category_label", "title")
    lake.write_gold(detail, root, "jobs_detail", DT)
    return root


@pytest.mark.parametrize("indexed", [False, True])
def test_rows_are_those_of_a_scan(spark, stored_gold, indexed):
    if indexed:
        search_index.index_search(spark, stored_gold, DT)
    whole = lake.read_gold(spark, stored_gold, "jobs_detail", DT)
    for keyword in KEYWORDS:
        got, files = search_index.search_detail(spark, stored_gold, DT, keyword)
        assert rows_of(got) == rows_of(serve.keyword_search(whole, keyword)), keyword
        assert files["files"] >= 12 and files["read"] <= files["files"]
        if not indexed:
            assert files["read"] == files["files"]
    got, files = search_index.search_detail(spark, stored_gold, DT, "brand#1[0-9", literal=True)
    assert rows_of(got) == rows_of(serve.keyword_search(whole, "brand#1[0-9", literal=True))


def test_files_are_left_closed(spark, stored_gold):
    search_index.index_search(spark, stored_gold, DT)
    assert search_index.search_detail(spark, stored_gold, DT, "no such words at all")[1]["read"] == 0
    wide = lake.read_gold(spark, stored_gold, "jobs_detail", DT).where("category_label LIKE '% %'")
    label = wide.agg(F.min("category_label")).first()[0]      # a segment and a nation
    found, files = search_index.search_detail(spark, stored_gold, DT, label, literal=True)
    assert 0 < files["read"] < files["files"] and found.count() > 0


def test_letters_that_only_case_makes_equal(spark, tmp_path):
    rows = [("1", "maſter of diſhes"), ("2", "master"), ("3", "fısh")]
    detail = spark.createDataFrame(rows, "job_id string, job_search_text string")
    lake.write_gold(detail, str(tmp_path), "jobs_detail", DT)
    search_index.index_search(spark, str(tmp_path), DT)
    for keyword in ("master", "fish", "dish"):
        got, _ = search_index.search_detail(spark, str(tmp_path), DT, keyword)
        assert rows_of(got) == rows_of(detail.where(F.col("job_search_text").rlike("(?iu)" + keyword)))


@settings(max_examples=300, deadline=None)
@given(st.text("abc.|[]*+?^$ {1}", max_size=12), st.text("abc ", max_size=20))
def test_required_grams_are_in_every_match(pattern, text):
    try:
        found = re.search(pattern, text)
    except (re.error, FutureWarning):
        return
    wanted = search_index.required_grams(pattern)
    if found and wanted is not None:
        grams = {text[i:i + 3] for i in range(len(text) - 2)}
        assert any(w <= grams for w in wanted)


def test_grams_of_plain_words():
    assert search_index.required_grams("Java|c++") is None            # 'c' alone could be all
    assert search_index.required_grams("java|rust") == [{"jav", "ava"}, {"rus", "ust"}]
    assert search_index.required_grams("data.engineer?s") == [
        {"dat", "ata", "eng", "ngi", "gin", "ine", "nee"}]
    assert set(string.ascii_lowercase) >= {c for g in search_index.required_grams("abcd")[0] for c in g}
