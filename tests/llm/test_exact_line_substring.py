"""Operators 2, 5 and 8 against plain Python, on odd and on given documents."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import brute
from hirelake.llm import exact_dedup, line_dedup, substring_dedup


def _docs(spark, name):
    if name == "odd":
        return brute.odd_documents(spark)
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    return docs.limit(0) if name == "empty" else docs


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


CASES = pytest.mark.parametrize("name", ["odd", "small", "empty"])


@CASES
def test_exact_groups(spark, name):
    docs = _docs(spark, name)
    want = brute.exact(_pairs(docs))
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.doc_id, r.text_sha256]
        assert r.kept == (r.doc_id == r.keep_id)


@pytest.mark.parametrize("step", [2, 10_000])
def test_exact_query_gives_every_row(spark, tmp_dir, monkeypatch, step):
    """As often as the query's SQL, and of each group one row stays."""
    monkeypatch.setattr(exact_dedup, "STEP", step)
    rows = [(None, "one"), (None, "one "), (None, "one"), (3, "one"), (3, "one"), (2, "one"),
            (None, "alone"), (None, "alone"), (5, "x  y"), (6, None), (6, ""), (6, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM "
                f"read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    pick = "doc_id, keep_id, group_size, text_sha256, kept"
    want = con.sql(f"SELECT {pick} FROM ({exact_dedup.SQL})").fetchall()
    got = exact_dedup.run(spark, tmp_dir)
    order = lambda r: (r[3], r[0] is None, r[0] or 0, r[4])
    assert sorted(map(tuple, got.select(*pick.split(", ")).collect()), key=order) == sorted(
        want, key=order)
    assert got.count() == len(rows)
    assert got.filter("kept").count() == got.select("text_sha256").distinct().count()


def test_exact_groups_tell_collisions_apart(spark):
    docs = _docs(spark, "small")
    weak = exact_dedup.exact_groups(docs, hash_of=lambda t: F.length(t) % 3)
    assert sorted(map(tuple, weak.collect())) == sorted(
        map(tuple, exact_dedup.exact_groups(docs).collect()))


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    docs = _docs(spark, "odd")
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    texts = [brute.SPACES.sub(" ", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({brute.SPACES.sub(" ", t or "") for _, t in brute.TEXTS})


@CASES
def test_line_dedup(spark, name):
    docs = _docs(spark, name)
    rows = _pairs(docs)
    kept = line_dedup.line_dedup(docs)
    assert kept.columns == docs.columns
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    got = sorted(_pairs(kept), key=key)
    want = sorted(zip([i for i, _ in rows], brute.line_cut(rows)), key=key)
    assert [(i, t or "") for i, t in got] == [(i, t or "") for i, t in want]


@CASES
def test_substring_dedup(spark, name):
    docs = _docs(spark, name)
    rows = _pairs(docs)
    kept = substring_dedup.substring_dedup(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or -1, r.text) for r in kept.collect())
    assert got == sorted((i or -1, k) for (i, _), (_, _, k) in zip(rows, brute.substring(rows)))


@pytest.mark.parametrize("window", [1, 3, 80])
def test_substring_windows(spark, window):
    docs = brute.odd_documents(spark)
    rows = _pairs(docs)
    got = substring_dedup.substring_dedup(docs, window=window).collect()
    assert sorted((r.doc_id or -1, r.text) for r in got) == sorted(
        (i or -1, k) for (i, _), (_, _, k) in zip(rows, brute.substring(rows, window)))


def test_substring_query(spark):
    rows = _pairs(_docs(spark, "small"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring_dedup.run(spark, brute.SMALL).collect()}
    assert got == {i: (n, gone, hashlib.sha256(k.encode()).hexdigest())
                   for (i, _), (n, gone, k) in zip(rows, brute.substring(rows))}
