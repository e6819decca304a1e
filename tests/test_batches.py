from pyspark.sql import functions as F

from conftest import rows_of
from hirelake.operators import batches, bronze


def test_batches_are_exact_chunks_in_order(spark):
    recs = spark.range(0, 250).select((F.col("id") * 7 % 250).alias("k"),
                                      F.concat(F.lit("t"), F.col("id")).alias("title"))
    env = batches.build_batches(recs, "adzuna", ["k"], batch_size=100,
                                ingested_at="2026-05-20T00:00:00+00:00")
    rows = sorted(env.collect(), key=lambda r: r["batch_no"])
    assert [r["record_count"] for r in rows] == [100, 100, 50]
    keys = [rec["k"] for r in rows for rec in r["records"]]
    assert keys == list(range(250))
    assert len({r["batch_id"] for r in rows}) == 3
    # explode gives the input back
    back = bronze.explode_records(env).select("job.k", "job.title")
    assert rows_of(back) == rows_of(recs)
    # deterministic ids on a rerun
    again = batches.build_batches(recs, "adzuna", ["k"], 100, "2026-05-20T00:00:00+00:00")
    assert {r["batch_id"] for r in again.collect()} == {r["batch_id"] for r in rows}


def test_empty_input_gives_no_batch(spark):
    recs = spark.range(0).select(F.col("id").alias("k"))
    assert batches.build_batches(recs, "adzuna", ["k"], 10, "t").count() == 0


def test_pages_stop_at_first_empty_page(spark):
    schema = "country string, page int, results array<struct<id:string>>"
    pages = spark.createDataFrame([
        ("gb", 1, [{"id": "1"}, {"id": "2"}]),
        ("gb", 2, [{"id": "3"}]),
        ("gb", 3, []),
        ("gb", 4, [{"id": "9"}]),
        ("vn", 1, [{"id": "4"}]),
        ("vn", 2, None),
        ("vn", 3, [{"id": "8"}]),
        ("us", 1, [{"id": "5"}]),
        ("us", 2, [{"id": "6"}]),
        ("us", 3, [{"id": "7"}])], schema)
    out = batches.flatten_pages(pages, "results", max_pages=2, country_tag=True)
    got = sorted((r["country"], r["page"], r["pos"], r["record"]["id"],
                  r["record"]["_source_country"]) for r in out.collect())
    assert got == [("gb", 1, 0, "1", "gb"), ("gb", 1, 1, "2", "gb"), ("gb", 2, 0, "3", "gb"),
                   ("us", 1, 0, "5", "us"), ("us", 2, 0, "6", "us"), ("vn", 1, 0, "4", "vn")]


def test_registry_pages(spark):
    from hirelake.sources.registry import flatten_source_pages
    pages = spark.createDataFrame(
        [("remote", 1, [{"id": "1"}]), ("remote", 2, [])],
        "country string, page int, jobs array<struct<id:string>>")
    out = flatten_source_pages(pages, "jooble")
    assert [r["record"]["id"] for r in out.collect()] == ["1"]
    assert "_source_country" not in out.schema["record"].dataType.fieldNames()
