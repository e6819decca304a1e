"""S3 over several runs: batches stay full, nothing is lost or landed twice."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from hirelake.sources import carry, versions

SCHEMA = StructType([
    StructField("batch_id", StringType()), StructField("source", StringType()),
    StructField("ingested_at", StringType()), StructField("record_count", LongType()),
    StructField("records", ArrayType(StructType([
        StructField("k", LongType()), StructField("t", StringType()),
        StructField("more", StringType())])))])


def _rows(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"))


def _landed(spark, root, dt=None):
    rows = carry.read_landed(spark, root, "adzuna", dt, SCHEMA).collect()
    return sorted(([x["k"] for x in r["records"]] for r in rows)), [r["batch_id"] for r in rows]


def _land(spark, root, lo, hi, token, dt="2026-05-20"):
    return carry.land(_rows(spark, lo, hi), root, "adzuna", dt, token, ["k"], 10, f"at {token}")


def test_rests_are_carried_from_run_to_run(spark, tmp_dir):
    assert _land(spark, tmp_dir, 0, 4, "a") == {"batches": 0, "carried": 4}
    assert _landed(spark, tmp_dir) == ([], [])
    assert _land(spark, tmp_dir, 4, 27, "b") == {"batches": 2, "carried": 7}
    assert _land(spark, tmp_dir, 27, 27, "c") == {"batches": 0, "carried": 7}
    assert _land(spark, tmp_dir, 27, 43, "d", "2026-05-21") == {"batches": 2, "carried": 3}
    got, ids = _landed(spark, tmp_dir)
    assert got == [list(range(i, i + 10)) for i in range(0, 40, 10)] and len(set(ids)) == 4
    assert len(_landed(spark, tmp_dir, "2026-05-21")[0]) == 2
    assert carry.close(spark, tmp_dir, "adzuna", "2026-05-21", "end", 10) == {"batches": 1, "carried": 0}
    assert _landed(spark, tmp_dir)[0][-1] == [40, 41, 42]
    assert carry.close(spark, tmp_dir, "adzuna", "2026-05-21", "again", 10) == {"batches": 0, "carried": 0}
    assert len(_landed(spark, tmp_dir)[0]) == 5


def test_a_repeated_run_lands_nothing_and_a_crashed_one_starts_again(spark, tmp_dir, monkeypatch):
    _land(spark, tmp_dir, 0, 15, "a")
    before = _landed(spark, tmp_dir)
    assert _land(spark, tmp_dir, 0, 15, "a") == {"batches": 1, "carried": 5}
    assert _landed(spark, tmp_dir) == before

    def broken(*args, **kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", broken)
        with pytest.raises(RuntimeError):
            _land(spark, tmp_dir, 15, 30, "b")
    assert _landed(spark, tmp_dir) == before            # its files are there, but count for nothing
    assert _land(spark, tmp_dir, 15, 30, "b") == {"batches": 2, "carried": 0}
    assert _landed(spark, tmp_dir)[0] == [list(range(i, i + 10)) for i in range(0, 30, 10)]
    folder = os.path.join(tmp_dir, "source=adzuna", f"dt={carry.EVER}")
    assert len(os.listdir(folder)) == 2                  # the crashed run's folder is gone


def test_columns_that_one_run_lacks_are_null(spark, tmp_dir):
    _land(spark, tmp_dir, 0, 5, "a")
    carry.land(_rows(spark, 5, 10).withColumn("more", F.lit("x")), tmp_dir, "adzuna", "2026-05-20",
               "b", ["k"], 10, "t")
    row = carry.read_landed(spark, tmp_dir, "adzuna", None, SCHEMA).first()
    assert [(x["k"], x["more"]) for x in row["records"]] == [
        (i, None if i < 5 else "x") for i in range(10)]


def test_close_without_state(spark, tmp_dir):
    assert carry.close(spark, tmp_dir, "adzuna", "2026-05-20", "t") == {"batches": 0, "carried": 0}
    assert _landed(spark, tmp_dir) == ([], [])


def test_stream_lands_full_batches_over_restarts(spark, tmp_dir):
    from hirelake.streaming.landing import land_stream
    new, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    for lo, hi, batches in ((0, 13, 1), (13, 18, 1), (18, 45, 4)):
        _rows(spark, lo, hi).write.mode("append").parquet(new)
        stream = spark.readStream.schema("k long, t string").parquet(new)
        land_stream(stream, root, "adzuna", "2026-05-20", os.path.join(tmp_dir, "state"), ["k"], 10)
        got, ids = _landed(spark, root)
        assert [len(g) for g in got] == [10] * batches and len(set(ids)) == batches
    carry.close(spark, root, "adzuna", "2026-05-20", "end", 10)
    assert sorted(k for g in _landed(spark, root)[0] for k in g) == list(range(45))
