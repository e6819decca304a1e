import os

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows_of
from hirelake.operators.batches import build_batches
from hirelake.plans import feeds
from hirelake.plans.catalog import CATALOG
from hirelake.sources import lake
from hirelake.streaming import incremental_pipeline


def test_incremental_runs_match_batch(spark, tmp_dir):
    bronze, silver, gold, ckpt = (os.path.join(tmp_dir, x)
                                  for x in ("bronze", "silver", "gold", "ckpt"))
    # first arrival: only the flat feed and the morning nested batches
    nested = feeds.nested_source_rows(spark, SF_SMALL).select("k", "job.*")
    cols = [c for c in nested.columns if c != "k"]
    env = build_batches(nested, "adzuna", ["k"], 100, feeds.FIRST_INGEST, cols)
    lake.write_bronze(env.drop("batch_no"), bronze, "adzuna", feeds.RUN_DATE)
    flat = feeds.flat_source_rows(spark, SF_SMALL).select("k", "job.*")
    fenv = build_batches(flat, "jooble", ["k"], 100, feeds.FIRST_INGEST,
                         [c for c in flat.columns if c != "k"])
    lake.write_bronze(fenv.drop("batch_no"), bronze, "jooble", feeds.RUN_DATE)
    assert incremental_pipeline(spark, ["adzuna", "jooble"], bronze, silver, gold, ckpt,
                                exact_median=True, fail_on=None) == [feeds.RUN_DATE]
    # nothing new: nothing rebuilt
    assert incremental_pipeline(spark, ["adzuna", "jooble"], bronze, silver, gold, ckpt,
                                exact_median=True, fail_on=None) == []
    # evening batches arrive: the day is rebuilt and keeps the later copies
    upd = (feeds.nested_source_rows(spark, SF_SMALL)
           .where(F.col("k") % feeds.UPDATE_EVERY == feeds.UPDATE_AT)
           .select("k", F.col("job").withField("title", F.concat(
               F.col("job.title"), F.lit(feeds.UPDATE_SUFFIX))).alias("job"))
           .select("k", "job.*"))
    uenv = build_batches(upd, "adzuna", ["k"], 100, feeds.UPDATE_INGEST, cols)
    lake.write_bronze(uenv.drop("batch_no"), bronze, "adzuna", feeds.RUN_DATE)
    assert incremental_pipeline(spark, ["adzuna", "jooble"], bronze, silver, gold, ckpt,
                                exact_median=True, fail_on=None) == [feeds.RUN_DATE]
    expected = CATALOG["g7_jobs_summary"].run(spark, SF_SMALL)
    got = lake.read_gold(spark, gold, "jobs_summary", feeds.RUN_DATE).select(*expected.columns)
    assert rows_of(got) == rows_of(expected)


def _land(spark, bronze, source, dt, keep=20):
    rows = (feeds.nested_source_rows if source == "adzuna" else feeds.flat_source_rows)(
        spark, SF_SMALL).orderBy("k").limit(keep).select("k", "job.*")
    env = build_batches(rows, source, ["k"], 10, feeds.FIRST_INGEST,
                        [c for c in rows.columns if c != "k"])
    lake.write_bronze(env.drop("batch_no"), bronze, source, dt)


def test_days_of_one_source_do_not_hold_back_later_days(spark, tmp_dir):
    bronze, silver, gold, ckpt = (os.path.join(tmp_dir, x)
                                  for x in ("bronze", "silver", "gold", "ckpt"))
    _land(spark, bronze, "adzuna", "2026-05-18")
    _land(spark, bronze, "jooble", "2026-05-19")
    _land(spark, bronze, "adzuna", "2026-05-20")
    _land(spark, bronze, "jooble", "2026-05-20")
    days = ["2026-05-18", "2026-05-19", "2026-05-20"]
    assert incremental_pipeline(spark, ["adzuna", "jooble"], bronze, silver, gold, ckpt,
                                fail_on=None) == days
    counts = [lake.read_silver(spark, silver, d).groupBy("source").count().count() for d in days]
    assert counts == [1, 1, 2]


def test_gates_hold_for_new_files(spark, tmp_dir):
    bronze, silver, gold, ckpt = (os.path.join(tmp_dir, x)
                                  for x in ("bronze", "silver", "gold", "ckpt"))
    _land(spark, bronze, "adzuna", feeds.RUN_DATE)
    folder = lake.bronze_path(bronze, "adzuna", feeds.RUN_DATE)
    with open(os.path.join(folder, "bad.json"), "w", encoding="utf-8") as f:
        f.write('{"batch_id": "x", "source": "adzuna", "ingested_at": "y", "records": null}\n')
    with pytest.raises(Exception, match="corrupted"):
        incremental_pipeline(spark, ["adzuna"], bronze, silver, gold, ckpt, fail_on=None)
    assert not os.path.exists(f"{silver}/dt={feeds.RUN_DATE}")
