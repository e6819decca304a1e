"""What a job leaves on disk while it runs: shuffles, positions, Bronze text, and rows that
move without need."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows_of
from hirelake.operators import silver
from hirelake.operators.batches import build_batches
from hirelake.plans import catalog, feeds
from hirelake.plans.pipeline import run_pipeline
from hirelake.session import checkpoint_dir, passing, stored
from hirelake.sources import lake, versions
from hirelake.streaming import incremental_pipeline
from test_versions import _jobs

DT = feeds.RUN_DATE
SOURCES = ["adzuna", "jooble"]


def _shuffled(spark):
    """Shuffle blocks that are on disk."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for i in range(blocks.size()) if (n := blocks.apply(i).name()).startswith("shuffle_")}


def _scratch(spark, name):
    return glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/{name}-*")


def test_landing_leaves_only_its_documents(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(lake, "DOCUMENTS_PER_FILE", 4)
    rdds, positions = _scratch(spark, "rdd"), _scratch(spark, "positions")
    blocks = _shuffled(spark)
    feeds.land_feeds(spark, SF_SMALL, tmp_dir)
    assert _scratch(spark, "rdd") == rdds and _scratch(spark, "positions") == positions
    assert not _shuffled(spark) - blocks
    files = glob.glob(f"{tmp_dir}/source=*/dt={DT}/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    lines = [gzip.open(f).read().count(b"\n") for f in files]
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    late = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 50 = 1").count()
    parts = spark.read.parquet(f"{SF_SMALL}/part.parquet").count()
    assert max(lines) <= 4 and sum(lines) == sum(-(-n // 100) for n in (orders, late, parts))


def _silver_plans(monkeypatch, run):
    """The plans of the rows that are written to Silver as ``run`` goes."""
    plans, write = [], lake._write_buckets

    def seen(df, path, dealt=False):
        out = df if dealt else df.hint("rebalance", F.col("bucket"))
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return write(df, path, dealt)
    monkeypatch.setattr(lake, "_write_buckets", seen)
    run()
    return plans


@pytest.mark.parametrize("job", ["batch", "incremental"])
def test_silver_rows_are_shuffled_once(spark, tmp_dir, monkeypatch, job):
    roots = [os.path.join(tmp_dir, x) for x in ("bronze", "silver", "gold", "checkpoints")]
    feeds.land_feeds(spark, SF_SMALL, roots[0])
    run = (lambda: run_pipeline(spark, SOURCES, DT, *roots[:3], fail_on=None)) if job == "batch" else (
        lambda: incremental_pipeline(spark, SOURCES, *roots, fail_on=None))
    plans = _silver_plans(monkeypatch, run)
    assert len(plans) == 1 and plans[0].count("Exchange ") == 1
    assert plans[0].index("ENSURE_REQUIREMENTS") < plans[0].index("partial_max")   # folded before it
    expected = catalog.CATALOG["n14_silver"].run(spark, SF_SMALL)
    got = catalog._ts(lake.read_silver(spark, roots[1], DT))
    assert rows_of(got.select(*expected.columns)) == rows_of(expected)


def _deduplicated(monkeypatch):
    """The rows that merges send to deduplication."""
    sizes, dedup = [], lake.deduplicate_latest

    def seen(df, *args, **kw):
        sizes.append(df.count())
        return dedup(df, *args, **kw)
    monkeypatch.setattr(lake, "deduplicate_latest", seen)
    return sizes


@pytest.mark.parametrize("few", [True, False])
def test_merge_moves_only_contested_rows(spark, tmp_dir, monkeypatch, few):
    if not few:
        monkeypatch.setattr(lake, "BROADCAST_JOBS", 0)
    old = _jobs(spark, [(f"j{i}", "old", "2026-05-20T08:00:00", "b1") for i in range(300)]
                + [(None, "no id", "2026-05-20T08:00:00", "b1"),
                   ("twice", "early", "2026-05-20T06:00:00", "b1"), ("twice", "later", "2026-05-20T07:00:00", "b1")])
    lake.write_silver(old, tmp_dir, DT)
    late = _jobs(spark, [(f"j{i}", "new", "2026-05-20T09:00:00", "b2") for i in range(0, 300, 3)]
                 + [("j1", "stale", "2026-05-20T07:00:00", "b0"), (None, "late", "2026-05-20T09:00:00", "b2"),
                    ("fresh", "one", "2026-05-20T09:00:00", "b2"), ("fresh", "two", "2026-05-20T10:00:00", "b2")])
    sizes = _deduplicated(monkeypatch)
    lake.merge_silver(late, tmp_dir, DT).publish()
    whole = silver.deduplicate_latest(old.unionByName(late)).select(*silver.SILVER_COLUMNS)
    assert rows_of(lake.read_silver(spark, tmp_dir, DT)) == rows_of(whole)
    # the batch, the stored copies of its jobs, and the job that is stored twice
    assert sizes == [104 + 102 + 2 if few else 104 + 303]
    assert not _scratch(spark, "merge-batch") and not _scratch(spark, "merge-jobs")


def test_days_keep_the_hash_of_their_buckets(spark, tmp_dir):
    """A day that was written when buckets had another hash: its log names none."""
    rows = _jobs(spark, [(f"j{i}", "old", "2026-05-20T08:00:00", "b1") for i in range(200)])
    run = versions.new_run(DT)
    held = lake._write_buckets(rows.withColumn("bucket", lake._bucket(16, "xxhash64")), f"{tmp_dir}/{run}")
    versions.publish(spark, tmp_dir, DT, None, rows.schema.json(),
                     {str(b): f"{run}/bucket={b}" for b in held}, 16)
    for title in ("new", "newer"):
        late = _jobs(spark, [(f"j{i}", title, f"2026-05-20T{10 + len(title)}:00:00", "b2") for i in range(0, 200, 2)])
        lake.merge_silver(late, tmp_dir, DT).publish()
        titles = [(r["job_id"], r["title"]) for r in lake.read_silver(spark, tmp_dir, DT).collect()]
        assert sorted(titles) == sorted((f"j{i}", "old" if i % 2 else title) for i in range(200))
    lake.write_silver(rows, tmp_dir, DT)
    assert versions.current(spark, tmp_dir, DT).hashed == lake.HASHED


def test_batches_of_columns_that_parquet_cannot_hold(spark):
    recs = spark.range(30).select(F.col("id").alias("k"), F.lit(None).alias("nothing"))
    env = build_batches(recs, "adzuna", ["k"], 20, "t")
    assert sorted((r["record_count"], r["records"][0]["nothing"]) for r in env.collect()) == [(10, None), (20, None)]
    # keys that repeat: still whole batches
    env = build_batches(recs.select((F.col("k") % 2).alias("k"), F.col("k").alias("v")), "adzuna", ["k"], 20, "t")
    got = env.collect()
    assert sorted(r["record_count"] for r in got) == [10, 20]
    assert sorted(x["v"] for r in got for x in r["records"]) == list(range(30))


def test_passing_tables_are_deleted(spark):
    rows = spark.range(10)
    kept = stored(rows, "stays")
    with passing(spark):
        with passing(spark):
            assert stored(rows, "inner").count() == 10
        assert not _scratch(spark, "inner")
        assert stored(rows, "outer").count() == 10
    assert not _scratch(spark, "outer") and kept.count() == 10
