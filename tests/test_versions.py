"""Days as versions: readers during a publish, crashes at each step, keyed merges."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows_of
from hirelake.operators import silver
from hirelake.plans import catalog, feeds
from hirelake.sources import lake, versions

DT = "2026-05-20"


def _jobs(spark, rows):
    """Finished Silver rows of (id, title, ingested_at, batch_id)."""
    base = spark.createDataFrame(rows, "job_id string, title string, ingested_at string, batch_id string")
    kinds = {"salary_min": "double", "salary_max": "double", "salary_is_predicted": "boolean",
             "latitude": "double", "longitude": "double", "posted_at": "timestamp"}
    for c in silver.SILVER_COLUMNS:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast(kinds.get(c, "string")))
    return base.select(*silver.SILVER_COLUMNS, *silver.LINEAGE_COLUMNS)


def _files(root, dt=DT):
    """Data files of the day's current entry with their time of change."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(f"{root}/dt={dt}") for f in names if f.endswith(".parquet")}


def _titles(spark, root):
    return {r["job_id"]: r["title"] for r in lake.read_silver(spark, root, DT).collect()}


def test_merge_rewrites_only_touched_buckets(spark, tmp_dir):
    first = _jobs(spark, [(f"j{i}", "old", "2026-05-20T08:00:00", "b1") for i in range(200)])
    lake.write_silver(first, tmp_dir, DT)
    before, paths = _files(tmp_dir), versions.current(spark, tmp_dir, DT).paths
    late = _jobs(spark, [("j3", "new", "2026-05-20T09:00:00", "b2"), ("j3", "mid", "2026-05-20T08:30:00", "b3"),
                         ("j5", "stale", "2026-05-20T07:00:00", "b0")])
    touched = {str(r[0]) for r in late.select(lake._bucket(lake.BUCKETS)).distinct().collect()}
    staged = lake.merge_silver(late, tmp_dir, DT)
    assert _titles(spark, tmp_dir)["j3"] == "old"             # not yet published
    staged.publish()
    after = versions.current(spark, tmp_dir, DT)
    assert {b for b in paths if after.paths[b] != paths[b]} == touched and len(touched) < len(paths)
    now = _files(tmp_dir)
    assert all(now[f] == t for f, t in before.items())        # old files are as they were
    titles = _titles(spark, tmp_dir)
    assert titles["j3"] == "new" and titles["j5"] == "old" and len(titles) == 200
    # the same batch again changes no row
    lake.merge_silver(late, tmp_dir, DT).publish()
    assert _titles(spark, tmp_dir) == titles


def test_merges_in_any_order_equal_one_batch(spark, tmp_dir):
    rows = catalog.all_norm(spark, SF_SMALL)
    part = F.pmod(F.xxhash64("job_id", "batch_id", "ingested_at"), F.lit(4))
    for name, order in (("a", [0, 1, 2, 3]), ("b", [3, 1, 0, 2])):
        for k in order:
            lake.merge_silver(silver.silver_transform(rows.where(part == k), keep_lineage=True),
                              f"{tmp_dir}/{name}", DT).publish()
        got = lake.read_silver(spark, f"{tmp_dir}/{name}", DT)
        assert rows_of(got) == rows_of(catalog.silver_table(spark, SF_SMALL).select(*got.columns))


def test_reader_during_publish_sees_the_old_day(spark, tmp_dir):
    lake.write_silver(_jobs(spark, [("a", "one", "x", "b")]), tmp_dir, DT)
    reader = lake.read_silver(spark, tmp_dir, DT)             # has resolved the first version
    lake.write_silver(_jobs(spark, [("a", "two", "x", "b")]), tmp_dir, DT)
    assert [r["title"] for r in reader.collect()] == ["one"]
    assert _titles(spark, tmp_dir) == {"a": "two"}
    lake.write_silver(_jobs(spark, [("a", "three", "x", "b")]), tmp_dir, DT)
    assert len(os.listdir(f"{tmp_dir}/dt={DT}")) == 2         # the first one has expired
    assert _titles(spark, tmp_dir) == {"a": "three"}


@pytest.mark.parametrize("step", ["write", "measure", "log", "expire"])
def test_crash_at_each_step(spark, tmp_dir, monkeypatch, step):
    lake.write_silver(_jobs(spark, [("a", "one", "x", "b")]), tmp_dir, DT)
    new = _jobs(spark, [("a", "two", "x", "b")])

    def crash(*args, **kwargs):
        raise RuntimeError("crash")

    if step == "log":        # the entry's file is cut short
        folder = f"{tmp_dir}/_log/dt={DT}"
        lake.stage_silver(new, tmp_dir, DT)
        whole = open(f"{folder}/000000000001.json").read()
        with open(f"{folder}/000000000002.json", "w") as f:
            f.write(whole[:len(whole) // 2])
    else:
        target = {"write": (lake, "_write_buckets"), "measure": (versions, "publish"),
                  "expire": (versions, "expire")}[step]
        with monkeypatch.context() as m:
            m.setattr(*target, crash)
            with pytest.raises(RuntimeError):
                lake.stage_silver(new, tmp_dir, DT).publish()
    assert _titles(spark, tmp_dir) == {"a": "two" if step == "expire" else "one"}
    lake.write_silver(_jobs(spark, [("a", "three", "x", "b")]), tmp_dir, DT)
    assert _titles(spark, tmp_dir) == {"a": "three"}
    assert len(os.listdir(f"{tmp_dir}/dt={DT}")) == 2         # the failed run's folder is gone


def test_two_runs_at_once(spark, tmp_dir):
    lake.write_silver(_jobs(spark, [("a", "one", "x", "b")]), tmp_dir, DT)
    one = lake.stage_silver(_jobs(spark, [("a", "two", "x", "b")]), tmp_dir, DT)
    two = lake.merge_silver(_jobs(spark, [("b", "new", "x", "b")]), tmp_dir, DT)
    one.publish()
    with pytest.raises(versions.PublishError):
        two.publish()
    assert _titles(spark, tmp_dir) == {"a": "two"}


def test_days_and_missing_days(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        lake.read_silver(spark, tmp_dir, DT)
    lake.write_silver(_jobs(spark, [("a", "one", "x", "b")]), tmp_dir, DT)
    lake.write_silver(_jobs(spark, []), tmp_dir, "2026-05-21")
    assert lake.read_silver(spark, tmp_dir, "2026-05-22").count() == 0
    assert lake.read_silver(spark, tmp_dir, "2026-05-21").count() == 0
    assert lake.read_silver(spark, tmp_dir).count() == 1
    assert lake.read_silver(spark, tmp_dir, DT).columns == silver.SILVER_COLUMNS


def test_carried_figures_add_up(spark, tmp_dir):
    from hirelake.operators import quality
    rows = [(f"j{i}", None if i % 5 == 0 else "t", "x", "b") for i in range(100)]
    staged = lake.stage_silver(_jobs(spark, rows), tmp_dir, DT)
    staged.measure(quality.check_aggregates(staged.rows()))
    staged.publish()
    merged = lake.merge_silver(_jobs(spark, [("j0", "now", "y", "c"), ("new", None, "y", "c")]), tmp_dir, DT)
    got = merged.measure(quality.check_aggregates(merged.rows()))
    assert (got["rows"], got["required_field:title"]) == (101, 20)


def test_detail_is_sorted_in_bounded_splits(spark, tmp_dir, monkeypatch):
    import glob
    rows = spark.range(20000).selectExpr("cast(id AS string) AS job_id", "uuid() AS category_label",
                                         "'x' AS contract_time", "'s' AS source")
    rows.coalesce(1).write.option("parquet.block.size", 1 << 16).parquet(f"{tmp_dir}/rows")
    monkeypatch.setattr(lake, "DETAIL_SPLIT", 1 << 17)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opened = spark.conf.get("spark.sql.files.openCostInBytes")
    lake.write_gold(spark.read.parquet(f"{tmp_dir}/rows"), f"{tmp_dir}/gold", "jobs_detail", "2026-05-20")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert spark.conf.get("spark.sql.files.openCostInBytes") == opened
    assert len(glob.glob(f"{tmp_dir}/gold/jobs_detail/dt=2026-05-20/*/*.parquet")) > 1
    back = lake.read_gold(spark, f"{tmp_dir}/gold", "jobs_detail", "2026-05-20")
    assert back.count() == 20000 and back.select("job_id").distinct().count() == 20000
