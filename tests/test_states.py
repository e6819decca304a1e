"""Gold aggregates from states by bucket: ten batches equal one build."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from hirelake.operators import gold, silver, states
from hirelake.plans import catalog
from hirelake.plans.pipeline import fresh_states, run_gold
from hirelake.sources import lake

DT = "2026-05-20"


def _close(a, b):
    norm = lambda df: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                              for r in df.collect()), key=repr)
    assert norm(a.select(*b.columns)) == norm(b)


def test_ten_batches_equal_one_build(spark, tmp_dir):
    rows = catalog.all_norm(spark, SF_SMALL)
    part = F.pmod(F.xxhash64("job_id", "batch_id", "ingested_at"), F.lit(10))
    root = f"{tmp_dir}/silver"
    for k in range(10):
        lake.merge_silver(silver.silver_transform(rows.where(part == k), keep_lineage=True), root,
                          DT).publish()
        if k in (0, 4, 9):
            run_gold(spark, DT, root, f"{tmp_dir}/gold", keep_states=True)
    whole = lake.read_silver(spark, root, DT)
    _close(lake.read_gold(spark, f"{tmp_dir}/gold", "jobs_summary", DT), gold.jobs_summary(whole))
    _close(lake.read_gold(spark, f"{tmp_dir}/gold", "salary_analysis", DT), gold.salary_analysis(whole))


def test_only_changed_buckets_are_built(spark, tmp_dir):
    done = silver.silver_transform(catalog.all_norm(spark, SF_SMALL), keep_lineage=True)
    lake.write_silver(done, f"{tmp_dir}/silver", DT)
    where = (DT, f"{tmp_dir}/silver", f"{tmp_dir}/states", states.summary_state)
    _, changed = fresh_states(spark, *where)
    assert len(changed) == lake.BUCKETS
    assert fresh_states(spark, *where)[1] == []
    one = done.orderBy("job_id").limit(1)
    late = one.withColumn("ingested_at", F.lit("2027-01-01T00:00:00")).withColumn(
        "salary_max", F.lit(9e9)).withColumn("salary_min", F.lit(8e9))
    lake.merge_silver(late, f"{tmp_dir}/silver", DT).publish()
    state, changed = fresh_states(spark, *where)
    assert len(changed) == 1
    _close(states.summary_of(state), gold.jobs_summary(lake.read_silver(spark, f"{tmp_dir}/silver", DT)))
    # the replaced copy is taken back: the same job again, with its old figures
    lake.merge_silver(one.withColumn("ingested_at", F.lit("2028-01-01T00:00:00")),
                      f"{tmp_dir}/silver", DT).publish()
    state, _ = fresh_states(spark, *where)
    assert states.summary_of(state).agg(F.max("max_salary")).first()[0] < 9e9
    _close(states.summary_of(state), gold.jobs_summary(lake.read_silver(spark, f"{tmp_dir}/silver", DT)))
