"""A third of all rows on one key: results stay whole and exact, and the
plans fold the hot key map-side instead of sending it whole to one task."""

from pyspark.sql import functions as F

from hirelake.operators import gold, quality, silver
from hirelake.schemas import COMMON_COLUMNS


def _frame(spark, n=3000):
    hot = n // 3
    df = spark.range(n).select(
        F.when(F.col("id") < hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("job_id"),
        F.concat(F.lit("t"), F.col("id")).alias("title"),
        F.lit("c").alias("company_name"), F.lit("l").alias("location_name"),
        (F.col("id") * 10 + 1000).cast("double").alias("salary_min"),
        (F.col("id") * 10 + 2000).cast("double").alias("salary_max"),
        F.lit(None).cast("boolean").alias("salary_is_predicted"),
        F.lit("FULL_TIME").alias("contract_time"), F.lit("PERMANENT").alias("contract_type"),
        F.when(F.col("id") < hot, F.lit("Uncategorized")).otherwise(
            F.concat(F.lit("cat"), (F.col("id") % 7).cast("string"))).alias("category_label"),
        F.lit(None).cast("string").alias("category_tag"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        F.lit("u").alias("job_url"), F.lit(None).cast("timestamp").alias("posted_at"),
        F.lit("s").alias("source"), F.lit("2026/05/20").alias("ingestion_date"),
        F.lit("b").alias("batch_id"),
        F.format_string("2026-05-20T%02d:00:00+00:00", (F.col("id") % 24).cast("int"))
        .alias("ingested_at"))
    return df.repartition(8)


def test_hot_job_id_dedup(spark):
    df = _frame(spark)
    out = silver.deduplicate_latest(df)
    assert out.count() == 2001
    hot = out.where(F.col("job_id") == "hot").first()
    # latest ingested_at is hour 23; among those the highest remaining row wins
    assert hot["ingested_at"].startswith("2026-05-20T23")
    assert hot["title"] == "t983"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_hot_category_summary_is_exact(spark):
    df = _frame(spark).withColumn("job_id", F.concat(F.lit("j"), F.col("title")))
    s = {r["category_label"]: r for r in gold.jobs_summary(df, exact_median=True).collect()}
    assert s["Uncategorized"]["total_jobs"] == 1000
    assert sum(r["total_jobs"] for r in s.values()) == 3000
    plan = gold.jobs_summary(df, exact_median=False)._jdf.queryExecution().executedPlan().toString()
    assert "partial_percentile_approx" in plan and "partial_count" in plan
    plan = gold.jobs_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "partial_count" in plan
    assert quality.duplicate_keys(_frame(spark)).first()["duplicate_keys"] == 1
