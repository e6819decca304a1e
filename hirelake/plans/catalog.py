"""Query catalog: each entry is a Spark query over the given tables (through
the feeds) and, where SQL can say it, the DuckDB oracle of the same result.

Every query reads whole tables. Timestamps are given out as text
(``yyyy-MM-dd HH:mm:ss``) and means of means are rounded to 6 places on both
sides, since their last bits depend on summation order.

Medians are exact lower medians, found by narrowing (``operators/selection.py``), so
they are compared by value; ``g10_approx_median`` checks the rank of the sketch that can
be had instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.functions.salary import parse_salary_text
from hirelake.functions.contract import classify_contract_time, classify_contract_type
from hirelake.operators import batches, bronze, gold, quality, quarantine, serve, silver
from hirelake.operators.normalize import normalize_flat, normalize_nested
from hirelake.plans import feeds
from hirelake.plans.oracle import TS, q
from hirelake.schemas import (COMMON_COLUMNS, JOBS_DETAIL_COLUMNS, LINEAGE_COLUMNS, envelope,
                              NESTED_RECORD)
from hirelake.session import passing, scratch_path, stored
from hirelake.sources import carry, export, file_ranges, lake, search_index

INGESTION_DATE = feeds.INGESTION_DATE
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def _ts(df: DataFrame, col: str = "posted_at") -> DataFrame:
    return df.withColumn(col, F.date_format(col, TS_FORMAT)) if col in df.columns else df


def _r6(c: str):
    return F.round(F.col(c), 6).alias(c)


# ------------------------------------------------------------------ base frames

def nested_norm(spark, sf):
    return normalize_nested(feeds.nested_bronze(spark, sf), INGESTION_DATE)


def flat_norm(spark, sf):
    return normalize_flat(feeds.flat_bronze(spark, sf), INGESTION_DATE)


def all_norm(spark, sf):
    return silver.union_sources([nested_norm(spark, sf), flat_norm(spark, sf)])


def deduped(spark, sf):
    return silver.deduplicate_latest(silver.drop_null_ids(all_norm(spark, sf)))


def silver_table(spark, sf):
    return silver.silver_transform([nested_norm(spark, sf), flat_norm(spark, sf)])


def written_silver(spark, sf):
    """Silver as Gold reads it: a written table, so that the medians' first pass and
    the aggregate do not build it twice."""
    return stored(silver_table(spark, sf), "catalog-silver")


def gold_tables(spark, sf):
    s = written_silver(spark, sf)
    return gold.jobs_summary(s), gold.salary_analysis(s), gold.jobs_detail(s)


_SERVED: dict[tuple, str] = {}


def served_root(spark, sf):
    """Where Gold is stored as the serving layer sees it. Built once per session and input folder into the shared checkpoint folder,
    so serving queries read pruned Parquet instead of recomputing the chain.
    """
    key = (spark.sparkContext.applicationId, sf)
    root = _SERVED.get(key)
    if root is None:
        root = scratch_path(spark, "served-gold")
        lake.write_silver(silver_table(spark, sf), f"{root}/silver", feeds.RUN_DATE)
        written = lake.read_silver(spark, f"{root}/silver", feeds.RUN_DATE)
        for name, df in zip(lake.GOLD_TABLES, (gold.jobs_summary(written),
                                               gold.salary_analysis(written),
                                               gold.jobs_detail(written))):
            lake.write_gold(df, root, name, feeds.RUN_DATE)
        _SERVED[key] = root
    return root


def served_gold(spark, sf):
    """The stored Gold tables, read back."""
    root = served_root(spark, sf)
    return tuple(lake.read_gold(spark, root, t, feeds.RUN_DATE) for t in lake.GOLD_TABLES)


NORM_COLS = COMMON_COLUMNS + LINEAGE_COLUMNS
NORM_SQL = ", ".join(c if c != "posted_at" else TS for c in NORM_COLS)
SILVER_COLS = NORM_COLS[:17] + ["category_id", "company_id", "location_id"]
SILVER_SQL = ", ".join(c if c != "posted_at" else TS for c in SILVER_COLS)
DETAIL_SQL = ", ".join(c if c != "posted_at" else TS for c in JOBS_DETAIL_COLUMNS)

CATALOG: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        CATALOG[name] = Query(fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------- Bronze (B, S3)

ENVELOPE_SQL = f"""
ranked AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS pos FROM nested_src),
batched AS (SELECT k, pos, CAST(floor(pos / 100) AS BIGINT) AS batch_no FROM ranked)
"""


def _nested_envelopes(spark, sf):
    src = feeds.nested_source_rows(spark, sf).select("k", "job.*")
    return batches.build_batches(src, "adzuna", ["k"], batch_size=100,
                                 ingested_at=feeds.FIRST_INGEST)


@register("s3_batches", q(f""", {ENVELOPE_SQL.strip()}
SELECT batch_no, count(*) AS record_count, min(k) AS first_key, max(k) AS last_key,
  sha256('adzuna|{feeds.FIRST_INGEST}|' || CAST(batch_no AS VARCHAR)) AS batch_id
FROM batched GROUP BY batch_no"""))
def s3_batches(spark, sf):
    env = _nested_envelopes(spark, sf)
    return env.select("batch_no", "record_count",
                      F.element_at("records", 1)["k"].alias("first_key"),
                      F.element_at("records", -1)["k"].alias("last_key"), "batch_id")


RUNS = 3    # portions in which the carried batches arrive, every record in one of them


@register("s3_carried_batches", q(f"""
SELECT sha256('adzuna|{feeds.FIRST_INGEST}|' || CAST(batch_no AS VARCHAR)) AS batch_id,
  count(*) AS record_count, min_by(k, pos) AS first_key, max_by(k, pos) AS last_key
FROM (SELECT k, pos, CAST(floor(pos / 100) AS BIGINT) AS batch_no FROM (
  SELECT k, row_number() OVER (ORDER BY k % {RUNS}, k) - 1 AS pos FROM nested_src))
GROUP BY batch_no"""))
def s3_carried_batches(spark, sf):
    """S3 over three runs, which hold all records, and the rest landed at the end."""
    src = feeds.nested_source_rows(spark, sf).select("k", "job.*")
    root = scratch_path(spark, "carried")
    for run in range(RUNS):
        carry.land(src.where(F.col("k") % RUNS == run), root, "adzuna", feeds.RUN_DATE,
                   f"run {run}", ["k"], 100, feeds.FIRST_INGEST)
    carry.close(spark, root, "adzuna", feeds.RUN_DATE, "end", 100, feeds.FIRST_INGEST)
    env = carry.read_landed(spark, root, "adzuna", schema=envelope(src.schema))
    return env.select("batch_id", "record_count",
                      F.element_at("records", 1)["k"].alias("first_key"),
                      F.element_at("records", -1)["k"].alias("last_key"))


@register("b4_bronze_gate", q(f""", {ENVELOPE_SQL.strip()}
SELECT count(DISTINCT batch_no) AS rows, CAST(0 AS BIGINT) AS null_records,
  count(DISTINCT batch_no) AS nonnull_records, count(DISTINCT batch_no) AS nonnull_batch_id,
  count(DISTINCT batch_no) AS nonnull_source, count(DISTINCT batch_no) AS nonnull_ingested_at
FROM batched"""))
def b4_bronze_gate(spark, sf):
    return bronze.gate_counts(_nested_envelopes(spark, sf))


@register("b6_explode_records", q(f""", {ENVELOPE_SQL.strip()}
SELECT 'adzuna' AS source, sha256('adzuna|{feeds.FIRST_INGEST}|' || CAST(batch_no AS VARCHAR)) AS batch_id,
  '{feeds.FIRST_INGEST}' AS ingested_at, k, id
FROM batched JOIN nested_src USING (k)"""))
def b6_explode_records(spark, sf):
    exploded = bronze.explode_records(_nested_envelopes(spark, sf))
    return exploded.select("source", "batch_id", "ingested_at", F.col("job.k").alias("k"),
                           F.col("job.id").alias("id"))


# ------------------------------------------------------------ normalize

@register("n2_normalize_nested", q(f"SELECT {NORM_SQL} FROM nested_norm"))
def n2_normalize_nested(spark, sf):
    return _ts(nested_norm(spark, sf))


@register("n3_normalize_flat", q(f"SELECT {NORM_SQL} FROM flat_norm"))
def n3_normalize_flat(spark, sf):
    return _ts(flat_norm(spark, sf))


@register("n4_salary_parse", q("""
SELECT k, salary, CAST(list_min(salary_values) AS DOUBLE) AS salary_min,
  CAST(list_max(salary_values) AS DOUBLE) AS salary_max FROM flat_parsed"""))
def n4_salary_parse(spark, sf):
    p = parse_salary_text(F.col("job.salary"))
    return feeds.flat_source_rows(spark, sf).select(
        "k", F.col("job.salary").alias("salary"),
        p["min"].alias("salary_min"), p["max"].alias("salary_max"))


@register("n5_n6_contract_classify", q("""
SELECT k, type, contract_time, contract_type FROM flat_src JOIN flat_norm USING (k)"""))
def n5_n6_contract_classify(spark, sf):
    return feeds.flat_source_rows(spark, sf).select(
        "k", F.col("job.type").alias("type"),
        classify_contract_time(F.col("job.type")).alias("contract_time"),
        classify_contract_type(F.col("job.type")).alias("contract_type"))


@register("n7_union_sources", q(f"SELECT {NORM_SQL} FROM all_norm"))
def n7_union_sources(spark, sf):
    return _ts(all_norm(spark, sf))


@register("n8_null_ids", q("""
SELECT source, count(*) AS input_rows, count(*) - count(job_id) AS null_job_ids,
  count(job_id) AS kept_rows FROM all_norm GROUP BY source"""))
def n8_null_ids(spark, sf):
    return all_norm(spark, sf).groupBy("source").agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col("job_id").isNull()).alias("null_job_ids"),
        F.count("job_id").alias("kept_rows"))


@register("n9_dedup_latest", q(f"SELECT {NORM_SQL} FROM deduped"))
def n9_dedup_latest(spark, sf):
    return _ts(deduped(spark, sf)).select(*NORM_COLS)


@register("n10_standardize", q("""
SELECT job_id, contract_time, contract_type FROM standardized"""))
def n10_standardize(spark, sf):
    return silver.standardize_contract_fields(deduped(spark, sf)).select(
        "job_id", "contract_time", "contract_type")


@register("n11_salary_scale", q("SELECT job_id, salary_min, salary_max FROM scaled"))
def n11_salary_scale(spark, sf):
    return silver.scale_salaries(silver.standardize_contract_fields(deduped(spark, sf))).select(
        "job_id", "salary_min", "salary_max")


@register("n12_entity_ids", q("""
SELECT job_id, category_id, company_id, location_id FROM silver"""))
def n12_entity_ids(spark, sf):
    return silver.add_entity_ids(deduped(spark, sf)).select(
        "job_id", "category_id", "company_id", "location_id")


@register("n14_silver", q(f"SELECT {SILVER_SQL} FROM silver"))
def n14_silver(spark, sf):
    return _ts(silver_table(spark, sf))


# ---------------------------------------------------------------- quality (Q)

QUALITY_ROWS_SQL = """
SELECT 'required_field' AS "check", 'job_id' AS "column", 'warning' AS severity,
  count(*) FILTER (WHERE job_id IS NULL) AS failed FROM silver
UNION ALL SELECT 'required_field', 'title', 'warning', count(*) FILTER (WHERE title IS NULL) FROM silver
UNION ALL SELECT 'required_field', 'company_name', 'warning',
  count(*) FILTER (WHERE company_name IS NULL) FROM silver
UNION ALL SELECT 'salary_order', 'salary_min,salary_max', 'warning',
  count(*) FILTER (WHERE salary_min > salary_max) FROM silver
UNION ALL SELECT 'contract_type_domain', 'contract_type', 'warning',
  count(*) FILTER (WHERE contract_type NOT IN ('CONTRACT', 'UNKNOWN', 'PERMANENT', 'TEMPORARY')) FROM silver
UNION ALL SELECT 'contract_time_domain', 'contract_time', 'warning',
  count(*) FILTER (WHERE contract_time NOT IN ('FULL_TIME', 'PART_TIME', 'UNKNOWN')) FROM silver
"""


@register("q1_nulls", q(f"""
SELECT * FROM ({QUALITY_ROWS_SQL}) WHERE "check" = 'required_field'"""))
def q1_nulls(spark, sf):
    rep = quality.quality_report(silver_table(spark, sf), include_duplicates=False)
    return rep.where(F.col("check") == "required_field")


@register("q2_duplicates", q("""
SELECT count(*) AS duplicate_keys FROM (
  SELECT job_id FROM all_norm GROUP BY job_id HAVING count(*) > 1)"""))
def q2_duplicates(spark, sf):
    return quality.duplicate_keys(all_norm(spark, sf))


@register("q3_salary_order", q(f"""
SELECT * FROM ({QUALITY_ROWS_SQL}) WHERE "check" = 'salary_order'"""))
def q3_salary_order(spark, sf):
    rep = quality.quality_report(silver_table(spark, sf), include_duplicates=False)
    return rep.where(F.col("check") == "salary_order")


@register("q4_q5_domains", q(f"""
SELECT * FROM ({QUALITY_ROWS_SQL}) WHERE "check" LIKE 'contract_%'"""))
def q4_q5_domains(spark, sf):
    rep = quality.quality_report(silver_table(spark, sf), include_duplicates=False)
    return rep.where(F.col("check").startswith("contract_"))


@register("q6_offenders", q("""
SELECT 'contract_type' AS field, contract_type AS value, count(*) AS count FROM silver
WHERE contract_type NOT IN ('CONTRACT', 'UNKNOWN', 'PERMANENT', 'TEMPORARY') GROUP BY contract_type
UNION ALL
SELECT 'contract_time', contract_time, count(*) FROM silver
WHERE contract_time NOT IN ('FULL_TIME', 'PART_TIME', 'UNKNOWN') GROUP BY contract_time"""))
def q6_offenders(spark, sf):
    return quality.offending_values(silver_table(spark, sf), ["contract_type", "contract_time"]).groupBy(
        "field", "value").agg(F.count(F.lit(1)).alias("count"))


@register("q6_top_offenders", q("""
SELECT * FROM (SELECT field, row_number() OVER (PARTITION BY field ORDER BY count DESC, value) AS place, value, count
FROM (SELECT 'contract_type' AS field, contract_type AS value, count(*) AS count FROM silver
      WHERE contract_type NOT IN ('CONTRACT', 'UNKNOWN', 'PERMANENT', 'TEMPORARY') GROUP BY contract_type
      UNION ALL SELECT 'contract_time', contract_time, count(*) FROM silver
      WHERE contract_time NOT IN ('FULL_TIME', 'PART_TIME', 'UNKNOWN') GROUP BY contract_time)) WHERE place <= 20"""))
def q6_top_offenders(spark, sf):
    return quality.top_offenders(written_silver(spark, sf), ["contract_type", "contract_time"])


@register("q7_report", q(f"""
{QUALITY_ROWS_SQL}
UNION ALL SELECT 'duplicates', 'job_id', 'warning', count(*) FROM (
  SELECT job_id FROM silver GROUP BY job_id HAVING count(*) > 1)"""))
def q7_report(spark, sf):
    return quality.quality_report(silver_table(spark, sf))


@register("q8_severity_report", q(f"""
SELECT "check", "column",
  CASE WHEN "check" = 'contract_type_domain' THEN 'critical' ELSE severity END AS severity, failed
FROM ({QUALITY_ROWS_SQL})"""))
def q8_severity_report(spark, sf):
    """Q8: the report with contract_type_domain raised to critical (the job
    would stop on it with fail_on="critical")."""
    return quality.quality_report(silver_table(spark, sf),
                                  severities={"contract_type_domain": quality.CRITICAL},
                                  include_duplicates=False)


# ------------------------------------------------------------------- Gold (G)

@register("g6_jobs_detail", q(f"SELECT {DETAIL_SQL} FROM detail"))
def g6_jobs_detail(spark, sf):
    return _ts(gold.jobs_detail(silver_table(spark, sf)))


@register("g7_jobs_summary", q("SELECT * FROM summary"))
def g7_jobs_summary(spark, sf):
    return gold.jobs_summary(written_silver(spark, sf))


@register("g9_shares", q("""
SELECT ingestion_date, category_label, total_jobs, pct_full_time, pct_part_time, pct_unknown,
  round(pct_full_time + pct_part_time + pct_unknown, 6) AS pct_total FROM summary"""))
def g9_shares(spark, sf):
    s = gold.jobs_summary(written_silver(spark, sf))
    return s.select("ingestion_date", "category_label", "total_jobs", "pct_full_time",
                    "pct_part_time", "pct_unknown",
                    F.round(F.col("pct_full_time") + F.col("pct_part_time")
                            + F.col("pct_unknown"), 6).alias("pct_total"))


@register("g10_exact_median", q("""
SELECT contract_time, quantile_disc(salary_max, 0.5) AS median_salary FROM silver
GROUP BY contract_time"""))
def g10_exact_median(spark, sf):
    s = gold.salary_analysis(written_silver(spark, sf))
    return s.select("contract_time", "median_salary")


@register("g10_approx_median", q("""
SELECT contract_time, count(salary_max) AS n, count(salary_max) > 0 AS close FROM silver
GROUP BY contract_time"""))
def g10_approx_median(spark, sf):
    """The sketch (percentile_approx, accuracy 10000) for those who want the
    reference's. Its value depends on partitioning, so the query tells for each group
    whether its rank is within 1/10000 of the group's rows from the middle (one row, at
    least). The medians, a row a group, are a written table: Spark knows its size."""
    s = written_silver(spark, sf)
    medians = stored(gold.salary_analysis(s, exact_median=False).select(
        F.col("contract_time").alias("_c"), F.col("median_salary").alias("_m")), "catalog-medians")
    known = s.select("contract_time", F.col("salary_max").alias("v"))
    n, off = F.count("v"), F.greatest(F.count("v") / 10000, F.lit(1.0))
    return (known.join(medians, known.contract_time.eqNullSafe(F.col("_c")))
            .groupBy("contract_time")
            .agg(n.alias("n"),
                 F.coalesce((F.count_if(F.col("v") < F.col("_m")) <= n / 2 + off)
                            & (F.count_if(F.col("v") <= F.col("_m")) >= n / 2 - off)
                            & (n > 0), F.lit(False)).alias("close")))


@register("g11_salary_analysis", q("SELECT * FROM salary_an"))
def g11_salary_analysis(spark, sf):
    return gold.salary_analysis(written_silver(spark, sf))


# ------------------------------------------------------------- serving (D)

FILTER_CATEGORIES = ["BUILDING", "MACHINERY", "Uncategorized"]
FILTER_CONTRACT_TIMES = ["FULL_TIME", "UNKNOWN"]
SEARCH_KEYWORD = "HIGH|urgent"
FALLBACK_KEYWORD = "brand#1[0-9] |furniture"
SALARY_LO, SALARY_HI = 150000.0, 300000.0


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


@register("d1_facet_table", q("""
SELECT facet, row_number() OVER (PARTITION BY facet ORDER BY value) AS place, value, jobs FROM (
  SELECT 'ingestion_date' AS facet, ingestion_date AS value, count(*) AS jobs FROM silver GROUP BY ALL
  UNION ALL SELECT 'category_label', category_label, count(*) FROM silver GROUP BY ALL
  UNION ALL SELECT 'contract_time', contract_time, count(*) FROM silver GROUP BY ALL
  UNION ALL SELECT 'source', source, count(*) FROM silver GROUP BY ALL) WHERE value IS NOT NULL"""))
def d1_facet_table(spark, sf):
    """All facets with their order and counts from one scan, as Gold stores them."""
    root = scratch_path(spark, "facets")
    lake.write_gold(serve.facet_table(silver_table(spark, sf)), root, lake.FACETS, feeds.RUN_DATE)
    return lake.read_gold(spark, root, lake.FACETS, feeds.RUN_DATE)


@register("d1_facets", q("""
SELECT DISTINCT 'ingestion_date' AS facet, ingestion_date AS value FROM summary WHERE ingestion_date IS NOT NULL
UNION ALL SELECT DISTINCT 'category_label', category_label FROM summary WHERE category_label IS NOT NULL
UNION ALL SELECT DISTINCT 'contract_time', contract_time FROM salary_an WHERE contract_time IS NOT NULL
UNION ALL SELECT DISTINCT 'source', source FROM detail WHERE source IS NOT NULL"""))
def d1_facets(spark, sf):
    summary, salary, detail = served_gold(spark, sf)
    parts = [serve.facet_values(df, c).select(F.lit(c).alias("facet"), F.col(c).alias("value"))
             for df, c in [(summary, "ingestion_date"), (summary, "category_label"),
                           (salary, "contract_time"), (detail, "source")]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("d2_d5_filters", q(f"""
SELECT job_id, category_label, contract_time, source FROM detail
WHERE ingestion_date IN ('{INGESTION_DATE}') AND category_label IN ({_in(FILTER_CATEGORIES)})
  AND contract_time IN ({_in(FILTER_CONTRACT_TIMES)})
  AND source IN (SELECT DISTINCT source FROM detail WHERE source IS NOT NULL)"""))
def d2_d5_filters(spark, sf):
    summary, salary, detail = served_gold(spark, sf)
    v = serve.apply_filters(summary, salary, detail, dates=[INGESTION_DATE],
                            categories=FILTER_CATEGORIES, contract_times=FILTER_CONTRACT_TIMES,
                            sources=None)
    return v.detail.select("job_id", "category_label", "contract_time", "source")


@register("d5_chosen_sources", q("""
SELECT job_id, source FROM detail WHERE source IN ('jooble')"""))
def d5_chosen_sources(spark, sf):
    summary, salary, detail = served_gold(spark, sf)
    v = serve.apply_filters(summary, salary, detail, dates=[], categories=[],
                            contract_times=[], sources=["jooble"])
    return v.detail.select("job_id", "source")


@register("d6_default_filters", q("""
SELECT job_id, category_label, contract_time, source FROM detail
WHERE ingestion_date IN (SELECT ingestion_date FROM summary WHERE ingestion_date IS NOT NULL)
  AND category_label IN (SELECT category_label FROM summary WHERE category_label IS NOT NULL)
  AND contract_time IN (SELECT contract_time FROM salary_an WHERE contract_time IS NOT NULL)
  AND source IS NOT NULL"""))
def d6_default_filters(spark, sf):
    summary, salary, detail = served_gold(spark, sf)
    v = serve.apply_filters(summary, salary, detail)
    return v.detail.select("job_id", "category_label", "contract_time", "source")


@register("d7_d9_kpis", q(f"""
SELECT CAST(CASE WHEN count(*) = 0 THEN (SELECT count(*) FROM detail) ELSE sum(total_jobs) END AS BIGINT)
    AS total_jobs,
  count(DISTINCT category_label) AS total_categories,
  round(CASE WHEN count(*) = 0 THEN 0 ELSE avg(avg_salary) END, 6) AS avg_salary,
  round(CASE WHEN count(*) = 0 THEN 0 ELSE avg(median_salary) END, 6) AS median_salary
FROM summary WHERE category_label IN ({_in(FILTER_CATEGORIES)})"""))
def d7_d9_kpis(spark, sf):
    summary, salary, detail = served_gold(spark, sf)
    v = serve.apply_filters(summary, salary, detail, categories=FILTER_CATEGORIES)
    return serve.kpis(v.summary, v.detail).select(
        "total_jobs", "total_categories", _r6("avg_salary"), _r6("median_salary"))


@register("d10_top_categories", q("""
SELECT category_label, CAST(sum(total_jobs) AS BIGINT) AS total_jobs FROM summary
WHERE category_label IS NOT NULL
GROUP BY category_label ORDER BY total_jobs DESC, category_label LIMIT 10"""))
def d10_top_categories(spark, sf):
    summary, _, _ = served_gold(spark, sf)
    return serve.top_categories(summary)


@register("d11_contract_distribution", q("""
SELECT * FROM (
  SELECT 'FULL_TIME' AS contract_type, round(coalesce(sum(total_jobs * pct_full_time), 0), 6) AS estimated_jobs FROM summary
  UNION ALL SELECT 'PART_TIME', round(coalesce(sum(total_jobs * pct_part_time), 0), 6) FROM summary
  UNION ALL SELECT 'UNKNOWN', round(coalesce(sum(total_jobs * pct_unknown), 0), 6) FROM summary)
WHERE estimated_jobs > 0"""))
def d11_contract_distribution(spark, sf):
    summary, _, _ = served_gold(spark, sf)
    return serve.contract_distribution(summary).select("contract_type", _r6("estimated_jobs"))


@register("d12_category_breakdown", q("""
SELECT category_label, CAST(sum(total_jobs) AS BIGINT) AS total_jobs,
  round(avg(avg_salary), 6) AS avg_salary,
  min(min_salary) AS min_salary, max(max_salary) AS max_salary,
  round(avg(median_salary), 6) AS median_salary
FROM summary WHERE category_label IS NOT NULL GROUP BY category_label"""))
def d12_category_breakdown(spark, sf):
    summary, _, _ = served_gold(spark, sf)
    b = serve.category_breakdown(summary)
    return b.select("category_label", "total_jobs", _r6("avg_salary"), "min_salary",
                    "max_salary", _r6("median_salary"))


@register("d13_keyword_search", q(f"""
SELECT job_id, title, job_search_text FROM detail
WHERE regexp_matches(job_search_text, '{SEARCH_KEYWORD.lower()}', 'i')"""))
def d13_keyword_search(spark, sf):
    _, _, detail = served_gold(spark, sf)
    return serve.keyword_search(detail, SEARCH_KEYWORD).select("job_id", "title",
                                                               "job_search_text")


@register("d13_indexed_search", q(f"""
SELECT job_id, title, category_label FROM detail
WHERE regexp_matches(job_search_text, '{SEARCH_KEYWORD.lower()}', 'i')"""))
def d13_indexed_search(spark, sf):
    """D13 over the stored day by its files' signatures."""
    root = served_root(spark, sf)
    if ("grams", root) not in _SERVED:
        search_index.index_search(spark, root, feeds.RUN_DATE)
        _SERVED["grams", root] = root
    found, _ = search_index.search_detail(spark, root, feeds.RUN_DATE, SEARCH_KEYWORD)
    return found.select("job_id", "title", "category_label")


@register("d14_search_fallback", q(f"""
SELECT job_id, title FROM detail
WHERE regexp_matches(lower(concat_ws(' ', coalesce(title, ''), coalesce(company_name, ''),
  coalesce(category_label, ''), coalesce(location_name, ''), coalesce(contract_time, ''),
  coalesce(contract_type, ''))), '{FALLBACK_KEYWORD.lower()}', 'i')"""))
def d14_search_fallback(spark, sf):
    _, _, detail = served_gold(spark, sf)
    return serve.keyword_search(detail.drop("job_search_text"), FALLBACK_KEYWORD).select(
        "job_id", "title")


@register("d15_salary_bounds", q("""
SELECT min(salary_avg) AS salary_avg_min, max(salary_avg) AS salary_avg_max FROM detail"""))
def d15_salary_bounds(spark, sf):
    _, _, detail = served_gold(spark, sf)
    return serve.salary_bounds(detail)


@register("d15_d16_salary_range", q(f"""
SELECT job_id, salary_avg FROM detail WHERE salary_avg BETWEEN {SALARY_LO} AND {SALARY_HI}"""))
def d15_d16_salary_range(spark, sf):
    _, _, detail = served_gold(spark, sf)
    return serve.salary_range_filter(detail, SALARY_LO, SALARY_HI).select("job_id", "salary_avg")


@register("d16_default_salary_range", q("""
SELECT job_id, salary_avg FROM detail
WHERE salary_avg BETWEEN (SELECT min(salary_avg) FROM detail) AND (SELECT max(salary_avg) FROM detail)"""))
def d16_default_salary_range(spark, sf):
    _, _, detail = served_gold(spark, sf)
    return serve.default_salary_range(detail).select("job_id", "salary_avg")


@register("d16_no_salaries", q("""
SELECT 'default' AS range, count(*) AS jobs FROM detail UNION ALL
SELECT 'chosen', count(*) FROM detail"""))
def d16_no_salaries(spark, sf):
    """Where no job has a salary, the salary filter is skipped."""
    _, _, detail = served_gold(spark, sf)
    bare = detail.withColumn("salary_avg", F.lit(None).cast("double"))
    parts = [serve.default_salary_range(bare), serve.salary_range_filter(bare, 1.0, 2.0)]
    return parts[0].agg(F.lit("default").alias("range"), F.count("*").alias("jobs")).unionByName(
        parts[1].agg(F.lit("chosen").alias("range"), F.count("*").alias("jobs")))


def _ranked_top(detail, how, n=10):
    return _ranked(serve.top_jobs(detail, how, n), how)


def _ranked(top, how):
    order = {serve.SORT_NEWEST: [F.desc_nulls_last("posted_date")],
             serve.SORT_HIGHEST: [F.desc_nulls_last("salary_avg")],
             serve.SORT_LOWEST: [F.asc_nulls_last("salary_avg")]}[how]
    # n rows at most: this window sorts a bounded frame.
    return top.select(F.lit(how).alias("sort_by"),
                      F.row_number().over(Window.orderBy(*order, F.asc("job_id"))).alias("rank"),
                      "job_id", "posted_date", "salary_avg")


@register("d18_d19_top_jobs", q("""
SELECT * FROM (SELECT 'Newest' AS sort_by,
  CAST(row_number() OVER (ORDER BY posted_date DESC NULLS LAST, job_id) AS INTEGER) AS rank,
  job_id, posted_date, salary_avg FROM detail) WHERE rank <= 10
UNION ALL SELECT * FROM (SELECT 'Highest Salary',
  CAST(row_number() OVER (ORDER BY salary_avg DESC NULLS LAST, job_id) AS INTEGER) AS rank,
  job_id, posted_date, salary_avg FROM detail) WHERE rank <= 10
UNION ALL SELECT * FROM (SELECT 'Lowest Salary',
  CAST(row_number() OVER (ORDER BY salary_avg ASC NULLS LAST, job_id) AS INTEGER) AS rank,
  job_id, posted_date, salary_avg FROM detail) WHERE rank <= 10"""))
def d18_d19_top_jobs(spark, sf):
    _, _, detail = served_gold(spark, sf)
    parts = [_ranked_top(detail, how) for how in
             (serve.SORT_NEWEST, serve.SORT_HIGHEST, serve.SORT_LOWEST)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _ranged_root(spark, sf):
    """The stored Gold with the ranges of its detail files."""
    root = served_root(spark, sf)
    if ("ranges", root) not in _SERVED:
        file_ranges.index_ranges(spark, root, feeds.RUN_DATE)
        _SERVED["ranges", root] = root
    return root


@register("d15_stored_bounds", CATALOG["d15_salary_bounds"].sql)
def d15_stored_bounds(spark, sf):
    """D15 from the files' ranges; no file of the day is opened."""
    return file_ranges.salary_bounds(spark, _ranged_root(spark, sf), feeds.RUN_DATE)


@register("d18_d19_stored_top_jobs", CATALOG["d18_d19_top_jobs"].sql)
def d18_d19_stored_top_jobs(spark, sf):
    """D18 and D19 over the stored day, by its files' ranges."""
    root = _ranged_root(spark, sf)
    parts = [_ranked(file_ranges.top_jobs(spark, root, feeds.RUN_DATE, how)[0], how) for how in
             (serve.SORT_NEWEST, serve.SORT_HIGHEST, serve.SORT_LOWEST)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("d22_salary_melt", q("""
SELECT contract_time, 'avg_salary_min' AS salary_type, avg_salary_min AS salary FROM salary_an
UNION ALL SELECT contract_time, 'avg_salary_max', avg_salary_max FROM salary_an"""))
def d22_salary_melt(spark, sf):
    _, salary, _ = served_gold(spark, sf)
    return serve.salary_melt(salary)


@register("d23_median_rank", q("""
SELECT contract_time, median_salary,
  CAST(row_number() OVER (ORDER BY median_salary DESC NULLS LAST, contract_time) AS INTEGER) AS rank
FROM salary_an"""))
def d23_median_rank(spark, sf):
    _, salary, _ = served_gold(spark, sf)
    return _in_given_order(serve.median_ranking(salary).select("contract_time", "median_salary"))


@register("d24_jobs_by_contract", q("""
SELECT contract_time, job_count FROM salary_an WHERE job_count > 0"""))
def d24_jobs_by_contract(spark, sf):
    _, salary, _ = served_gold(spark, sf)
    return serve.jobs_by_contract(salary)


@register("d26_salary_by_category", q("""
, top AS (SELECT category_label, avg(avg_salary) AS avg_salary, avg(median_salary) AS median_salary,
    sum(total_jobs) AS total_jobs FROM summary WHERE category_label IS NOT NULL
  GROUP BY category_label ORDER BY total_jobs DESC, category_label LIMIT 10)
SELECT category_label, 'avg_salary' AS salary_type, round(avg_salary, 6) AS salary FROM top
UNION ALL SELECT category_label, 'median_salary', round(median_salary, 6) FROM top"""))
def d26_salary_by_category(spark, sf):
    summary, _, _ = served_gold(spark, sf)
    return serve.salary_by_top_categories(summary).select(
        "category_label", "salary_type", _r6("salary"))


def _in_given_order(df):
    """A small sorted frame (one row a category or contract time) with the rank
    that each row has in the order its operator gave it."""
    one = df.coalesce(1).withColumn("_at", F.monotonically_increasing_id())
    return one.withColumn("rank", F.row_number().over(Window.orderBy("_at"))).drop("_at")


@register("g12_salary_order", q("""
SELECT contract_time, CAST(row_number() OVER (
  ORDER BY avg_salary_max DESC NULLS LAST, contract_time) AS INTEGER) AS rank FROM salary_an"""))
def g12_salary_order(spark, sf):
    salary = gold.salary_analysis(written_silver(spark, sf))
    return _in_given_order(salary.select("contract_time"))


@register("d12_breakdown_order", q("""
SELECT category_label, CAST(row_number() OVER (ORDER BY jobs DESC, category_label) AS INTEGER) AS rank
FROM (SELECT category_label, sum(total_jobs) AS jobs FROM summary
      WHERE category_label IS NOT NULL GROUP BY category_label)"""))
def d12_breakdown_order(spark, sf):
    summary, _, _ = served_gold(spark, sf)
    return _in_given_order(serve.category_breakdown(summary).select("category_label"))


# ------------------------------------------------------ pages

@register("s4_pages", q("""
, first_empty AS (SELECT country, min(page) AS fe FROM pages WHERE is_empty GROUP BY country),
kept AS (
  SELECT r.country, r.page, r.k,
    CAST(row_number() OVER (PARTITION BY r.country, r.page ORDER BY r.k) - 1 AS INTEGER) AS pos
  FROM page_rows r LEFT JOIN first_empty f ON r.country = f.country
  WHERE f.fe IS NULL OR r.page < f.fe)
SELECT country, page, pos, k, country AS source_country FROM kept"""))
def s4_pages(spark, sf):
    pages = feeds.landed_pages(spark, sf)
    recs = batches.flatten_pages(pages, "results", country_tag=True)
    return recs.select("country", "page", "pos",
                       F.regexp_extract(F.col("record.redirect_url"), "([0-9]+)$", 1)
                       .cast("long").alias("k"),
                       F.col("record._source_country").alias("source_country"))


# ------------------------------------------------- round trips

@register("s8_silver_round_trip", q(f"SELECT {SILVER_SQL} FROM silver"))
def s8_silver_round_trip(spark, sf):
    root = scratch_path(spark, "silver")
    lake.write_silver(silver_table(spark, sf), root, feeds.RUN_DATE)
    return _ts(lake.read_silver(spark, root, feeds.RUN_DATE))


NORMALISED_ROWS = 100_000    # rows of a stored file; a task reads few files and sorts their rows


@register("n15_keyed_merge", q(f"SELECT {SILVER_SQL} FROM silver"))
def n15_keyed_merge(spark, sf):
    """The morning's batches stored as a day, then the evening's merged into the buckets
    that hold their jobs: the same Silver as from all batches at once."""
    root = scratch_path(spark, "merged")
    with passing(spark):
        rows = stored(all_norm(spark, sf), "catalog-normalised", NORMALISED_ROWS)
        late = F.col("ingested_at") == feeds.UPDATE_INGEST
        for part in (rows.where(~late), rows.where(late)):
            lake.merge_silver(silver.silver_transform(part, keep_lineage=True, bounded=True), root,
                              feeds.RUN_DATE, dealt=True).publish()
    return _ts(lake.read_silver(spark, root, feeds.RUN_DATE))


@register("s10_gold_round_trip", q("SELECT * FROM summary"))
def s10_gold_round_trip(spark, sf):
    root = scratch_path(spark, "gold")
    summary, _, _ = served_gold(spark, sf)
    lake.write_gold(summary, root, "jobs_summary", feeds.RUN_DATE)
    return lake.read_gold(spark, root, "jobs_summary", feeds.RUN_DATE)


CSV_DETAIL_SQL = DETAIL_SQL.replace("title,", "title || ' \"a\", b' || chr(10) || 'c' AS title,", 1)


@register("s15_csv_round_trip", q(f"SELECT {CSV_DETAIL_SQL} FROM detail"))
def s15_csv_round_trip(spark, sf):
    """Every column of the detail view; titles hold quotes, commas and line breaks."""
    path = scratch_path(spark, "csv")
    _, _, detail = served_gold(spark, sf)
    odd = detail.withColumn("title", F.concat("title", F.lit(' "a", b\nc')))
    export.write_csv(odd, path)
    return _ts(export.read_csv(spark, path, odd.schema)).select(*JOBS_DETAIL_COLUMNS)


# --------------------------------------------------- end to end

_LANDED: dict[tuple, str] = {}


def landed_bronze(spark, sf):
    """The feeds landed once per session and input folder as Bronze batch
    documents (one per file) in the shared checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED:
        root = scratch_path(spark, "bronze")
        feeds.land_feeds(spark, sf, root)
        _LANDED[key] = root
    return _LANDED[key]


@register("p1_pipeline_summary", q("SELECT * FROM summary"))
def p1_pipeline_summary(spark, sf):
    """Feeds landed as Bronze JSON, then the whole job; reads back Gold."""
    from hirelake.plans.pipeline import run_pipeline
    base = scratch_path(spark, "lake")
    run_pipeline(spark, ["adzuna", "jooble"], feeds.RUN_DATE, landed_bronze(spark, sf),
                 f"{base}/silver", f"{base}/gold", fail_on=None)
    return lake.read_gold(spark, f"{base}/gold", "jobs_summary", feeds.RUN_DATE)


ROUND_TRIP_COLS = [c for c in NORM_COLS if c != "batch_id"]
ROUND_TRIP_SQL = ", ".join(c if c != "posted_at" else TS for c in ROUND_TRIP_COLS)


@register("s1_s2_bronze_round_trip", q(f"SELECT {ROUND_TRIP_SQL} FROM all_norm"))
def s1_s2_bronze_round_trip(spark, sf):
    """Feeds written as Bronze JSON (S2) and read back with the fixed schemas
    (S1), exploded (B6) and normalized (N13)."""
    from hirelake.plans.pipeline import build_source
    root = landed_bronze(spark, sf)
    frames = [build_source(spark, s, feeds.RUN_DATE, root) for s in ("adzuna", "jooble")]
    return _ts(silver.union_sources(frames)).select(*ROUND_TRIP_COLS)


def _unfit_documents(spark, sf):
    """A nested document a part, as text: some with values of another type, some cut."""
    k = F.col("p_partkey")
    text = F.concat(
        F.lit('{"batch_id": "p'), k, F.lit('", "source": "adzuna", "ingested_at": "x", "record_count": '),
        F.when(k % 19 == 0, '"one"').otherwise("1"), F.lit(', "records": [{"id": "'), k,
        F.lit('", "salary_min": '), F.when(k % 13 == 0, F.concat(F.lit('"'), "p_brand", F.lit('"')))
        .otherwise(F.col("p_size").cast("string")),
        F.lit(', "category": '), F.when(k % 17 == 0, '"tools"').otherwise('{"label": "Tools"}'),
        F.lit("}]}"))
    return feeds.table(spark, sf, "part").select(
        F.when(k % 101 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value"))


@register("s1_quarantine", """
SELECT 'p' || p_partkey AS batch_id, NULL::INTEGER AS record, 'record_count' AS path,
  'expected BIGINT, found STRING' AS reason, 'one' AS value
FROM part WHERE p_partkey % 19 = 0 AND p_partkey % 101 <> 0
UNION ALL SELECT 'p' || p_partkey, 0, 'salary_min', 'expected DOUBLE, found STRING', p_brand
FROM part WHERE p_partkey % 13 = 0 AND p_partkey % 101 <> 0
UNION ALL SELECT 'p' || p_partkey, 0, 'category', 'expected OBJECT, found STRING', 'tools'
FROM part WHERE p_partkey % 17 = 0 AND p_partkey % 101 <> 0
UNION ALL SELECT NULL, NULL, NULL, 'not a JSON document',
  left('{"batch_id": "p' || p_partkey || '", "source": "adzuna", "ingested_at": "x", "record_count": ', 40)
FROM part WHERE p_partkey % 101 = 0""")
def s1_quarantine(spark, sf):
    """Every value of the landed documents that does not fit the schema."""
    root = scratch_path(spark, "unfit")
    _unfit_documents(spark, sf).write.text(lake.bronze_path(root, "adzuna", feeds.RUN_DATE))
    df = lake.read_bronze(spark, root, "adzuna", feeds.RUN_DATE, with_corrupt=True)
    return quarantine.quarantined(quarantine.corrupt_documents(df), "adzuna", NESTED_RECORD).select(
        "batch_id", "record", "path", "reason", "value")


@register("b5_bronze_job", q(f"""
, counts AS (
  SELECT 'adzuna' AS source,
    CAST(ceil((SELECT count(*) FROM nested_src) / {feeds.FEED_BATCH_ROWS}.0)
       + ceil((SELECT count(*) FROM nested_src WHERE k % {feeds.UPDATE_EVERY} = {feeds.UPDATE_AT})
              / {feeds.FEED_BATCH_ROWS}.0) AS BIGINT) AS n
  UNION ALL SELECT 'jooble', CAST(ceil(count(*) / {feeds.FEED_BATCH_ROWS}.0) AS BIGINT) FROM flat_src)
SELECT source, n AS rows, CAST(0 AS BIGINT) AS null_records, n AS nonnull_records,
  n AS nonnull_batch_id, n AS nonnull_source, n AS nonnull_ingested_at FROM counts"""))
def b5_bronze_job(spark, sf):
    """The Bronze gate over the landed files of each source (one aggregate
    per source; it raises if a gate fails)."""
    from hirelake.plans.pipeline import run_bronze
    root = landed_bronze(spark, sf)
    parts = []
    for source in ("adzuna", "jooble"):
        df, _ = run_bronze(spark, source, feeds.RUN_DATE, root)
        parts.append(bronze.gate_counts(df).select(F.lit(source).alias("source"), "*"))
    return parts[0].unionByName(parts[1])


@register("streaming_incremental_summary", q("SELECT * FROM summary"))
def streaming_incremental_summary(spark, sf):
    """The incremental runner (file stream over Bronze, availableNow) builds the
    day; Gold read back equals the batch job's."""
    from hirelake.streaming import incremental_pipeline
    base = scratch_path(spark, "stream")
    incremental_pipeline(spark, ["adzuna", "jooble"], landed_bronze(spark, sf),
                         f"{base}/silver", f"{base}/gold", f"{base}/checkpoints",
                         fail_on=None)
    return lake.read_gold(spark, f"{base}/gold", "jobs_summary", feeds.RUN_DATE)


# ------------------------------------------- serving projections

@register("d17_result_count", q(f"""
SELECT count(*) AS result_count FROM detail
WHERE regexp_matches(job_search_text, '{SEARCH_KEYWORD.lower()}', 'i')
  AND salary_avg BETWEEN {SALARY_LO} AND {SALARY_HI}"""))
def d17_result_count(spark, sf):
    _, _, detail = served_gold(spark, sf)
    found = serve.salary_range_filter(serve.keyword_search(detail, SEARCH_KEYWORD),
                                      SALARY_LO, SALARY_HI)
    return serve.result_count_frame(found)


@register("d20_card_fields", q("""
SELECT title, company_name, location_name, category_label, contract_time, contract_type,
  posted_date, salary_range, source
FROM detail ORDER BY posted_date DESC NULLS LAST, job_id LIMIT 10"""))
def d20_card_fields(spark, sf):
    _, _, detail = served_gold(spark, sf)
    return serve.card_fields(serve.top_jobs(detail, serve.SORT_NEWEST, 10))


@register("d21_job_table", q(f"""
SELECT job_id, title, company_name, category_label, location_name, contract_time, contract_type,
  posted_date, salary_min, salary_max, salary_avg, salary_range, salary_is_predicted, source,
  ingestion_date
FROM detail WHERE regexp_matches(job_search_text, '{FALLBACK_KEYWORD.lower()}', 'i')"""))
def d21_job_table(spark, sf):
    _, _, detail = served_gold(spark, sf)
    return serve.job_table(serve.keyword_search(detail, FALLBACK_KEYWORD))


@register("d25_salary_table", q("""
SELECT contract_time, job_count, avg_salary_min, avg_salary_max, median_salary, max_salary,
  min_salary FROM salary_an"""))
def d25_salary_table(spark, sf):
    _, salary, _ = served_gold(spark, sf)
    return serve.salary_table(salary)
