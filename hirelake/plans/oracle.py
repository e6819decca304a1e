"""The feeds and pipeline steps as plain SQL, for DuckDB to check the Spark
queries. Each query is ``WITH <steps> SELECT ...``; unused steps cost nothing.

These texts restate, in SQL, the rules of ``hirelake.plans.feeds`` and of the
operators; they are the independent side of the correctness check.
"""

from __future__ import annotations

from hirelake.plans.feeds import (EMPTY_PAGE_NATION, EMPTY_PAGE_NO, FEED_BATCH_ROWS,
                                  FIRST_INGEST, INGESTION_DATE, PAGE_KEYS, RUN_DATE,
                                  UPDATE_AT, UPDATE_EVERY, UPDATE_INGEST, UPDATE_SUFFIX,
                                  URL_BASE)

SALARY_RE = r"(\d+(?:\.\d+)?)\s*(k)?"

STEPS = f"""
nested_src AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS id,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_orderpriority END AS title,
    CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE c_name END AS company_name,
    CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE n_name END AS location_name,
    CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice / 1000)
         WHEN o_orderkey % 29 = 0 THEN floor(o_totalprice) + 5000 ELSE floor(o_totalprice) END AS DOUBLE) AS salary_min,
    CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice / 800)
         WHEN o_orderkey % 29 = 0 THEN floor(o_totalprice) ELSE floor(o_totalprice) + 5000 END AS DOUBLE) AS salary_max,
    CASE WHEN o_orderkey % 59 = 0 THEN 'shift' WHEN o_orderstatus = 'F' THEN ' full_time '
         WHEN o_orderstatus = 'P' THEN 'part_time' END AS contract_time,
    CASE o_orderkey % 5 WHEN 0 THEN 'permanent' WHEN 1 THEN 'contract' WHEN 2 THEN 'temporary'
         WHEN 3 THEN 'internship' END AS contract_type,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN c_mktsegment || ' ' || n_name
         ELSE c_mktsegment END AS category_label, lower(category_label) AS category_tag,
    CAST(n_nationkey * 1.5 AS DOUBLE) AS latitude,
    CAST((o_custkey % 360) - 180 AS DOUBLE) AS longitude,
    '{URL_BASE}/ad/' || CAST(o_orderkey AS VARCHAR) AS job_url,
    CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CAST(o_orderdate AS VARCHAR) END AS created,
    (o_orderkey % 2 = 0) AS salary_is_predicted,
    n_nationkey, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
nested_copies AS (
  SELECT *, 'adzuna-{RUN_DATE}-a-' || lpad(CAST(floor(k / {FEED_BATCH_ROWS}) AS BIGINT)::VARCHAR, 6, '0') AS batch_id,
         '{FIRST_INGEST}' AS ingested_at FROM nested_src
  UNION ALL
  SELECT * REPLACE (title || '{UPDATE_SUFFIX}' AS title),
         'adzuna-{RUN_DATE}-b-' || lpad(CAST(floor(k / {FEED_BATCH_ROWS * UPDATE_EVERY}) AS BIGINT)::VARCHAR, 6, '0'),
         '{UPDATE_INGEST}' FROM nested_src WHERE k % {UPDATE_EVERY} = {UPDATE_AT}
),
nested_norm AS (
  SELECT 'adzuna_' || id AS job_id, title, company_name, location_name, salary_min, salary_max,
    salary_is_predicted, contract_time, contract_type, category_label, category_tag,
    latitude, longitude, job_url, CAST(created AS TIMESTAMP) AS posted_at,
    'adzuna' AS source, '{INGESTION_DATE}' AS ingestion_date, batch_id, ingested_at, k
  FROM nested_copies
),
flat_src AS (
  SELECT p_partkey AS k, p_name AS title, p_brand AS company, p_type AS location,
    CASE p_partkey % 8
      WHEN 0 THEN '$' || CAST(60 + p_size AS VARCHAR) || ',000 - $' || CAST(90 + p_size AS VARCHAR) || ',000 a year'
      WHEN 1 THEN CAST(40 + p_size AS VARCHAR) || 'k - ' || CAST(60 + p_size AS VARCHAR) || 'k'
      WHEN 2 THEN CAST(70 + p_size AS VARCHAR) || '-' || CAST(90 + p_size AS VARCHAR) || 'k'
      WHEN 3 THEN '$' || CAST(20 + p_size AS VARCHAR) || ' per hour + 401k'
      WHEN 4 THEN CAST(p_size AS VARCHAR) || '.5 K'
      WHEN 5 THEN 'DOE' WHEN 6 THEN '' END AS salary,
    CASE p_partkey % 6 WHEN 0 THEN 'Full-time, Permanent' WHEN 1 THEN 'Part-time'
      WHEN 2 THEN 'Contract' WHEN 3 THEN 'Temporary' WHEN 4 THEN 'Internship' END AS type,
    '{URL_BASE}/job/' || CAST(p_partkey AS VARCHAR) AS link,
    '2026-05-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || 'T'
      || lpad(CAST(p_partkey % 24 AS VARCHAR), 2, '0') || ':30:00' AS updated
  FROM part
),
flat_parsed AS (
  SELECT *, list_transform(
      regexp_extract_all(replace(lower(salary), ',', ''), '{SALARY_RE}', 0),
      lambda m: CAST(regexp_extract(m, '{SALARY_RE}', 1) AS DOUBLE)
                * CASE WHEN regexp_extract(m, '{SALARY_RE}', 2) = 'k' THEN 1000.0 ELSE 1.0 END
    ) AS salary_values
  FROM flat_src
),
flat_norm AS (
  SELECT 'jooble_' || CAST(k AS VARCHAR) AS job_id, title, company AS company_name,
    location AS location_name,
    CAST(list_min(salary_values) AS DOUBLE) AS salary_min,
    CAST(list_max(salary_values) AS DOUBLE) AS salary_max,
    CAST(NULL AS BOOLEAN) AS salary_is_predicted,
    CASE WHEN contains(lower(type), 'full') THEN 'FULL_TIME'
         WHEN contains(lower(type), 'part') THEN 'PART_TIME' END AS contract_time,
    CASE WHEN contains(lower(type), 'contract') THEN 'CONTRACT'
         WHEN contains(lower(type), 'permanent') THEN 'PERMANENT'
         WHEN contains(lower(type), 'temporary') THEN 'TEMPORARY' END AS contract_type,
    'Uncategorized' AS category_label, CAST(NULL AS VARCHAR) AS category_tag,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
    link AS job_url, CAST(updated AS TIMESTAMP) AS posted_at,
    'jooble' AS source, '{INGESTION_DATE}' AS ingestion_date,
    'jooble-{RUN_DATE}-a-' || lpad(CAST(floor(k / {FEED_BATCH_ROWS}) AS BIGINT)::VARCHAR, 6, '0') AS batch_id,
    '{FIRST_INGEST}' AS ingested_at, k
  FROM flat_parsed
),
all_norm AS (
  SELECT * FROM nested_norm UNION ALL SELECT * FROM flat_norm
),
with_ids AS (
  SELECT * FROM all_norm WHERE job_id IS NOT NULL
),
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id
                                 ORDER BY CAST(ingested_at AS TIMESTAMPTZ) DESC, batch_id DESC) AS rn
    FROM with_ids) WHERE rn = 1
),
standardized AS (
  SELECT * REPLACE (coalesce(upper(trim(contract_time)), 'UNKNOWN') AS contract_time,
                    coalesce(upper(trim(contract_type)), 'UNKNOWN') AS contract_type)
  FROM deduped
),
scaled AS (
  SELECT * REPLACE (CASE WHEN salary_min < 1000 THEN salary_min * 1000 ELSE salary_min END AS salary_min,
                    CASE WHEN salary_max < 1000 THEN salary_max * 1000 ELSE salary_max END AS salary_max)
  FROM standardized
),
silver AS (
  SELECT job_id, title, company_name, location_name, salary_min, salary_max, salary_is_predicted,
    contract_time, contract_type, category_label, category_tag, latitude, longitude, job_url,
    posted_at, source, ingestion_date,
    sha256(coalesce(category_label, '') || '||' || coalesce(category_tag, '')) AS category_id,
    sha256(coalesce(company_name, '')) AS company_id,
    sha256(coalesce(location_name, '')) AS location_id
  FROM scaled
),
detail AS (
  SELECT job_id, title, company_name, category_label, location_name, contract_time, contract_type,
    posted_at, CAST(posted_at AS DATE) AS posted_date, salary_min, salary_max,
    (salary_min + salary_max) / 2 AS salary_avg,
    CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL
         THEN CAST(salary_min AS VARCHAR) || ' - ' || CAST(salary_max AS VARCHAR)
         ELSE 'Not available' END AS salary_range,
    salary_is_predicted, (salary_min IS NOT NULL AND salary_max IS NOT NULL) AS is_salary_available,
    latitude, longitude, category_tag, category_id, company_id, location_id, job_url, source,
    lower(concat_ws(' ', title, company_name, category_label, location_name, contract_time, contract_type))
      AS job_search_text,
    ingestion_date
  FROM silver
),
summary AS (
  SELECT ingestion_date, category_label, count(*) AS total_jobs,
    avg((salary_min + salary_max) / 2) AS avg_salary, min(salary_min) AS min_salary,
    max(salary_max) AS max_salary, quantile_disc((salary_min + salary_max) / 2, 0.5) AS median_salary,
    sum(CASE WHEN contract_time = 'FULL_TIME' THEN 1 ELSE 0 END) / count(*) AS pct_full_time,
    sum(CASE WHEN contract_time = 'PART_TIME' THEN 1 ELSE 0 END) / count(*) AS pct_part_time,
    sum(CASE WHEN contract_time = 'UNKNOWN' THEN 1 ELSE 0 END) / count(*) AS pct_unknown
  FROM silver GROUP BY ingestion_date, category_label
),
salary_an AS (
  SELECT contract_time, count(*) AS job_count, avg(salary_min) AS avg_salary_min,
    avg(salary_max) AS avg_salary_max, quantile_disc(salary_max, 0.5) AS median_salary,
    max(salary_max) AS max_salary, min(salary_min) AS min_salary
  FROM silver GROUP BY contract_time
),
page_rows AS (
  SELECT k, n_name AS country, n_nationkey, CAST(floor(k / {PAGE_KEYS}) + 1 AS INTEGER) AS page
  FROM nested_src
),
pages AS (
  SELECT country, page, n_nationkey,
    (n_nationkey = {EMPTY_PAGE_NATION} AND page = {EMPTY_PAGE_NO}) AS is_empty
  FROM page_rows GROUP BY country, page, n_nationkey
)
"""


def q(select: str) -> str:
    """A query over the shared steps."""
    return f"WITH {STEPS.strip()}\n{select.strip()}"


TS = "strftime(posted_at, '%Y-%m-%d %H:%M:%S') AS posted_at"
