"""Job-advert feeds derived from the benchmark tables.

The given tables hold orders and parts, not job adverts, and have no NULLs, so
the feeds derive both by arithmetic on the keys. The same rules are written as
SQL in ``hirelake.plans.oracle`` so that DuckDB can check every query.

    nested feed  orders x customer x nation, one advert per order, plus a
                 second, later copy with another title for every key % 50 = 1
    flat feed    part, one advert per part, salary and contract as free text
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.normalize import FLAT_SOURCE, NESTED_SOURCE

RUN_DATE = "2026-05-20"
INGESTION_DATE = "2026/05/20"
FIRST_INGEST = "2026-05-20T08:00:00+00:00"
UPDATE_INGEST = "2026-05-20T20:00:00+00:00"
FEED_BATCH_ROWS = 100
UPDATE_EVERY, UPDATE_AT = 50, 1
UPDATE_SUFFIX = " (updated)"
URL_BASE = "https://jobs.invalid"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def nested_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw nested record per order (column ``job``) and its key ``k``."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    tp = F.col("o_totalprice")
    # every 29th advert has its bounds in the wrong order
    salary_min = F.when(k % 7 == 0, F.lit(None)).when(k % 3 == 0, F.floor(tp / 1000)) \
        .when(k % 29 == 0, F.floor(tp) + 5000).otherwise(F.floor(tp)).cast("double")
    salary_max = F.when(k % 7 == 0, F.lit(None)).when(k % 3 == 0, F.floor(tp / 800)) \
        .when(k % 29 == 0, F.floor(tp)).otherwise(F.floor(tp) + 5000).cast("double")
    status = F.col("o_orderstatus")
    contract_time = F.when(k % 59 == 0, "shift").when(status == "F", " full_time ") \
        .when(status == "P", "part_time")
    # five broad categories and one per segment and nation; some have none
    label = _null_when(k % 37 == 0, F.when(k % 3 == 1, F.concat_ws(
        " ", "c_mktsegment", "n_name")).otherwise(F.col("c_mktsegment")))
    # ISO dates, epoch seconds, and text that is no time
    created = F.when(k % 67 == 0, "soon").when(k % 11 == 0, F.unix_timestamp(
        F.col("o_orderdate").cast("timestamp")).cast("string")).otherwise(
        F.col("o_orderdate").cast("string"))
    m5 = k % 5
    contract_type = (F.when(m5 == 0, "permanent").when(m5 == 1, "contract")
                     .when(m5 == 2, "temporary").when(m5 == 3, "internship"))
    job = F.struct(
        _null_when(k % 97 == 0, k.cast("string")).alias("id"),
        _null_when(k % 43 == 0, F.col("o_orderpriority")).alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.struct(label.alias("label"), F.lower(label).alias("tag")).alias("category"),
        F.struct(_null_when(k % 41 == 0, F.col("c_name")).alias("display_name")).alias("company"),
        F.struct(_null_when(k % 53 == 0, F.col("n_name")).alias("display_name"),
                 F.array(F.col("n_name")).alias("area")).alias("location"),
        contract_time.alias("contract_time"),
        contract_type.alias("contract_type"),
        created.alias("created"),
        F.when(k % 2 == 0, "1").otherwise("0").alias("salary_is_predicted"),
        salary_min.alias("salary_min"),
        salary_max.alias("salary_max"),
        (F.col("n_nationkey") * 1.5).cast("double").alias("latitude"),
        ((F.col("o_custkey") % 360) - 180).cast("double").alias("longitude"),
        F.concat(F.lit(f"{URL_BASE}/ad/"), k.cast("string")).alias("redirect_url"),
        F.col("n_name").alias("_source_country"),
    )
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(k.alias("k"), job.alias("job")))


def _feed_batch_id(source: str, tag: str, k: Column, rows: int) -> Column:
    return F.concat_ws("-", F.lit(source), F.lit(RUN_DATE), F.lit(tag),
                       F.lpad(F.floor(k / rows).cast("string"), 6, "0"))


def nested_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exploded Bronze rows of the nested feed: source, batch_id, ingested_at, job.

    Every order once in the morning batches; keys % 50 = 1 again in an evening
    batch with a changed title, so deduplication must keep the later copy.
    """
    src = nested_source_rows(spark, sf_dir)
    k = F.col("k")
    first = F.struct(
        F.lit(NESTED_SOURCE).alias("source"),
        _feed_batch_id(NESTED_SOURCE, "a", k, FEED_BATCH_ROWS).alias("batch_id"),
        F.lit(FIRST_INGEST).alias("ingested_at"),
        F.col("job").alias("job"))
    later = F.struct(
        F.lit(NESTED_SOURCE).alias("source"),
        _feed_batch_id(NESTED_SOURCE, "b", k, FEED_BATCH_ROWS * UPDATE_EVERY).alias("batch_id"),
        F.lit(UPDATE_INGEST).alias("ingested_at"),
        F.col("job").withField("title", F.concat(F.col("job.title"), F.lit(UPDATE_SUFFIX)))
        .alias("job"))
    # one scan of the orders gives both copies
    copies = F.when(k % UPDATE_EVERY == UPDATE_AT, F.array(first, later)).otherwise(F.array(first))
    return src.select("k", F.explode(copies).alias("_c")).select("_c.*", "k")


def flat_salary_text(k: Column, size: Column) -> Column:
    """Salary text over the shapes the parser must handle, chosen by key % 8."""
    s = lambda off: (size + off).cast("string")
    m = k % 8
    return (F.when(m == 0, F.concat(F.lit("$"), s(60), F.lit(",000 - $"), s(90), F.lit(",000 a year")))
            .when(m == 1, F.concat(s(40), F.lit("k - "), s(60), F.lit("k")))
            .when(m == 2, F.concat(s(70), F.lit("-"), s(90), F.lit("k")))
            .when(m == 3, F.concat(F.lit("$"), s(20), F.lit(" per hour + 401k")))
            .when(m == 4, F.concat(size.cast("string"), F.lit(".5 K")))
            .when(m == 5, F.lit("DOE"))
            .when(m == 6, F.lit("")))


def flat_type_text(k: Column) -> Column:
    m = k % 6
    return (F.when(m == 0, "Full-time, Permanent").when(m == 1, "Part-time")
            .when(m == 2, "Contract").when(m == 3, "Temporary").when(m == 4, "Internship"))


def flat_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw flat record per part (column ``job``) and its key ``k``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    updated = F.concat(F.lit("2026-05-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"),
                       F.lit("T"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":30:00"))
    job = F.struct(
        k.cast("string").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("company"),
        F.col("p_type").alias("location"),
        flat_salary_text(k, F.col("p_size")).alias("salary"),
        flat_type_text(k).alias("type"),
        F.concat(F.lit(f"{URL_BASE}/job/"), k.cast("string")).alias("link"),
        updated.alias("updated"),
        F.lit(None).cast("string").alias("snippet"),
        F.lit(FLAT_SOURCE).alias("source"),
    )
    return p.select(k.alias("k"), job.alias("job"))


def flat_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exploded Bronze rows of the flat feed: source, batch_id, ingested_at, job."""
    return flat_source_rows(spark, sf_dir).select(
        F.lit(FLAT_SOURCE).alias("source"),
        _feed_batch_id(FLAT_SOURCE, "a", F.col("k"), FEED_BATCH_ROWS).alias("batch_id"),
        F.lit(FIRST_INGEST).alias("ingested_at"), "job", "k")


PAGE_KEYS = 1000          # order keys per page range
EMPTY_PAGE_NATION = 7     # this nation's page 3 is landed empty
EMPTY_PAGE_NO = 3


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API pages as landed: (country, page, results array of records).

    Orders are paged by key range per customer nation; one page is empty so
    the paging stop is exercised. Each page holds at most PAGE_KEYS records.
    """
    src = nested_source_rows(spark, sf_dir)
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = (src.select("k", "job", F.col("job._source_country").alias("country"),
                       (F.floor(F.col("k") / PAGE_KEYS) + 1).cast("int").alias("page"))
            .join(n, F.col("country") == n.n_name))
    pages = (rows.groupBy("country", "page", "n_nationkey")
             .agg(F.sort_array(F.collect_list(F.struct("k", F.col("job").dropFields(
                 "_source_country").alias("job")))).alias("_items")))
    is_empty = (F.col("n_nationkey") == EMPTY_PAGE_NATION) & (F.col("page") == EMPTY_PAGE_NO)
    results = F.transform("_items", lambda x: x["job"])
    return pages.select("country", "page",
                        F.when(is_empty, F.slice(results, 1, 0)).otherwise(results)
                        .alias("results"))


def land_feeds(spark: SparkSession, sf_dir: str, bronze_root: str,
               one_document_per_file: bool = False) -> None:
    """Write both feeds as Bronze batch documents (S3 + S2) for RUN_DATE.

    The nested feed lands twice: every order in the morning run and the
    updated copies in the evening run.
    """
    from hirelake.operators.batches import build_batches
    from hirelake.schemas import FLAT_RECORD, NESTED_RECORD
    from hirelake.session import passing
    from hirelake.sources.lake import write_bronze

    nested = nested_source_rows(spark, sf_dir).select("k", "job.*")
    nested_cols = [f.name for f in NESTED_RECORD.fields]
    updates = (nested_source_rows(spark, sf_dir).where(F.col("k") % UPDATE_EVERY == UPDATE_AT)
               .select("k", F.col("job").withField(
                   "title", F.concat(F.col("job.title"), F.lit(UPDATE_SUFFIX))).alias("job"))
               .select("k", "job.*"))
    flat = flat_source_rows(spark, sf_dir).select("k", "job.*")
    flat_cols = [f.name for f in FLAT_RECORD.fields]
    runs = [(NESTED_SOURCE, nested, nested_cols, FIRST_INGEST),
            (NESTED_SOURCE, updates, nested_cols, UPDATE_INGEST),
            (FLAT_SOURCE, flat, flat_cols, FIRST_INGEST)]
    for source, df, cols, ingested_at in runs:
        with passing(spark):
            env = build_batches(df, source, ["k"], FEED_BATCH_ROWS, ingested_at, cols)
            write_bronze(env.drop("batch_no"), bronze_root, source, RUN_DATE,
                         one_document_per_file=one_document_per_file)
