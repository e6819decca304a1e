"""Lake layout: Bronze JSON (S1, S2), Silver (S8, S9) and Gold (S10, S11) Parquet.

    <bronze>/source=<name>/dt=YYYY-MM-DD/part-*.json[.gz]
    <silver>/dt=YYYY-MM-DD/run=<id>/bucket=<n>/part-*.parquet
    <gold>/<table>/dt=YYYY-MM-DD/run=<id>/part-*.parquet

Silver and Gold days are versions (``sources/versions.py``): a run writes a folder of its
own and then names it in the day's log, which readers resolve; a day's readers open that
day's folders only. Silver is dealt to ``BUCKETS`` hash buckets of ``job_id`` and keeps
the lineage columns in its files, so a later batch can be merged into the buckets it
touches (``merge_silver``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from hirelake.functions.time import to_dt
from hirelake.operators.quarantine import CORRUPT
from hirelake.operators.silver import deduplicate_latest
from hirelake.schemas import LINEAGE_COLUMNS
from hirelake.session import (dealt_at, file_system, passing, released, split_at, stored,
                              unsorted)
from hirelake.sources import versions
from hirelake.sources.registry import source_spec

GOLD_TABLES = ("jobs_summary", "salary_analysis", "jobs_detail")
# Columns the serving filters use most; jobs_detail files are sorted by them
# within each write task (no shuffle), so Parquet min/max statistics let an
# `isin` facet filter skip whole row groups.
DETAIL_CLUSTER = ("category_label", "contract_time", "source")
# Upper bound of rows per Parquet file for the row-per-job tables (Silver,
# jobs_detail): a large day is split into bounded files however few tasks
# write it.
MAX_RECORDS_PER_FILE = 2_000_000
# Bytes of files that a task of jobs_detail reads at most: it sorts their rows in memory.
DETAIL_SPLIT = 32 << 20
# The same for Bronze and Silver, whose rows are sorted by job or bucket.
SILVER_SPLIT = 16 << 20
# Documents in a compressed Bronze file at most: one task reads it whole.
DOCUMENTS_PER_FILE = 1000
# The dashboard's facet values with their counts, written beside the Gold tables.
FACETS = "facets"
# Gold tables small enough to store as one file: one row per group of a
# bounded key (category x day, contract time).
SMALL_GOLD_TABLES = ("jobs_summary", "salary_analysis", FACETS)


# Order of the rows in those files (G12 for salary_analysis); NULLs last.
GOLD_ORDER = {"jobs_summary": (("ingestion_date", True), ("category_label", True)),
              "salary_analysis": (("avg_salary_max", False), ("contract_time", True)),
              FACETS: (("facet", True), ("place", True))}


def bronze_path(root: str, source: str, dt: str | None = None) -> str:
    base = f"{root.rstrip('/')}/source={source}"
    return base if dt is None else f"{base}/dt={to_dt(dt)}"


def write_bronze(envelopes: DataFrame, root: str, source: str, dt: str,
                 one_document_per_file: bool = False, mode: str = "append") -> None:
    """Land batch envelopes as JSON Lines under source and day, many batches
    a file (``one_document_per_file``: one batch a file). JSON Lines are gzipped,
    in files small enough for a task each.

    The source goes into the path, not ``partitionBy``: the documents keep
    their ``source`` key, which the Bronze gate requires.
    """
    spark = envelopes.sparkSession
    writer = envelopes.withColumn("dt", F.lit(to_dt(dt))).write.mode(mode).partitionBy("dt")
    if one_document_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    else:
        writer = writer.option("maxRecordsPerFile", DOCUMENTS_PER_FILE).option("compression", "gzip")
    with split_at(spark, SILVER_SPLIT), released(spark):
        writer.json(bronze_path(root, source))


def read_bronze(spark: SparkSession, root: str, source: str, dt: str,
                multi_line: bool = False, with_file: bool = False,
                files: list[str] | None = None, with_corrupt: bool = False) -> DataFrame:
    """Every batch of one source and day, with the source's fixed schema.

    JSON Lines by default; ``multi_line`` reads one JSON document per file;
    a missing folder raises PATH_NOT_FOUND. ``with_file`` adds ``source_file``
    (the document's path) so a bad record can be traced to its batch file; ``files``
    reads these of the day's files alone; ``with_corrupt`` adds both the file and the
    text of documents that lost a value (``operators/quarantine.py``).
    """
    schema = StructType(source_spec(source).envelope_schema.fields)
    if with_corrupt:
        schema = schema.add(CORRUPT, StringType())
    df = (spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
          .option("multiLine", multi_line).option("mode", "PERMISSIVE")
          .json(files or bronze_path(root, source, dt)))
    if with_file or with_corrupt:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


BUCKETS = 16      # hash buckets of job_id in a Silver day; an entry says how many it has


# The hash of a day's buckets; days that were begun with another keep it. Spark's shuffles
# deal by this one: with a multiple of BUCKETS partitions, each has rows of one bucket.
HASHED = "hash"


def _bucket(buckets: int, hashed: str = HASHED):
    return F.pmod(F.call_function(hashed, F.col("job_id")), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, path: str, dealt: bool = False) -> list[int]:
    """Write rows by their ``bucket``; the buckets that have rows. Unless they are
    ``dealt`` already they are shuffled, so that few tasks write each bucket. Dealt rows
    have been sorted by job in the same task: they are not sorted again."""
    spark, out = df.sparkSession, df if dealt else df.hint("rebalance", F.col("bucket"))
    with (split_at(spark, SILVER_SPLIT), dealt_at(spark, DETAIL_SPLIT), released(spark),
          unsorted(spark, BUCKETS if dealt else 0)):
        (out.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("bucket")
         .parquet(path))
    return [int(n.split("=")[1]) for n in versions._names(spark, path)
            if n.startswith("bucket=")]


class Staged:
    """A Silver day that is written but not yet what readers see."""

    def __init__(self, spark: SparkSession, root: str, dt: str, run: str, schema: StructType,
                 paths: dict[str, str], buckets: int, after: versions.Entry | None,
                 hashed: str = HASHED):
        self.spark, self.root, self.dt, self.run = spark, root, dt, run
        self.schema, self.paths, self.buckets, self.after = schema, paths, buckets, after
        self.hashed = hashed
        self.facts: dict[str, dict] = {}

    def written(self) -> DataFrame:
        """The rows that this run wrote, with their ``bucket``."""
        folder = f"{self.root.rstrip('/')}/{self.run}"
        if not any(p.startswith(self.run) for p in self.paths.values()):
            return self.spark.createDataFrame([], StructType(self.schema.fields).add("bucket", IntegerType()))
        return self.spark.read.schema(StructType(self.schema.fields).add("bucket", IntegerType())).parquet(
            folder)

    def rows(self) -> DataFrame:
        """The whole day as it would be."""
        paths = [f"{self.root.rstrip('/')}/{p}" for p in self.paths.values()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.root).parquet(
            *paths).select(*self.schema.names)

    def measure(self, aggregates: list) -> dict[str, int]:
        """Sums of figures over the day: counted for the buckets just written, and taken
        from the log for those carried over."""
        fresh = self.written().groupBy("bucket").agg(*aggregates).collect()
        self.facts = {b: f for b, f in (self.after.facts if self.after else {}).items()
                      if b in self.paths and not self.paths[b].startswith(self.run)}
        names = [a for a in self.written().agg(*aggregates).columns]
        self.facts |= {str(r["bucket"]): {n: r[n] for n in names} for r in fresh}
        return {n: sum(f[n] for f in self.facts.values()) for n in names}

    def publish(self) -> versions.Entry:
        entry = versions.publish(self.spark, self.root, self.dt, self.after, self.schema.json(),
                                 self.paths, self.buckets, self.facts, self.hashed)
        versions.expire(self.spark, self.root, self.dt)
        return entry

    def discard(self) -> None:
        versions.remove(self.spark, f"{self.root.rstrip('/')}/{self.run}")


def stage_silver(df: DataFrame, root: str, dt: str, buckets: int | None = None,
                 dealt: bool = False) -> Staged:
    """Write a whole day of Silver; ``Staged.publish`` makes it the day.

    ``dealt``: the rows come out of ``deduplicate_latest``, whose shuffle by job has
    brought those of a bucket together, so they are not shuffled for the write.
    """
    spark = df.sparkSession
    after = versions.current(spark, root, dt)
    buckets = buckets or (after.buckets if after else BUCKETS)
    run = versions.new_run(dt)
    held = _write_buckets(df.withColumn("bucket", _bucket(buckets)), f"{root.rstrip('/')}/{run}", dealt)
    return Staged(spark, root, dt, run, df.schema, {str(b): f"{run}/bucket={b}" for b in held},
                  buckets, after)


BROADCAST_JOBS = 2_000_000    # 64-bit hashes of jobs that a merge sends to the stored rows at most


def _contested(rows: DataFrame, batch: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Of a batch and the stored rows of its buckets: those that deduplication must see, and
    the stored rows that stay as they are (None if all must be seen).

    A stored row stays when no other row has its job's hash. The hashes that repeat, or
    are the batch's, are sent to the stored rows, so that these need no shuffle; there
    may be ``BROADCAST_JOBS`` of them.
    """
    named = F.xxhash64("job_id").alias("_job")
    seen = batch.select(named, F.lit(True).alias("_new")).unionByName(
        old.select(named, F.lit(False).alias("_new"))).groupBy("_job").agg(
        F.count(F.lit(1)).alias("n"), F.max("_new").alias("_new"))
    jobs = stored(seen.where("_new OR n > 1").select("_job"), "merge-jobs")
    if jobs.count() > BROADCAST_JOBS:
        return rows.unionByName(old.select(*rows.columns)), None
    known, jobs = old.withColumn("_job", named), F.broadcast(jobs)
    again = known.join(jobs, "_job", "left_semi").select(*rows.columns)
    return rows.unionByName(again), known.join(jobs, "_job", "left_anti").drop("_job")


def merge_silver(batch: DataFrame, root: str, dt: str, dealt: bool = False) -> Staged:
    """N9 across runs: merge a batch of finished Silver rows (with lineage) into a day.

    Only the hash buckets that the batch touches are read and written; of each job the
    latest copy stays, as in one deduplication over everything. Batch ids are unique, so
    copies that tie in ``ingested_at`` and ``batch_id`` come in one batch. Merging a
    batch twice changes nothing, so a repeated micro-batch is harmless. Stored rows that
    no row of the batch contests are copied to the new files without a shuffle. ``dealt``
    as in ``stage_silver``, for a day that is not stored yet.
    """
    spark = batch.sparkSession
    after = versions.current(spark, root, dt)
    if after is None:
        return stage_silver(batch, root, dt, dealt=dealt)
    bucket, run, written = _bucket(after.buckets, after.hashed), versions.new_run(dt), []
    with passing(spark), split_at(spark, SILVER_SPLIT):
        held = stored(batch.withColumn("bucket", bucket), "merge-batch")
        touched = [str(r["bucket"]) for r in held.select("bucket").distinct().collect()]  # <= buckets
        old = [f"{root.rstrip('/')}/{after.paths[b]}" for b in touched if b in after.paths]
        rows, stay = held.drop("bucket"), None
        if old:
            rows, stay = _contested(rows, held, spark.read.schema(batch.schema).parquet(*old))
        fresh = deduplicate_latest(rows).select(*batch.columns, bucket.alias("bucket"))
        if stay is not None:
            fresh = fresh.unionByName(stay.withColumn("bucket", bucket))
        if touched:
            written = _write_buckets(fresh, f"{root.rstrip('/')}/{run}", dealt=True)
    paths = after.paths | {str(b): f"{run}/bucket={b}" for b in written}
    return Staged(spark, root, dt, run, batch.schema, paths, after.buckets, after, after.hashed)


def write_silver(df: DataFrame, root: str, dt: str, dealt: bool = False) -> None:
    """Overwrite one day of Silver."""
    stage_silver(df, root, dt, dealt=dealt).publish()


def read_silver(spark: SparkSession, root: str, dt: str | None = None) -> DataFrame:
    """Silver, one day (only its folders are opened) or all days."""
    rows = versions.read(spark, root, dt)
    return rows.drop("dt", *LINEAGE_COLUMNS)


def gold_path(root: str, table: str) -> str:
    if table not in (*GOLD_TABLES, FACETS):
        raise ValueError(f"unknown gold table {table}; known: {GOLD_TABLES}")
    return f"{root.rstrip('/')}/{table}"


def write_gold(df: DataFrame, root: str, table: str, dt: str) -> None:
    """Overwrite one day of a Gold table. The two aggregates go to one
    file; jobs_detail, one row per job, is written by as many tasks as it has
    partitions, each sorted by the facet columns."""
    spark, path = df.sparkSession, gold_path(root, table)
    if table in SMALL_GOLD_TABLES:
        # a shuffle of the finished rows; coalesce would pull the aggregate into one task
        out = df.repartition(1).sortWithinPartitions(*[
            F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in GOLD_ORDER[table]])
    else:
        order = [c for c in DETAIL_CLUSTER if c in df.columns]
        out = df.sortWithinPartitions(*order) if order else df
    after, run = versions.current(spark, path, dt), versions.new_run(dt)
    with split_at(spark, DETAIL_SPLIT), released(spark):
        out.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(f"{path}/{run}")
    versions.publish(spark, path, dt, after, df.schema.json(), {versions.WHOLE: run})
    versions.expire(spark, path, dt)


def read_gold(spark: SparkSession, root: str, table: str, dt: str | None = None,
              keep_dt: bool = False) -> DataFrame:
    """A Gold table, one day or all. ``keep_dt`` keeps the partition column,
    by which date filters over many days skip the other days' folders."""
    rows = versions.read(spark, gold_path(root, table), dt)
    return rows if keep_dt else rows.drop("dt")
