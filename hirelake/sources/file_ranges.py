"""Least and greatest values of each file of a stored ``jobs_detail`` day, by which the
explorer's bounds and first jobs (D15, D18, D19) open few files or none.

``index_ranges`` writes a row a file: its rows, and for ``posted_date`` and ``salary_avg``
the least, the greatest and how many are present. ``salary_bounds`` is read off these
rows. ``top_jobs`` opens the files of the best bounds until they hold n values, takes the
n-th value there as a bar, and then opens just the files with a value that reaches the
bar; of these, row groups below it are skipped by Parquet's own statistics. A job below
the bar has n better ones, so the rows are those of ``serve.top_jobs`` on the whole day,
ties included. Where fewer than n values are present, for the default sort, or without
ranges, all files are read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirelake.operators import serve
from hirelake.session import file_system
from hirelake.sources import versions
from hirelake.sources.lake import gold_path

FOLDER = "_ranges"      # Spark's readers of the day pass over names with an underscore
COLUMNS = ("posted_date", "salary_avg")
SORTS = {serve.SORT_NEWEST: ("posted_date", True), serve.SORT_HIGHEST: ("salary_avg", True),
         serve.SORT_LOWEST: ("salary_avg", False)}


def _day(spark: SparkSession, gold_root: str, dt: str) -> tuple[list[str], StructType]:
    """The folders of a stored day and its schema."""
    root = gold_path(gold_root, "jobs_detail")
    entry = versions.current(spark, root, dt)
    if entry is None:
        raise FileNotFoundError(f"no stored day {dt} under {root}")
    return ([f"{root}/{p}" for p in dict.fromkeys(entry.paths.values())],
            StructType.fromJson(json.loads(entry.schema)))


def index_ranges(spark: SparkSession, gold_root: str, dt: str) -> None:
    """Write the ranges of a stored day's ``jobs_detail`` files: one scan of two columns."""
    folders, schema = _day(spark, gold_root, dt)
    for folder in folders:
        rows = spark.read.schema(StructType([schema[c] for c in COLUMNS])).parquet(folder)
        rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("rows"),
            *[f(c).alias(f"{name}_{c}") for c in COLUMNS
              for f, name in ((F.min, "least"), (F.max, "greatest"), (F.count, "present"))]
        ).write.mode("overwrite").parquet(f"{folder}/{FOLDER}")


def ranges(spark: SparkSession, gold_root: str, dt: str) -> DataFrame | None:
    """The stored ranges of a day; None if some of its folders have none."""
    found = []
    for folder in _day(spark, gold_root, dt)[0]:
        fs, where = file_system(spark, f"{folder}/{FOLDER}/_SUCCESS")
        if not fs.exists(where):
            return None
        found.append(f"{folder}/{FOLDER}")
    return spark.read.parquet(*found) if found else None


def _detail(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def salary_bounds(spark: SparkSession, gold_root: str, dt: str) -> DataFrame:
    """D15 without opening a file of the day, if it has ranges."""
    index = ranges(spark, gold_root, dt)
    if index is None:
        return serve.salary_bounds(_detail(spark, *_day(spark, gold_root, dt)))
    return index.agg(F.min("least_salary_avg").alias("salary_avg_min"),
                     F.max("greatest_salary_avg").alias("salary_avg_max"))


def top_jobs(spark: SparkSession, gold_root: str, dt: str, how: str = serve.SORT_NEWEST,
             n: int = 10) -> tuple[DataFrame, dict[str, int]]:
    """D18 and D19 over a stored day: its first ``n`` jobs of a sort, and how many of its
    ``files`` are ``read`` for them."""
    folders, schema = _day(spark, gold_root, dt)
    index = ranges(spark, gold_root, dt)
    files = index.count() if index is not None else 0
    whole = {"files": files, "read": files}
    if index is None or how not in SORTS:
        return serve.top_jobs(_detail(spark, folders, schema), how, n), whole
    column, down = SORTS[how]
    best = F.col(f"{'greatest' if down else 'least'}_{column}")
    held = index.where(F.col(f"present_{column}") > 0)
    first, have = [], 0
    # each of these files holds a value, so n of them are enough
    for r in held.orderBy(best.desc() if down else best.asc(), "file").limit(n).collect():
        if have < n:
            first.append(r["file"])
            have += r[f"present_{column}"]
    if have < n:
        return serve.top_jobs(_detail(spark, folders, schema), how, n), whole
    bar = serve.top_jobs(_detail(spark, first, schema), how, n).select(column).collect()[-1][0]
    reaches = (lambda c: c >= F.lit(bar)) if down else (lambda c: c <= F.lit(bar))
    opened = [r["file"] for r in held.where(reaches(best)).select("file").collect()]
    rows = _detail(spark, opened, schema).where(reaches(F.col(column)))
    return serve.top_jobs(rows, how, n), {"files": files, "read": len(opened)}
