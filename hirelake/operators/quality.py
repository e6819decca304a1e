"""Silver quality (Q1-Q8): checks report, never stop unless asked to."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.functions.contract import CONTRACT_TIME_DOMAIN, CONTRACT_TYPE_DOMAIN
from hirelake.session import stored

log = logging.getLogger("hirelake.quality")

REQUIRED_FIELDS = ["job_id", "title", "company_name"]
WARNING, CRITICAL = "warning", "critical"
LEVELS = (WARNING, CRITICAL)
_RANK = {WARNING: 1, CRITICAL: 2}


class QualityError(Exception):
    """A check at or above the ``fail_on`` severity failed."""


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    failed: object  # Column: number of failing rows (aggregate expression)


def _single_pass_checks() -> list[Check]:
    checks = [Check("required_field", c, F.count_if(F.col(c).isNull())) for c in REQUIRED_FIELDS]
    checks.append(Check("salary_order", "salary_min,salary_max",
                        F.count_if(F.col("salary_min") > F.col("salary_max"))))
    # NOT IN gives NULL for a NULL value, and count_if skips NULL: not counted.
    checks.append(Check("contract_type_domain", "contract_type",
                        F.count_if(~F.col("contract_type").isin(CONTRACT_TYPE_DOMAIN))))
    checks.append(Check("contract_time_domain", "contract_time",
                        F.count_if(~F.col("contract_time").isin(CONTRACT_TIME_DOMAIN))))
    return checks


def check_aggregates(df: DataFrame) -> list:
    """Q1, Q3, Q4, Q5 and the row count as aggregate expressions (for ``observe``)."""
    return [c.failed.alias(f"{c.name}:{c.column}") for c in _single_pass_checks()] + [
        F.count(F.lit(1)).alias("rows")]


def duplicate_keys(df: DataFrame, key: str = "job_id") -> DataFrame:
    """Q2: number of keys seen more than once (NULL is a key too). Partial
    aggregation keeps a hot key to one row per partition before the shuffle."""
    return (df.groupBy(key).count().where(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("duplicate_keys")))


def offenders(df: DataFrame, column: str, domain: list[str] | None = None) -> DataFrame:
    """Q6: values outside the domain with their counts, most frequent first."""
    domain = _domain(column) if domain is None else domain
    return (df.where(~F.col(column).isin(domain)).groupBy(column)
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last(column)))


def _domain(column: str) -> list[str]:
    return CONTRACT_TYPE_DOMAIN if column == "contract_type" else CONTRACT_TIME_DOMAIN


def offending_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``field, value`` of every value outside its column's domain, in one scan."""
    outside = [F.when(~F.col(c).isin(_domain(c)), F.struct(
        F.lit(c).alias("field"), F.col(c).alias("value"))) for c in columns]
    return df.select(F.explode(F.array(*outside)).alias("w")).where("w IS NOT NULL").select("w.*")


def top_offenders(df: DataFrame, columns: list[str], n: int = 20,
                  buckets: int = 1 << 14) -> DataFrame:
    """Q6: ``field, place, value, count``, each column's ``n`` most frequent values
    outside its domain (ties: the smaller value), exactly.

    A mergeable sketch first: rows per hash bucket, ``buckets`` numbers a column however
    many different values there are. A value is at most as frequent as its bucket, so
    the values of the ``n`` fullest buckets are counted exactly, and then those of the
    other buckets that are as full as the least of the best ``n`` found. Where one of a
    million values stands out, a few buckets of them are counted.
    """
    bad = offending_values(df, columns).withColumn(
        "bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    sketch = stored(bad.groupBy("field", "bucket").agg(F.count(F.lit(1)).alias("rows")),
                    "offenders-sketch")
    fullest = Window.partitionBy("field").orderBy(F.desc("rows"), "bucket")
    best = Window.partitionBy("field").orderBy(F.desc("count"), F.asc("value"))

    def counted(chosen: DataFrame) -> DataFrame:
        return bad.join(chosen, ["field", "bucket"], "left_semi").groupBy("field", "value").agg(
            F.count(F.lit(1)).alias("count"))

    first = counted(sketch.withColumn("place", F.row_number().over(fullest)).where(
        F.col("place") <= n))
    found = first.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n)
    # with fewer than n values so far every bucket may hold another
    least = stored(found.groupBy("field").agg(F.when(F.count(F.lit(1)) == n, F.min("count")).otherwise(
        F.lit(0)).alias("least")), "offenders-least")
    chosen = sketch.join(least, "field").where("rows >= least").select("field", "bucket")
    return counted(chosen).withColumn("place", F.row_number().over(best).cast("long")).where(
        F.col("place") <= n).select("field", "place", "value", "count")


def quality_report(df: DataFrame, severities: dict[str, str] | None = None,
                   include_duplicates: bool = True) -> DataFrame:
    """Q7: one row per check: (check, column, severity, failed).

    Q1/Q3/Q4/Q5 are one aggregate. Q2 groups by ``job_id``; with it the checks are
    counted per key in the same aggregate and added up, so the input is read once (skip
    it with ``include_duplicates=False`` after N9, where it is always 0). Every check is
    a warning unless ``severities`` says otherwise (Q8).
    """
    severities = severities or {}
    checks = _single_pass_checks()
    counts = [c.failed.alias(f"c{i}") for i, c in enumerate(checks)]
    if include_duplicates:
        total = [F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(checks))]
        one = df.groupBy("job_id").agg(*counts, F.count(F.lit(1)).alias("n")).agg(
            *total, F.count_if(F.col("n") > 1).alias(f"c{len(checks)}"))
        checks = [*checks, Check("duplicates", "job_id", None)]
    else:
        one = df.agg(*counts)
    rows = [F.struct(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"),
                     F.lit(severities.get(c.name, WARNING)).alias("severity"),
                     F.col(f"c{i}").cast("long").alias("failed"))
            for i, c in enumerate(checks)]
    return one.select(F.inline(F.array(*rows)))


def enforce(report_rows: list, fail_on: str | None = CRITICAL) -> list:
    """Q8: log every failed check; raise if one is at or above ``fail_on``."""
    worst = []
    for r in report_rows:
        if r["failed"] and r["failed"] > 0:
            log.warning("%s on %s: %d rows (%s)", r["check"], r["column"], r["failed"],
                        r["severity"])
            if fail_on and _RANK.get(r["severity"], 0) >= _RANK[fail_on]:
                worst.append(r)
    if worst:
        raise QualityError("; ".join(f"{r['check']}:{r['column']}={r['failed']}" for r in worst))
    return report_rows
