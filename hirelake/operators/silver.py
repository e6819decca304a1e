"""Silver operators: union (N7), NULL ids (N8), dedup (N9), contract codes (N10),
salary scale (N11), entity keys (N12) and the whole transform (N14)."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hirelake.functions.contract import standardize_code
from hirelake.functions.keys import category_key, entity_key
from hirelake.functions.salary import scale_salary
from hirelake.schemas import COMMON_COLUMNS, LINEAGE_COLUMNS, SILVER_COLUMNS


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name; numeric columns widen."""
    frames = list(frames)
    if not frames:
        raise ValueError("no source frames to union")
    return functools.reduce(DataFrame.unionByName, frames)


def drop_null_ids(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Drop rows without a job_id. The count removed is observed, not counted
    by a separate job."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("input_rows"),
                        F.count_if(F.col("job_id").isNull()).alias("null_job_ids"))
    return df.where(F.col("job_id").isNotNull())


def deduplicate_latest(df: DataFrame, key: str = "job_id", bounded: bool = False) -> DataFrame:
    """One row per key, deterministically the latest copy.

    Order: latest ``ingested_at`` (as a timestamp), then highest ``batch_id``,
    then the remaining columns as a total tie-break, so a retried task can never
    pick another survivor. Implemented as ``max(struct(order..., row...))`` per
    key: an aggregate with map-side partial aggregation, so a key that holds a
    third of all rows is folded to one row per partition before the shuffle (a
    window would send it whole to one task).

    That fold sorts whole rows, as many as a task holds; an input file's split may
    hold millions. So rows are dealt first to partitions of bounded size, whatever
    the input's splits are, and each is sorted in memory. They are dealt by
    key and lineage: a hot key's copies are spread, and a retry deals them alike.
    ``bounded``: the caller sees to it that each task's rows are few enough to be sorted
    in memory, as those of a scan in small splits; this saves one shuffle of all rows.
    """
    lineage = [c for c in LINEAGE_COLUMNS if c in df.columns]
    rest = [c for c in df.columns if c != key and c not in lineage]
    order = []
    if "ingested_at" in lineage:
        order.append(F.col("ingested_at").try_cast("timestamp").alias("_o_ingested"))
    if "batch_id" in lineage:
        order.append(F.col("batch_id").alias("_o_batch"))
    best = F.max(F.struct(*order, *[F.col(c) for c in lineage + rest])).alias("_best")
    dealt = df if bounded else df.hint("rebalance", *[F.col(c) for c in [key, *(lineage or rest[:1])]])
    return (dealt.groupBy(key).agg(best)
            .select(key, *[F.col(f"_best.{c}").alias(c) for c in lineage + rest]))


def standardize_contract_fields(df: DataFrame) -> DataFrame:
    """NULL -> UNKNOWN, else upper(trim(x)) for contract_time/contract_type."""
    return df.withColumns({c: standardize_code(c) for c in ("contract_time", "contract_type")})


def scale_salaries(df: DataFrame) -> DataFrame:
    """Salaries below 1000 are thousands; applied per column."""
    return df.withColumns({c: scale_salary(c) for c in ("salary_min", "salary_max")})


def add_entity_ids(df: DataFrame) -> DataFrame:
    """SHA-256 keys of category (label||tag), company and location."""
    return df.withColumns({
        "category_id": category_key("category_label", "category_tag"),
        "company_id": entity_key("company_name"),
        "location_id": entity_key("location_name"),
    })


class SilverMetrics:
    """Counts of one Silver build, filled by the first action on the result."""

    def __init__(self) -> None:
        self.ids = Observation("silver_ids")
        self.output = Observation("silver_output")

    def as_dict(self) -> dict:
        ids, out = self.ids.get, self.output.get
        rows_in, nulls, rows_out = ids["input_rows"], ids["null_job_ids"], out["silver_rows"]
        return {"input_rows": rows_in, "null_job_ids": nulls,
                "duplicates_removed": rows_in - nulls - rows_out, "silver_rows": rows_out,
                # missing or unparsable timestamps: try_cast gave NULL instead of failing
                "posted_at_null": out["posted_at_null"]}


def silver_transform(frames: DataFrame | Iterable[DataFrame],
                     metrics: SilverMetrics | None = None,
                     keep_lineage: bool = False, bounded: bool = False) -> DataFrame:
    """Union -> NULL ids -> dedup -> contract codes -> salary scale -> keys.

    One lazy plan; with ``metrics`` the removed counts are observed during the
    first action instead of costing counts of their own. ``bounded`` as in
    ``deduplicate_latest``.
    """
    df = frames if isinstance(frames, DataFrame) else union_sources(frames)
    df = drop_null_ids(df, metrics.ids if metrics else None)
    df = deduplicate_latest(df, bounded=bounded)
    df = standardize_contract_fields(df)
    df = scale_salaries(df)
    df = add_entity_ids(df)
    if metrics is not None:
        df = df.observe(metrics.output, F.count(F.lit(1)).alias("silver_rows"),
                        F.count_if(F.col("posted_at").isNull()).alias("posted_at_null"))
    cols = SILVER_COLUMNS + (LINEAGE_COLUMNS if keep_lineage else [])
    return df.select(*[c for c in cols if c in df.columns])


__all__ = ["union_sources", "drop_null_ids", "deduplicate_latest",
           "standardize_contract_fields", "scale_salaries", "add_entity_ids",
           "silver_transform", "SilverMetrics", "COMMON_COLUMNS"]
