"""Ingestion shaping: batch envelopes (S3) and landed API pages."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, CalendarIntervalType, DataType, MapType, NullType,
                               StructType)

from hirelake.session import checkpoint_dir, stored

DEFAULT_BATCH_SIZE = 100
BROADCAST_COUNTRIES = 10_000


def _in_parquet(kind: DataType) -> bool:
    """Whether Parquet holds values of a type; a record of any columns may come."""
    if isinstance(kind, StructType):
        return bool(kind.fields) and all(_in_parquet(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _in_parquet(kind.elementType)
    if isinstance(kind, MapType):
        return _in_parquet(kind.keyType) and _in_parquet(kind.valueType)
    return not isinstance(kind, (NullType, CalendarIntervalType))


def with_positions(df: DataFrame, order_by: list[str], name: str = "_pos") -> DataFrame:
    """0-based position of each row in the total order ``order_by`` (unique).

    Distributed, without a global window: range-partition and sort on the key,
    take each row's index inside its partition, and add the number of rows of
    all earlier partitions (one small row per partition, broadcast; its size is
    bounded by the partition count). The ranged frame is written to the
    shared checkpoint folder so that both passes, and any retried task, see the
    same partitions: as a compressed table, which takes a fifth of a checkpoint
    and lets go of the shuffle that led to it.
    """
    ranged = (df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.col("_part").cast("long"), 33)))
    if _in_parquet(ranged.schema):
        ranged = stored(ranged, "positions")
    else:
        checkpoint_dir(df.sparkSession)
        ranged = ranged.checkpoint(eager=True)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part")
                          .rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .alias("_offset"))
    return (ranged.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_local"))
            .drop("_part", "_local", "_offset"))


def batch_id(source, ingested_at, batch_no) -> F.Column:
    """Deterministic batch id: a rerun of the same input gives the same ids."""
    return F.sha2(F.concat_ws("|", source, ingested_at, batch_no.cast("string")), 256)


def build_batches(records: DataFrame, source: str, order_by: list[str],
                  batch_size: int = DEFAULT_BATCH_SIZE,
                  ingested_at: str | None = None,
                  record_columns: list[str] | None = None) -> DataFrame:
    """S3: order-preserving envelopes of exactly ``batch_size`` records (the
    last may be shorter); empty input gives no batch.

    Output: batch_id, source, ingested_at (one per run, ISO UTC), record_count,
    records (array of struct in input order) and batch_no. Each group holds at
    most ``batch_size`` records, so no group is ever large.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    ingested_at = ingested_at or _dt.datetime.now(_dt.timezone.utc).isoformat()
    cols = record_columns or [c for c in records.columns]
    keys = [f"_k{i}" for i in range(len(order_by))]
    positioned = with_positions(
        records.select(*[F.col(c).alias(k) for c, k in zip(order_by, keys)],
                       F.struct(*cols).alias("_rec")),
        keys)
    return group_batches(positioned, source, ingested_at, batch_size)


def group_batches(positioned: DataFrame, source: str, ingested_at: str, batch_size: int,
                  first: int = 0) -> DataFrame:
    """Envelopes of records ``_rec`` at positions ``_pos``, numbered from ``first``."""
    batch_no = F.floor(F.col("_pos") / batch_size).cast("long") + F.lit(first).cast("long")
    grouped = (positioned.withColumn("batch_no", batch_no)
               .groupBy("batch_no")
               .agg(F.sort_array(F.collect_list(F.struct("_pos", "_rec"))).alias("_items")))
    src, ing = F.lit(source), F.lit(ingested_at)
    return grouped.select(
        batch_id(src, ing, F.col("batch_no")).alias("batch_id"),
        src.alias("source"),
        ing.alias("ingested_at"),
        F.size("_items").cast("long").alias("record_count"),
        F.transform("_items", lambda x: x["_rec"]).alias("records"),
        "batch_no")


def flatten_pages(pages: DataFrame, array_field: str, max_pages: int | None = None,
                  country_tag: bool = False, country: str = "country",
                  page: str = "page") -> DataFrame:
    """Records of landed API pages, as the paging loop would return them.

    Per country, pages 1..max_pages are kept up to (not including) the first
    empty page; a missing array counts as empty. Output: country, page, pos,
    record (with ``_source_country`` when ``country_tag``). The first-empty
    table has one row per country that has an empty page; up to
    ``BROADCAST_COUNTRIES`` rows (counted first) it is sent to the pages, so
    their arrays are not shuffled. Beyond that it joins by country, which AQE
    splits where a country is hot.
    """
    arr = F.col(array_field)
    empty = F.coalesce(F.size(arr), F.lit(0)) <= 0
    first_empty = (pages.where(empty).groupBy(country)
                   .agg(F.min(page).alias("_first_empty")))
    if first_empty.limit(BROADCAST_COUNTRIES + 1).count() <= BROADCAST_COUNTRIES:
        first_empty = F.broadcast(first_empty)
    kept = pages.join(first_empty, country, "left").where(
        (F.col(page) >= 1)
        & (F.col("_first_empty").isNull() | (F.col(page) < F.col("_first_empty"))))
    if max_pages is not None:
        kept = kept.where(F.col(page) <= max_pages)
    out = kept.select(country, page, F.posexplode(arr).alias("pos", "record"))
    if country_tag:
        out = out.withColumn("record", F.col("record").withField(
            "_source_country", F.col(country).cast("string")))
    return out
