"""Bronze gates (B1-B4), the Bronze job (B5) and record explode."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.schemas import LINEAGE_COLUMNS, REQUIRED_ENVELOPE_KEYS

log = logging.getLogger("hirelake.bronze")

# Fixed messages of the three gates, raised in this order.
EMPTY_MESSAGE = "Bronze data ingestion failed"
SCHEMA_MESSAGE = "Bronze schema validation failed"
CORRUPT_MESSAGE = "Bronze records corrupted"


class BronzeCheckError(Exception):
    """A Bronze gate failed; the raw data stays where it is."""


def gate_aggregates(df: DataFrame, required=REQUIRED_ENVELOPE_KEYS) -> list:
    """The figures that the gates need as aggregates, for ``agg`` or ``observe``.

    rows, null_records, and for each required column present in the frame the
    number of non-NULL values (``nonnull_<name>``).
    """
    present = [c for c in required if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("rows")]
    if "records" in df.columns:
        aggs.append(F.count_if(F.col("records").isNull()).alias("null_records"))
    else:
        aggs.append(F.lit(0).cast("long").alias("null_records"))
    return aggs + [F.count(F.col(c)).alias(f"nonnull_{c}") for c in present]


def gate_counts(df: DataFrame, required=REQUIRED_ENVELOPE_KEYS) -> DataFrame:
    """One aggregate row with everything the gates need (a single pass)."""
    return df.agg(*gate_aggregates(df, required))


def envelope_keys(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Top-level keys really present in the raw JSON documents under ``path``.

    With a fixed read schema every column exists, so B2 must look at the text:
    one document per file (``multi_line``) or one per line (JSON Lines).
    """
    raw = (spark.read.option("wholetext", multi_line).option("recursiveFileLookup", True)
           .text(path))
    return (raw.select(F.explode(F.json_object_keys(F.col("value"))).alias("key"))
            .distinct())


def check_bronze(df: DataFrame, raw_path: str | list[str] | None = None,
                 required=REQUIRED_ENVELOPE_KEYS, multi_line: bool = False) -> dict:
    """Run B1 (rows), B2 (required keys), B3 (NULL records) in order.

    One aggregate answers all three. Only when a required column is entirely
    NULL (absent in every document, or explicitly null) and ``raw_path`` is
    given are the raw keys read to tell the two apart. Returns the counts.
    """
    row = gate_counts(df, required).first().asDict()
    return judge_bronze(row, df, raw_path, required, multi_line)


def judge_bronze(row: dict, df: DataFrame, raw_path: str | list[str] | None = None,
                 required=REQUIRED_ENVELOPE_KEYS, multi_line: bool = False) -> dict:
    """The gates over counts that are there, such as those observed on a build's scan."""
    if row["rows"] == 0:
        log.error("Bronze dataset is empty")
        raise BronzeCheckError(EMPTY_MESSAGE)
    missing = [c for c in required if c not in df.columns]
    suspects = [c for c in required if c in df.columns and row[f"nonnull_{c}"] == 0]
    if suspects and raw_path is not None:
        spark = df.sparkSession
        present = {r["key"] for r in envelope_keys(spark, raw_path, multi_line)
                   .where(F.col("key").isin(suspects)).collect()}
        missing += [c for c in suspects if c not in present]
    if missing:
        log.error("Missing required columns: %s", missing)
        raise BronzeCheckError(SCHEMA_MESSAGE)
    if row["null_records"] > 0:
        log.error("Found %d rows with NULL records", row["null_records"])
        raise BronzeCheckError(CORRUPT_MESSAGE)
    log.info("Bronze checks passed | rows=%d", row["rows"])
    return row


def explode_records(df: DataFrame) -> DataFrame:
    """One row per record as column ``job``; NULL or empty arrays give none.

    The envelope's ``source``, ``batch_id`` and ``ingested_at`` are kept so that
    deduplication can prefer the latest copy of a job.
    """
    keep = [c for c in ["source"] + LINEAGE_COLUMNS if c in df.columns]
    return df.select(*keep, F.explode(F.col("records")).alias("job"))
