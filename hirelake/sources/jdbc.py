"""Serving database through Spark JDBC.

Note: no database is started by this repository or its tests; these functions
are plain Spark JDBC calls and are exercised only against a database the user
provides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.sources.lake import GOLD_TABLES, read_gold


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, batch_size: int = 10000,
               num_partitions: int | None = None, truncate: bool = True) -> None:
    """Append (default, as the reference) or overwrite a table.

    ``numPartitions`` caps concurrent connections; with ``truncate`` an
    overwrite keeps the table definition.
    """
    writer = (df.write.format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", batch_size).option("truncate", str(truncate).lower()))
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None) -> DataFrame:
    """Read a table; with a partition column the read is split into ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions or 8))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def load_serving(spark: SparkSession, gold_root: str, dt: str | None, url: str,
                 properties: dict | None = None, mode: str = "append") -> dict:
    """Copy the Gold tables of a day (or all days) into the serving database.

    ``mode="append"`` is the reference's behaviour (a rerun duplicates rows);
    ``mode="refresh"`` overwrites each table from all Gold partitions: a run that
    finishes leaves the same rows however often it is repeated (a table is empty or
    partly filled while it is reloaded). Any other mode is an error. Row counts come from the written frames' observed metrics.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    if mode not in ("append", "refresh"):
        raise ValueError(f"unknown mode {mode}; known: append, refresh")
    counts = {}
    for table in GOLD_TABLES:
        df = read_gold(spark, gold_root, table, None if mode == "refresh" else dt)
        obs = Observation(f"serving_{table}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        write_jdbc(df, url, table, mode="overwrite" if mode == "refresh" else "append",
                   properties=properties)
        counts[table] = obs.get["rows"]
    return counts
