"""S3 over several runs: an unfilled batch is carried over to the next run.

    <root>/source=<name>/dt=.../run=<id>/bucket=batches/   JSON Lines, whole batches of a run
    <root>/source=<name>/dt=.../run=<id>/bucket=rest/      the records that filled no batch
    <root>/source=<name>/_log/...                          which of these folders count

``land`` puts the rest of the run before in front of the new records, cuts batches of
exactly ``batch_size`` and keeps what is left; batch numbers go on from run to run. One
entry of the source's log (``sources/versions.py``) makes a run's batches and its rest
valid together: a run that crashes leaves the old state, its folders are deleted later,
and a run that is repeated under the same ``token`` changes nothing. ``close`` lands the
rest as the last, shorter batch. The entry names one folder a run that filled a batch.

Within a run records follow ``order_by`` (unique); runs follow one another. Columns that
only some runs have are NULL in the records of a batch that mixes both. No records: the
state stays as it is but for the token.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirelake.functions.time import to_dt
from hirelake.operators.batches import DEFAULT_BATCH_SIZE, group_batches, with_positions
from hirelake.session import passing, released, split_at
from hirelake.sources import versions
from hirelake.sources.registry import source_spec

SPLIT = 16 << 20      # bytes of positioned records that a task reads at most
EVER = "1970-01-01"   # the log's label: a source's state belongs to no day of its own


def landing_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/source={source}"


def _rest(spark: SparkSession, path: str, entry: versions.Entry | None) -> DataFrame | None:
    """The records carried over, numbered in ``_at``; None if there are none."""
    if entry is None or "rest" not in entry.paths:
        return None
    return spark.read.schema(StructType.fromJson(json.loads(entry.schema))).parquet(
        f"{path}/{entry.paths['rest']}")


def land(records: DataFrame, root: str, source: str, dt: str, token: str, order_by: list[str],
         batch_size: int = DEFAULT_BATCH_SIZE, ingested_at: str | None = None,
         close: bool = False) -> dict[str, int]:
    """Land a run's records; what it did: ``batches`` landed, ``carried`` records.

    ``token`` names the run: a token that the last entry already bears lands nothing.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    spark, path = records.sparkSession, landing_path(root, source)
    after = versions.current(spark, path, EVER)
    last = after.facts["run"] if after else {"token": None, "next": 0, "batches": 0, "carried": 0}
    if last["token"] == token:
        return {k: last[k] for k in ("batches", "carried")}

    keys = [f"_k{i}" for i in range(len(order_by))]
    rows = records.select(
        F.lit(1).alias("_run"), F.lit(0).cast("long").alias("_at"),
        *[F.col(c).alias(k) for c, k in zip(order_by, keys)],
        *[F.col(c).alias(f"r_{c}") for c in records.columns])
    rest = _rest(spark, path, after)
    if rest is not None:
        rows = rows.unionByName(rest.select(
            F.lit(0).alias("_run"), "_at",
            *[F.col("_rec")[c].alias(f"r_{c}") for c in rest.schema["_rec"].dataType.names]),
            allowMissingColumns=True)
    fields = [c for c in rows.columns if c.startswith("r_")]
    if not fields:      # nothing to close
        return {"batches": 0, "carried": 0}
    with passing(spark), split_at(spark, SPLIT), released(spark):
        placed = with_positions(
            rows.select("_run", "_at", *keys,
                        F.struct(*[F.col(c).alias(c[2:]) for c in fields]).alias("_rec")),
            ["_run", "_at", *keys])
        total = placed.count()
        n = -(-total // batch_size) if close else total // batch_size
        left = max(total - n * batch_size, 0)

        run, paths = versions.new_run(EVER), dict(after.paths) if after else {}
        paths.pop("rest", None)
        keep = placed.where(F.col("_pos") >= n * batch_size).select(
            (F.col("_pos") - n * batch_size).alias("_at"), "_rec")
        if n:
            group_batches(placed.where(F.col("_pos") < n * batch_size), source,
                          ingested_at or _dt.datetime.now(_dt.timezone.utc).isoformat(), batch_size,
                          last["next"]).drop("batch_no").write.json(f"{path}/{run}/bucket=batches")
            paths[f"{to_dt(dt)} {last['next']}"] = f"{run}/bucket=batches"
        if left:            # fewer than batch_size records
            keep.repartition(1).write.parquet(f"{path}/{run}/bucket=rest")
            paths["rest"] = f"{run}/bucket=rest"
        fact = {"token": token, "next": last["next"] + n, "batches": n, "carried": left}
        versions.publish(spark, path, EVER, after, keep.schema.json(), paths, facts={"run": fact})
        versions.expire(spark, path, EVER)
        return {"batches": n, "carried": left}


def close(spark: SparkSession, root: str, source: str, dt: str, token: str,
          batch_size: int = DEFAULT_BATCH_SIZE, ingested_at: str | None = None) -> dict[str, int]:
    """Land what is carried over as the last batch; nothing if there is none."""
    none = spark.createDataFrame([], "_none int").select()
    return land(none, root, source, dt, token, [], batch_size, ingested_at, close=True)


def landed_folders(spark: SparkSession, root: str, source: str, dt: str | None = None) -> list[str]:
    """The folders of a source's valid batches, of the runs of one day or of all."""
    path = landing_path(root, source)
    entry = versions.current(spark, path, EVER)
    return [f"{path}/{p}" for name, p in (entry.paths if entry else {}).items()
            if name != "rest" and (dt is None or name.split(" ")[0] == to_dt(dt))]


def read_landed(spark: SparkSession, root: str, source: str, dt: str | None = None,
                schema: StructType | None = None) -> DataFrame:
    """A source's landed batches with its envelope schema (or ``schema``)."""
    schema = schema or source_spec(source).envelope_schema
    folders = landed_folders(spark, root, source, dt)
    return spark.read.schema(schema).json(folders) if folders else spark.createDataFrame([], schema)
