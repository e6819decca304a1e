"""Incremental form of the pipeline: new Bronze files are merged into their days.

A file stream per source watches the Bronze landing; the stream checkpoint (in
the shared checkpoint folder) records which batch documents were seen, so each
is taken exactly once and a lost executor or a restarted job resumes where it
stopped. Each micro-batch names its new files; these alone are read, gated and
normalised, and merged into the Silver buckets that hold their jobs
(``lake.merge_silver``). Of each job the latest copy stays whatever the order of
arrival, so the day is the same as after one batch run over all its files, and a
micro-batch that is repeated after a crash changes nothing. Gold's aggregates are put
together from states of Silver buckets, of which those that changed are built anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.time import to_date_path
from hirelake.operators.bronze import check_bronze, explode_records
from hirelake.plans.pipeline import merge_batch, run_gold
from hirelake.sources.lake import bronze_path, read_bronze
from hirelake.sources.registry import source_spec

FILES = 10_000    # new files of a source in one micro-batch, the most listed at a time

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _day_stream(spark: SparkSession, bronze_root: str, source: str, files: int) -> DataFrame:
    """Streaming frame of (source, path, dt) for every new Bronze file.

    Only the file path is needed: one row a file, whose content is not read; the
    day is taken from the ``dt=`` folder of the path.
    """
    source_spec(source)  # unknown sources fail here
    raw = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
           .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files)
           .load(bronze_path(bronze_root, source)))
    return raw.select(
        F.lit(source).alias("source"), "path",
        F.regexp_extract("path", r"dt=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1).alias("dt"))


def incremental_pipeline(spark: SparkSession, sources: list[str], bronze_root: str,
                         silver_root: str, gold_root: str, checkpoint_root: str,
                         multi_line: bool = False, exact_median: bool = True,
                         files: int = FILES, **silver_options) -> list[str]:
    """Process all Bronze documents not seen before; return the days that they changed.

    Runs with ``availableNow`` (take what is there, then stop): schedule it as
    often as new batches land. At most ``files`` of a source are taken in one
    micro-batch; more are taken in the next.
    """
    changed: list[str] = []

    def merge(batch: DataFrame, epoch_id: int) -> None:
        found: dict[str, dict[str, list[str]]] = {}
        for r in batch.where(F.col("dt") != "").collect():     # names of files, not content
            found.setdefault(r["dt"], {}).setdefault(r["source"], []).append(r["path"])
        for dt in sorted(found):
            frames = []
            for source in (s for s in sources if s in found[dt]):
                df = read_bronze(spark, bronze_root, source, dt, multi_line, files=found[dt][source])
                check_bronze(df, raw_path=found[dt][source], multi_line=multi_line)
                frames.append(source_spec(source).normalizer(explode_records(df), to_date_path(dt)))
            merge_batch(spark, frames, dt, silver_root, **silver_options)
            run_gold(spark, dt, silver_root, gold_root, exact_median, keep_states=True)
            changed.extend([dt] if dt not in changed else [])

    streams = [_day_stream(spark, bronze_root, s, files) for s in sources]
    days = streams[0]
    for other in streams[1:]:
        days = days.unionByName(other)
    query = (days.writeStream.foreachBatch(merge)
             .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/incremental")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return changed
