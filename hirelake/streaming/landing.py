"""S3 as a stream: records that arrive are landed in whole batches, run after run."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hirelake.operators.batches import DEFAULT_BATCH_SIZE
from hirelake.sources import carry


def land_stream(records: DataFrame, root: str, source: str, dt: str, checkpoint_root: str,
                order_by: list[str], batch_size: int = DEFAULT_BATCH_SIZE) -> None:
    """Land what a streaming frame of records holds by now, then stop (``availableNow``).

    The stream's checkpoint says which records were taken, the source's log which
    micro-batch was landed last; its number is the run's token, so a micro-batch that is
    repeated after a crash is landed once. Later days of a source go on with the same
    ``checkpoint_root``.
    """
    def land(batch: DataFrame, epoch_id: int) -> None:
        carry.land(batch, root, source, dt, f"epoch {epoch_id}", order_by, batch_size)

    query = (records.writeStream.foreachBatch(land)
             .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/landing-{source}")
             .trigger(availableNow=True).start())
    query.awaitTermination()
