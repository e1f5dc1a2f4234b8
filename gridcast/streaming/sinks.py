"""Running streaming queries to files in the shared folder.

Every sink here is a file sink or a ``foreachBatch`` that writes whole
partitions, so a replayed micro-batch (after a restart from the checkpoint)
rewrites the same files: writes are idempotent.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    trigger: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append-mode file sink (exactly-once through the sink's commit log)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start(path)


def to_batches(
    df: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: str | None = None,
) -> StreamingQuery:
    """``foreachBatch`` sink; ``fn(batch_df, epoch_id)`` must be idempotent."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    return _trigger(w, trigger).start()


def run(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to drain its input; re-raise failures."""
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query


def drain(query: StreamingQuery) -> StreamingQuery:
    """Process everything available now, then stop (for processing-time
    triggers, which never finish on their own)."""
    query.processAllAvailable()
    query.stop()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query


def as_log_records(readings: DataFrame) -> DataFrame:
    """``(key, value)`` records of a reading log: the key is the packed cell
    ``(i << 32) + j`` as text, the value the JSON record.  This is the shape a
    Kafka sink takes; the ``text`` file sink writes the ``value`` column."""
    from gridcast.functions.grid import cell_key
    from gridcast.sources.readings import readings_to_json

    keyed = readings.withColumn("key", cell_key("i", "j").cast("string"))
    return readings_to_json(keyed, keep=("key",))
