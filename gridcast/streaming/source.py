"""Streaming sources of readings.

Files stand in for the message log: ``readStream`` over a folder with a
fixed schema (never inferred).  With a fresh checkpoint folder the stream
replays the folder from the beginning; ``format("kafka")`` takes the same
call shape where the connector is on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import GridSpec, TEST_GRID
from gridcast.functions.ticks import event_time, tick_snap, tick_ts
from gridcast.schemas import READINGS
from gridcast.sources.readings import readings_from_events, table_path


def stream_events(spark: SparkSession, sf_dir: str, grid: GridSpec = TEST_GRID, max_files: int | None = None) -> DataFrame:
    """The ``events`` table of a test-data folder as a stream of READINGS."""
    schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return readings_from_events(reader.parquet(sf_dir.rstrip("/")), grid)


def stream_readings(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A folder of READINGS files (Parquet or JSON lines) as a stream."""
    reader = spark.readStream.schema(READINGS).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_log_readings(spark: SparkSession, fmt: str = "text", path: str | None = None, **options) -> DataFrame:
    """READINGS from a log of JSON records.

    ``fmt="text"`` reads a folder of JSON lines; ``fmt="kafka"`` (with e.g.
    ``subscribe=..., startingOffsets="earliest"``) reads a topic whose value
    is the JSON record.  Either way the JSON text is parsed with a fixed
    schema (``timestamp`` as a double, documented field names accepted).
    """
    from gridcast.sources.readings import parse_json_readings

    reader = spark.readStream.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path is not None else reader.load()
    return parse_json_readings(raw.select(F.col("value").cast("string").alias("value")))


def with_event_time(readings: DataFrame, tick_ms: int) -> DataFrame:
    """Add ``tick`` (snapped, halves down), ``event_time`` and ``tick_ts``."""
    return readings.select(
        "*",
        tick_snap("time", tick_ms).alias("tick"),
        event_time("time").alias("event_time"),
    ).withColumn("tick_ts", tick_ts("tick"))


def delay(ms: int) -> str:
    return f"{int(ms)} milliseconds"


__all__ = ["delay", "stream_events", "stream_log_readings", "stream_readings", "with_event_time"]
