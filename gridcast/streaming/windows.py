"""Event-time operators on reading streams: closed ticks, windows, dedup.

Every aggregate keys on a watermarked event-time column, so append mode
emits each (key, window) exactly once, after the watermark has passed it;
Spark's state store holds the open groups, partitioned by key.  A row whose
window ended before the watermark of the *previous* micro-batch is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.operators.align import _dup_agg, window_mean
from gridcast.streaming.source import delay, with_event_time


def closed_ticks(
    readings: DataFrame, tick_ms: int, delay_ms: int, dup: str = "last", keep_ts: bool = False
) -> DataFrame:
    """Aligned ``(tick, i, j, f)`` rows, emitted once per tick when it closes.

    The tick timestamp is the event-time column; the watermark trails the
    largest tick seen by ``delay_ms``.  ``keep_ts`` keeps ``tick_ts`` so a
    later stateful operator (a stream-stream join) inherits the watermark.
    """
    out = (
        with_event_time(readings, tick_ms)
        .withWatermark("tick_ts", delay(delay_ms))
        .groupBy("tick_ts", "tick", "i", "j")
        .agg(_dup_agg(dup).alias("f"))
    )
    return out.select("tick_ts", "tick", "i", "j", "f") if keep_ts else out.select("tick", "i", "j", "f")


def window_mean_stream(
    readings: DataFrame,
    window_ms: int,
    delay_ms: int,
    slide_ms: int | None = None,
    scale: float = 1.0,
) -> DataFrame:
    """Windowed mean per cell on a stream (tumbling or hopping).  Append mode
    gives closed windows once; update mode gives every window as it grows."""
    return window_mean(with_event_time(readings, window_ms).withWatermark("event_time", delay(delay_ms)), window_ms, slide_ms, scale, F.col("event_time"))


def ticks_stream(readings: DataFrame, tick_ms: int, delay_ms: int, dup: str = "last") -> DataFrame:
    """Dedup on a stream: one row per (tick, i, j) as it stands (update
    mode); the reading that survives is the one ``dup`` names."""
    return closed_ticks(readings, tick_ms, delay_ms, dup)
