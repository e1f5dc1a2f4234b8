"""Time on the grid: ticks are plain epoch milliseconds (bigint)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(c, d) -> Column:
    """SQL integral division (``a div b``, truncating toward zero)."""
    return F.call_function("div", _col(c), d if isinstance(d, Column) else F.lit(d))


def tick_snap(time, tick_ms: int) -> Column:
    """Snap a millisecond time to the nearest tick; exact halves go down.

    ``ceil(t/T - 0.5) * T``: with T = 100, 150 -> 100 and 151 -> 200.
    Never ``round()``, which sends halves up.
    """
    t = _col(time)
    return (F.ceil(t / F.lit(float(tick_ms)) - F.lit(0.5)) * F.lit(tick_ms)).cast("long")


def tick_index(time, tick_ms: int) -> Column:
    """Integer tick number ``time div T`` (how the results table is keyed)."""
    return int_div(_col(time).cast("long"), F.lit(tick_ms).cast("long"))


def event_time(time) -> Column:
    """Event-time timestamp of a millisecond time, for watermarks/windows."""
    return F.timestamp_millis(_col(time))


def tick_ts(tick) -> Column:
    """Timestamp of a tick (same value as ``event_time``, named for intent)."""
    return F.timestamp_millis(_col(tick))
