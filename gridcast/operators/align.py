"""Tick alignment and per-key aggregates of readings.

All aggregates here are declarative Spark aggregates, so the planner runs
them as partial (map-side) + final hash aggregation: a key that holds a
third of all readings is reduced inside every map task before the shuffle
and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.config import DUP_POLICIES, GridSpec
from gridcast.functions.grid import in_domain
from gridcast.functions.ticks import event_time, tick_snap


def with_tick(readings: DataFrame, tick_ms: int) -> DataFrame:
    """Add the snapped tick (halves down) next to the raw time."""
    return readings.withColumn("tick", tick_snap("time", tick_ms))


def _dup_agg(policy: str, value: str = "gen"):
    if policy == "last":
        # latest reading wins; (time, seq), then the value, order equal times
        return F.max_by(F.col(value), F.struct(F.col("time"), F.col("seq"), F.col(value)))
    if policy == "avg":
        return F.avg(F.col(value))
    if policy == "sum":
        return F.sum(F.col(value))
    raise ValueError(f"dup must be one of {DUP_POLICIES}")


def align(readings: DataFrame, tick_ms: int, dup: str = "last") -> DataFrame:
    """READINGS -> ALIGNED: one value ``f`` per (tick, i, j).

    ``dup`` resolves several readings of one cell in one tick: ``last``
    (latest by time then seq), ``avg`` or ``sum``.
    """
    return (
        with_tick(readings, tick_ms)
        .groupBy("tick", "i", "j")
        .agg(_dup_agg(dup).alias("f"))
    )


def latest_per_cell(readings: DataFrame) -> DataFrame:
    """Upsert view of a reading log: the latest reading of each cell."""
    return readings.groupBy("i", "j").agg(
        F.max(F.struct("time", "seq", "gen")).alias("r")
    ).select("i", "j", F.col("r.time").alias("time"), F.col("r.gen").alias("gen"))


def readings_per_tick(readings: DataFrame, tick_ms: int) -> DataFrame:
    """How many readings arrived for each tick (records per poll)."""
    return with_tick(readings, tick_ms).groupBy("tick").agg(F.count(F.lit(1)).alias("n_readings"))


def window_mean(
    readings: DataFrame,
    window_ms: int,
    slide_ms: int | None = None,
    scale: float = 1.0,
    at=None,
) -> DataFrame:
    """Windowed mean per cell: ``scale * sum / count`` stamped with window end.

    Tumbling when ``slide_ms`` is None, hopping otherwise.  Windows are
    left-closed ``[start, end)`` on the event time.  Output ``time`` is the
    window end in ms.  ``at`` is the event-time column of a stream.
    """
    w = f"{window_ms} milliseconds"
    at = event_time("time") if at is None else at
    win = F.window(at, w) if slide_ms is None else F.window(at, w, f"{slide_ms} milliseconds")
    return (
        readings.groupBy(win.alias("w"), "i", "j")
        .agg(F.sum("gen").alias("s"), F.count(F.lit(1)).alias("n"))
        .select(
            F.unix_millis(F.col("w.end")).alias("time"),
            "i",
            "j",
            (F.lit(scale) * F.col("s") / F.col("n")).alias("f"),
            F.col("n").alias("n_readings"),
        )
    )


def align_windows(readings: DataFrame, window_ms: int, slide_ms: int | None = None, scale: float = 1.0, at=None) -> DataFrame:
    """READINGS -> ALIGNED by windowed means: the source of a tick is the mean
    of the window that ends there, so ticks are ``slide_ms`` (or
    ``window_ms``) apart.  Works on a stream with its event time ``at``."""
    return window_mean(readings, window_ms, slide_ms, scale, at).select(F.col("time").alias("tick"), "i", "j", "f")


def split_by_grid(readings: DataFrame, grid: GridSpec) -> tuple[DataFrame, DataFrame]:
    """Readings of the grid's cells, and the rejected rest."""
    inside = F.coalesce(in_domain("i", "j", grid), F.lit(False))
    return readings.where(inside), readings.where(~inside)
