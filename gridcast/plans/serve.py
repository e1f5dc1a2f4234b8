"""Serving stored states: snapshots and replays with coordinates and colours.

``snapshot_table`` / ``replay_table`` read only the store blocks that hold
the requested ticks; ``snapshot`` / ``replay`` work on any state DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.config import GridSpec
from gridcast.functions.colour import palette_bucket, red_scale
from gridcast.functions.grid import coord_x, coord_y


def present(
    states: DataFrame, grid: GridSpec, anchor: str = "node", levels: int = 1024, extra: tuple[str, ...] = ()
) -> DataFrame:
    """``(tick, i, j, u)`` -> SNAPSHOT rows plus the marker radius (= value);
    ``extra`` columns are carried through."""
    return states.select(
        *extra,
        F.col("tick"),
        F.col("i"),
        F.col("j"),
        coord_x("i", grid, anchor).alias("x"),
        coord_y("j", grid, anchor).alias("y"),
        F.col("u").alias("temp"),
        red_scale("u").alias("colour"),
        palette_bucket("u", levels).alias("bucket"),
        F.col("u").alias("radius"),
    )


def snapshot(states: DataFrame, tick: int, grid: GridSpec, anchor: str = "node") -> DataFrame:
    """One tick of the store, presented."""
    return present(states.where(F.col("tick") == F.lit(tick)), grid, anchor)


def replay(states: DataFrame, first: int, last: int, grid: GridSpec, anchor: str = "node") -> DataFrame:
    """Ticks ``first..last`` in playback order (tick, then cell)."""
    sel = states.where((F.col("tick") >= F.lit(first)) & (F.col("tick") <= F.lit(last)))
    return present(sel, grid, anchor).orderBy("tick", "i", "j")


def wrap_step(step: Column | str, n_ticks: int) -> Column:
    """Playback position that loops back to 0 after the last stored tick."""
    s = F.col(step) if isinstance(step, str) else step
    return F.pmod(s, F.lit(n_ticks))


def replay_loop(
    spark,
    path: str,
    first_stored: int,
    n_stored: int,
    tick_ms: int,
    start: int,
    n_frames: int,
    grid: GridSpec,
    anchor: str = "node",
) -> DataFrame:
    """A looping player: frame ``f`` shows stored tick number
    ``pmod(start + f, n_stored)``, so playback wraps to the first tick after
    the last one.  At most two runs of ticks are shown (one more per full
    loop shows the whole table), and only their blocks are read; the frame
    list is a generated range of ``n_frames`` rows joined on ``tick``."""
    from gridcast.sources.store import read_ticks

    frames = spark.range(n_frames).select(
        F.col("id").alias("frame"),
        (F.lit(first_stored) + wrap_step(F.col("id") + F.lit(start), n_stored) * F.lit(tick_ms))
        .cast("long")
        .alias("tick"),
    )
    lo = start % n_stored
    shown = min(n_frames, n_stored)
    runs = [(lo, min(lo + shown, n_stored) - 1)] + ([(0, lo + shown - n_stored - 1)] if lo + shown > n_stored else [])
    states = None
    for a, b in runs:
        part = read_ticks(spark, path, first_stored + a * tick_ms, first_stored + b * tick_ms)
        states = part if states is None else states.unionByName(part)
    return present(states.join(frames, "tick"), grid, anchor, extra=("frame",)).orderBy("frame", "i", "j")


def snapshot_table(spark, path: str, tick: int, grid: GridSpec, anchor: str = "node") -> DataFrame:
    """Snapshot straight from a state table: only the block holding ``tick``
    is read."""
    from gridcast.sources.store import read_ticks

    return present(read_ticks(spark, path, tick, tick), grid, anchor)


def replay_table(spark, path: str, first: int, last: int, grid: GridSpec, anchor: str = "node") -> DataFrame:
    """Replay of ticks ``first..last`` reading only their blocks."""
    from gridcast.sources.store import read_ticks

    return present(read_ticks(spark, path, first, last), grid, anchor).orderBy("tick", "i", "j")
