"""Hopping windows from panes: each reading is aggregated once.

A pane is as long as the greatest common divisor of window size and slide, so
every window is a whole number of panes.  Readings become one (sum, count)
row per pane and cell, by a partial aggregate; windows then slide over the
panes of a cell in order.  A reading is never copied to the ``size / slide``
windows that hold it, and what the second, small shuffle moves depends on the
time covered, not on the number of readings.

A window that holds any reading has exactly one last pane with readings: the
pane that emits it.  Sums are taken over the frame of panes anew (nothing is
subtracted), so a window's sum has no error from windows before it.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pane_sums(readings: DataFrame, pane_ms: int, keys: tuple[str, ...] = ("i", "j"), value: str = "gen") -> DataFrame:
    """``keys, pane, s, n``: sum and count of the readings of each pane,
    named by its start."""
    pane = (F.floor(F.col("time") / F.lit(pane_ms)) * F.lit(pane_ms)).cast("long")
    return readings.groupBy(*keys, pane.alias("pane")).agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"))


def hopping_mean(
    readings: DataFrame,
    window_ms: int,
    slide_ms: int,
    scale: float = 1.0,
    keys: tuple[str, ...] = ("i", "j"),
) -> DataFrame:
    """``time`` (window end), ``keys``, ``f`` (scale * mean), ``n_readings``
    of every window that holds a reading; windows start at multiples of the
    slide, as those of ``window_mean``."""
    if window_ms <= 0 or slide_ms <= 0 or slide_ms > window_ms:
        raise ValueError("0 < slide <= window")
    pane = gcd(window_ms, slide_ms)
    panes = pane_sums(readings, pane, keys).where("pane IS NOT NULL")
    ordered = Window.partitionBy(*keys).orderBy("at")
    nxt = F.lead("pane").over(Window.partitionBy(*keys).orderBy("pane"))
    # window ends that have this pane as their last one
    first = F.ceil((F.col("pane") + F.lit(pane - window_ms)) / F.lit(slide_ms)) * F.lit(slide_ms) + F.lit(window_ms)
    last = F.least(F.col("pane") + F.lit(window_ms), F.coalesce("next", F.col("pane") + F.lit(window_ms)))
    ends = F.when(first <= last, F.sequence(first, last, F.lit(slide_ms).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    none = F.lit(None)
    own = F.struct(F.col("pane").alias("at"), F.col("s"), F.col("n"), none.cast("long").alias("time"))
    # a window's frame ends at its last possible pane
    mark = lambda e: F.struct((e - F.lit(pane)).alias("at"), none.cast("double").alias("s"), none.cast("long").alias("n"), e.alias("time"))
    rows = panes.withColumn("next", nxt).select(*keys, F.explode(F.concat(F.array(own), F.transform(ends, mark))).alias("r")).select(*keys, "r.*")
    frame = ordered.rangeBetween(-(window_ms - pane), Window.currentRow)
    summed = rows.withColumn("ws", F.sum("s").over(frame)).withColumn("wn", F.sum("n").over(frame))
    return summed.where("time IS NOT NULL").select("time", *keys, (F.lit(float(scale)) * F.col("ws") / F.col("wn")).alias("f"), F.col("wn").alias("n_readings"))
