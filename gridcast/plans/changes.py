"""A history stored as keyframes and changes, and its replay.

Ticks are cut into segments of ``key_every``.  The first tick of a segment is
a keyframe with every cell; after it a cell is stored only where its value
differs from the tick before.  Every row carries the interval of ticks for
which it holds, ``[tick, until)``, so the state at a tick, or the frames of a
range, come from a filter and an ``explode`` of clipped intervals: no join, no
window and no shuffle (but for the order of playback).

A cell's rows of one segment are the unit of the single shuffle that builds
the table, at most ``key_every`` of them, however long the history is.  The
table is partitioned by segment; a replay reads the segments it overlaps.

The history must hold every cell at every tick, as a fold writes it.  A null
value is a value like others; ``-0.0`` and ``0.0`` are equal.  An empty
history gives an empty table; repeated rows of a cell and tick count once if
they are equal, else one of them is kept.  The replay is exact: values are never rounded,
so a dense field that moves at every tick is stored whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.config import GridSpec
from gridcast.plans.serve import present

CHANGES_DDL = "tick long, until long, i int, j int, u double, segment long"
FRAME_DDL = "tick long, i int, j int, u double"


def changes(history: DataFrame, tick_ms: int, key_every: int, origin: int = 0) -> DataFrame:
    """Keyframes and changes of ``(tick, i, j, u)`` rows, with the ticks for
    which each row holds and its segment (counted from ``origin``)."""
    if key_every < 1:
        raise ValueError("key_every must be at least 1")
    span = key_every * tick_ms
    rows = history.select("tick", "i", "j", "u", F.floor((F.col("tick") - F.lit(origin)) / F.lit(span)).cast("long").alias("segment"))
    cell = Window.partitionBy("segment", "i", "j")
    by_tick = cell.orderBy("tick")
    marked = rows.select(
        "*",
        F.row_number().over(by_tick).alias("nth"),
        F.lag("u").over(by_tick).alias("before"),
        (F.max("tick").over(cell) + F.lit(tick_ms)).alias("end"),
    )
    kept = marked.where((F.col("nth") == 1) | ~F.col("u").eqNullSafe(F.col("before")))
    until = F.coalesce(F.lead("tick").over(by_tick), F.col("end"))
    return kept.select("tick", until.alias("until"), "i", "j", "u", "segment").where("until > tick")


def write_changes(history: DataFrame, path: str, tick_ms: int, key_every: int, origin: int = 0) -> None:
    """Write the table; segments that ``history`` holds are replaced, so a
    segment must come whole."""
    (
        changes(history, tick_ms, key_every, origin)
        .sortWithinPartitions("segment", "tick", "i", "j")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("segment")
        .parquet(path)
    )


def read_changes(spark: SparkSession, path: str, first: int, last: int, tick_ms: int, key_every: int, origin: int = 0) -> DataFrame:
    """Stored rows that hold at some tick of ``first..last``."""
    span = key_every * tick_ms
    segments = F.col("segment").between(F.lit((first - origin) // span), F.lit((last - origin) // span))
    rows = spark.read.schema(CHANGES_DDL).parquet(path).where(segments)
    return rows.where((F.col("tick") <= F.lit(last)) & (F.col("until") > F.lit(first)))


def frames(spark: SparkSession, path: str, first: int, last: int, tick_ms: int, key_every: int, origin: int = 0) -> DataFrame:
    """``(tick, i, j, u)`` of every cell at the ticks ``first..last``; both
    must be ticks of the table's raster."""
    rows = read_changes(spark, path, first, last, tick_ms, key_every, origin)
    lo = F.greatest("tick", F.lit(first).cast("long"))
    hi = F.least(F.col("until") - F.lit(tick_ms), F.lit(last).cast("long"))
    shown = F.sequence(lo, hi, F.lit(tick_ms).cast("long"))
    return rows.select(F.explode(shown).alias("tick"), "i", "j", "u")


def replay_changes(
    spark: SparkSession, path: str, first: int, last: int, grid: GridSpec, tick_ms: int, key_every: int, origin: int = 0, anchor: str = "node"
) -> DataFrame:
    """Ticks ``first..last`` in playback order, as ``serve.replay`` shows them."""
    return present(frames(spark, path, first, last, tick_ms, key_every, origin), grid, anchor).orderBy("tick", "i", "j")
