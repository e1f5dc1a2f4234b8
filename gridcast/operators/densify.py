"""Densify: give every cell of every tick a row (absent means 0)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import GridSpec
from gridcast.functions.grid import missing_as_zero
from gridcast.functions.ticks import tick_snap
from gridcast.sources.readings import grid_scaffold


def tick_bounds(aligned: DataFrame, tick_col: str = "tick") -> tuple[int, int] | None:
    """(first, last) tick of a table: one tiny aggregate, two numbers back."""
    row = aligned.agg(F.min(tick_col).alias("a"), F.max(tick_col).alias("b")).first()
    if row is None or row["a"] is None:
        return None
    return int(row["a"]), int(row["b"])


def reading_bounds(readings: DataFrame, tick_ms: int) -> tuple[int, int] | None:
    """(first, last) tick of raw readings: snapping keeps the order, so the
    least and greatest times decide (one column, no shuffle of rows)."""
    row = readings.agg(tick_snap(F.min("time"), tick_ms).alias("a"), tick_snap(F.max("time"), tick_ms).alias("b")).first()
    return None if row["a"] is None else (int(row["a"]), int(row["b"]))


def dense_ticks(
    spark: SparkSession, grid: GridSpec, first_tick: int, last_tick: int, tick_ms: int
) -> DataFrame:
    """All (tick, i, j) for a regular tick sequence, generated on executors.

    One ``range`` over ``n_ticks * n_cells`` ids decoded by arithmetic, so
    there is neither a driver-side list nor a cross join; partitions grow
    with the row count.
    """
    n_ticks = (last_tick - first_tick) // tick_ms + 1
    n = n_ticks * grid.n_cells
    parts = n // 2_000_000 + 1
    cells = F.lit(grid.n_cells)
    cell = F.col("id") % cells
    return spark.range(0, n, 1, parts).select(
        (F.lit(first_tick) + F.call_function("div", F.col("id"), cells) * F.lit(tick_ms))
        .cast("long")
        .alias("tick"),
        F.call_function("div", cell, F.lit(grid.ny)).cast("int").alias("i"),
        (cell % F.lit(grid.ny)).cast("int").alias("j"),
    )


def densify_state(spark: SparkSession, state: DataFrame | None, grid: GridSpec) -> DataFrame:
    """A full-grid (i, j, u) from a possibly partial state; missing cells are 0."""
    scaffold = grid_scaffold(spark, grid)
    if state is None:
        return scaffold.withColumn("u", F.lit(0.0))
    return scaffold.join(state.select("i", "j", "u"), ["i", "j"], "left").select(
        "i", "j", missing_as_zero("u").alias("u")
    )


def densify(
    spark: SparkSession,
    aligned: DataFrame,
    grid: GridSpec,
    tick_ms: int,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """ALIGNED -> dense (tick, i, j, f) over the regular tick range.

    The dense frame and the aligned rows are both keyed by (tick, i, j);
    the left equi-join shuffles each side once.
    """
    bounds = bounds or tick_bounds(aligned)
    if bounds is None:
        return aligned.limit(0)
    dense = dense_ticks(spark, grid, bounds[0], bounds[1], tick_ms)
    return dense.join(aligned.select("tick", "i", "j", "f"), ["tick", "i", "j"], "left").select(
        "tick", "i", "j", missing_as_zero("f").alias("f")
    )
