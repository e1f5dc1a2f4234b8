"""Streaming tick fold and the other ``foreachBatch`` operators.

A per-key stateful operator cannot read a neighbour's key, and keying by
the whole grid would put everything in one task, so the fold state lives in
the tick-partitioned state table instead:

1. the stream emits closed ``(tick, i, j, f)`` rows once (watermark, append);
2. each micro-batch stages them (one pass, written by tick block);
3. it reads the newest stored state strictly before the first closed tick
   (or a zero grid), advances up to the last closed tick (ticks with no
   readings are steps with source 0) and merges those ticks into their
   blocks of the state table.

Progress is Spark's checkpoint alone: which rows an epoch holds, and whether
it was committed.  The table keeps no record beside its ticks.  A replayed
epoch holds the same closed ticks, starts from the newest whole tick before
the first of them and rewrites the same blocks; if it had ended half-way, the
whole ticks it left before its first closed tick are steps with source 0 from
a committed state, hence right, and those behind it are written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import FoldSpec, GridSpec
from gridcast.operators.densify import densify_state
from gridcast.operators.halo import halo_rows
from gridcast.plans.fold import advance, reject_outside, stage_sources
from gridcast.sources.store import (
    Layout,
    ensure_layout,
    latest_tick_before,
    read_tick,
    read_ticks,
    to_results,
    upsert_by_key,
    upsert_results,
    write_tick,
)


# Ticks per stored block of a streaming state table: micro-batches rewrite
# their current block, so it is small.
STREAM_BLOCK_TICKS = 16


def fold_batch_fn(
    spark: SparkSession,
    grid: GridSpec,
    spec: FoldSpec,
    tick_ms: int,
    state_path: str,
    stage_root: str,
    method: str = "auto",
    tile: tuple[int, int] | None = None,
    steps_per_round: int | None = None,
    results_path: str | None = None,
    anchor: str = "node",
    rejects: str | None = None,
):
    """The ``foreachBatch`` body of the streaming fold.

    Rows outside the grid fail the batch, or go to the table ``rejects``.

    With ``results_path`` the newly computed ticks are also upserted into
    the results table ``(tick_index, x, y, temp)`` (tee of the state).
    """

    def fn(batch: DataFrame, epoch_id: int) -> None:
        staged = stage_sources(spark, batch, grid, tick_ms, f"{stage_root}/epoch={epoch_id}")
        try:
            reject_outside(staged, grid, rejects)
            if staged.first is None:
                return
            first, last = staged.first, staged.last
            prev = latest_tick_before(spark, state_path, first, tick_ms, grid.n_cells)
            if prev is None:
                prev = first - tick_ms
                ensure_layout(spark, state_path, Layout(first, tick_ms, STREAM_BLOCK_TICKS))
                write_tick(densify_state(spark, None, grid), state_path, prev, sole=True)  # new table
            state = read_tick(spark, state_path, prev)
            advance(spark, state, prev, last, staged.read, grid, spec, tick_ms, state_path, method, tile, steps_per_round)
        finally:
            staged.drop()
        if results_path is not None:
            new = read_ticks(spark, state_path, prev + tick_ms, last)
            upsert_results(spark, to_results(new, grid, tick_ms, anchor), results_path, ("temp",), STREAM_BLOCK_TICKS)

    return fn


def tee_batch_fn(out_path: str, halo_path: str, nx: int, n_stripes: int, tick_ms: int):
    """Write each closed batch, then derive and write its halo rows (tee)
    from the written copy.  Each batch is a folder of its own and replaces
    it, so a replay is harmless."""

    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("tick", "i", "j", "f")
        rows.sortWithinPartitions("tick", "i", "j").write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")
        written = spark.read.schema(rows.schema).parquet(f"{out_path}/epoch={epoch_id}")
        halo_rows(written, nx, n_stripes, tick_ms).write.mode("overwrite").parquet(f"{halo_path}/epoch={epoch_id}")

    return fn


def poll_batch_fn(out_path: str, tick_ms: int):
    """Records per poll: per micro-batch and tick, how many readings came."""
    from gridcast.functions.ticks import tick_snap

    def fn(batch: DataFrame, epoch_id: int) -> None:
        (
            batch.groupBy(tick_snap("time", tick_ms).alias("tick"))
            .agg(F.count(F.lit(1)).alias("n_readings"))
            .withColumn("epoch", F.lit(epoch_id).cast("long"))
            .write.mode("overwrite")
            .parquet(f"{out_path}/epoch={epoch_id}")
        )

    return fn


def keyed_batch_fn(out_path: str, key: tuple[str, ...], block, values: tuple[str, ...], version: tuple[str, ...]):
    """Update-mode result of a keyed aggregate: each batch carries only the
    keys that changed; they are upserted into a table partitioned by the
    column expression ``block`` (named ``block``), so a batch rewrites only
    the blocks it touched and the newest groups are there without waiting
    for the watermark."""

    def fn(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.withColumn("block", block.cast("long"))
        upsert_by_key(batch.sparkSession, rows, out_path, ("block", *key), "block", values, version)

    return fn


def latest_batch_fn(out_path: str, block: int = 64):
    """The latest reading per cell, in blocks of columns."""
    return keyed_batch_fn(out_path, ("i", "j"), F.call_function("div", F.col("i"), F.lit(block)), ("time", "gen"), ("time",))


def stream_tick_fold(
    spark: SparkSession,
    readings: DataFrame,
    grid: GridSpec,
    spec: FoldSpec,
    tick_ms: int,
    delay_ms: int,
    state_path: str,
    checkpoint: str,
    dup: str = "last",
    trigger: str | None = None,
    results_path: str | None = None,
    method: str = "auto",
    rejects: str | None = None,
):
    """Start the streaming tick fold over a READINGS stream.

    Closed ticks (watermark ``delay_ms`` behind the newest tick) are folded
    into ``state_path`` micro-batch by micro-batch; ``trigger`` is a
    processing-time interval such as ``"200 milliseconds"`` or None for
    ``availableNow``.  Returns the running :class:`StreamingQuery`.
    """
    from gridcast.config import scratch_path
    from gridcast.streaming.sinks import to_batches
    from gridcast.streaming.windows import closed_ticks

    closed = closed_ticks(readings, tick_ms, delay_ms, dup)
    fn = fold_batch_fn(
        spark, grid, spec, tick_ms, state_path, scratch_path(spark, "stream-fold-stage"),
        method=method, results_path=results_path, rejects=rejects,
    )
    return to_batches(closed, fn, checkpoint, trigger=trigger)
