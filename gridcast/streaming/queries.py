"""Streaming forms of the registered queries.

Each query streams the ``events`` file of a test-data folder through a
Structured Streaming plan with ``trigger(availableNow=True)``, writes to a
file sink (or ``foreachBatch``) under the session's shared checkpoint area,
waits for the input to drain, and returns the written result as a
DataFrame.  Windows and deduplicated ticks are written in update mode and
upserted, so the last ones are there; the folds and joins take only ticks
closed by the watermark, and their oracles apply the same rule
(``tick <= max(tick) - delay``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import TEST_GRID, TEST_TICK_MS, FoldSpec, scratch_path
from gridcast.functions.grid import is_left_stripe_edge, is_right_stripe_edge, stripe_of
from gridcast.functions.ticks import event_time
from gridcast.operators.align import align_windows, latest_per_cell, with_tick
from gridcast.operators.halo import halo_rows
from gridcast.sources.readings import load_readings
from gridcast.sources.store import read_states
from gridcast.streaming.blocks import BlockFold
from gridcast.streaming.fold import fold_batch_fn, keyed_batch_fn, latest_batch_fn, poll_batch_fn, stream_tick_fold, tee_batch_fn
from gridcast.streaming.joins import range_join_stream
from gridcast.streaming.late import LateFold
from gridcast.streaming.metrics import METRICS_DDL, PollListener, observed
from gridcast.streaming.sinks import run, to_batches, to_files
from gridcast.streaming.source import delay, stream_events, stream_readings, with_event_time
from gridcast.streaming.tables import merge_halo_stream, rocksdb
from gridcast.streaming.windows import closed_ticks, ticks_stream, window_mean_stream

GRID = TEST_GRID
NX, NY = GRID.nx, GRID.ny
T = TEST_TICK_MS
DAY = 86_400_000
DELAY = DAY
C = 0.1875
N_STRIPES = 5


def q6(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * F.lit(1e6) + F.lit(0.41421356)).cast("long")


def _files(spark: SparkSession, df: DataFrame, name: str, partition_by=()) -> str:
    out = scratch_path(spark, f"{name}-out")
    run(to_files(df, out, scratch_path(spark, f"{name}-ckpt"), partition_by))
    return out


def stream_tick_snap(spark, sf):
    s = with_event_time(stream_events(spark, sf, GRID), T).select("seq", "time", "tick")
    return spark.read.parquet(_files(spark, s, "tick-snap")).select("seq", "time", "tick")


def stream_latest(spark, sf):
    """Upsert view per cell: update mode, only changed cells are rewritten."""
    out = scratch_path(spark, "latest-out")
    run(to_batches(latest_per_cell(stream_events(spark, sf, GRID)), latest_batch_fn(out), scratch_path(spark, "latest-ckpt"), mode="update"))
    return spark.read.schema("i int, j int, time long, gen double, block long").parquet(out).select("i", "j", "time", "gen")


def _block(tick: str = "tick"):
    return F.floor(F.col(tick) / F.lit(16 * T))


def _window_query(size: int, slide: int | None, name: str):
    def fn(spark, sf):
        out = scratch_path(spark, f"{name}-out")
        w = window_mean_stream(stream_events(spark, sf, GRID), size, DELAY, slide, C)
        sink = keyed_batch_fn(out, ("time", "i", "j"), _block("time"), ("f", "n_readings"), ("n_readings",))
        run(to_batches(w, sink, scratch_path(spark, f"{name}-ckpt"), mode="update"))
        df = spark.read.schema("time long, i int, j int, f double, n_readings long, block long").parquet(out)
        return df.select("time", "i", "j", q6("f").alias("f_e6"), "n_readings")

    return fn


def stream_dedup(spark, sf):
    """One reading per (tick, cell), the latest, as the stream stands."""
    out = scratch_path(spark, "dedup-out")
    d = ticks_stream(stream_events(spark, sf, GRID), T, DELAY)
    sink = keyed_batch_fn(out, ("tick", "i", "j"), _block(), ("f",), ("f",))
    run(to_batches(d, sink, scratch_path(spark, "dedup-ckpt"), mode="update"))
    return spark.read.schema("tick long, i int, j int, f double, block long").parquet(out).select("tick", "i", "j", "f")


def stream_interval_join(spark, sf):
    """Full outer stream-stream join of closed readings with the halo rows
    of a second read of the stream, on (tick, i, j).

    Both sides are per-tick aggregates (at most one row per key), so the
    join never pairs up raw readings.  The equality on the watermarked
    ``tick_ts`` column bounds the join state; unmatched rows are emitted
    once the watermark passes them.
    """
    left = closed_ticks(stream_events(spark, sf, GRID), T, DELAY, "last", keep_ts=True)
    right = halo_stream(closed_ticks(stream_events(spark, sf, GRID), T, DELAY, "last", keep_ts=True))
    cond = (left.tick_ts == right.h_ts) & (left.i == right.h_i) & (left.j == right.h_j)
    j = left.join(right, cond, "full_outer").select(
        F.coalesce("tick", "h_tick").alias("tick"),
        F.coalesce("i", "h_i").alias("i"),
        F.coalesce("j", "h_j").alias("j"),
        "f",
        "val",
    )
    return spark.read.parquet(_files(spark, j, "interval-join")).select("tick", "i", "j", "f", "val")


def halo_stream(closed: DataFrame) -> DataFrame:
    """Halo rows of a closed-tick stream, keeping the event-time column
    (shifted by one tick) so the watermark carries over."""
    shift = F.expr(f"INTERVAL {T // 1000} SECONDS")
    sent = F.array(
        F.when(is_left_stripe_edge("i", NX, N_STRIPES), (F.col("i") - 1).cast("int")),
        F.when(is_right_stripe_edge("i", NX, N_STRIPES), (F.col("i") + 1).cast("int")),
    )
    return closed.select(
        (F.col("tick") + F.lit(T)).alias("h_tick"),
        (F.col("tick_ts") + shift).alias("h_ts"),
        F.explode(F.filter(sent, lambda i: i.isNotNull())).alias("h_i"),
        F.col("j").alias("h_j"),
        F.col("f").alias("val"),
    )


RANGE_BEFORE, RANGE_AFTER = 3 * 3_600_000, 3_600_000


def range_sides(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings, and the halo rows that the readings at stripe edges send to
    the next column a tick later, both with their own times."""
    sent = halo_rows(readings.withColumn("tick", F.col("time")), NX, N_STRIPES, T, "gen")
    return readings.select("i", "j", "time", "gen"), sent.select("i", "j", F.col("tick").alias("h_time"), "val")


def stream_range_join(spark, sf):
    """Full outer join of the readings with the halo rows of a second read of
    the stream whose time lies within three hours before and one after."""
    left, _ = range_sides(stream_events(spark, sf, GRID))
    _, right = range_sides(stream_events(spark, sf, GRID))
    left = left.withColumn("ts", event_time("time")).withWatermark("ts", delay(DELAY))
    right = right.withColumn("h_ts", event_time("h_time")).withWatermark("h_ts", delay(DELAY))
    j = range_join_stream(left, right, ("i", "j"), "ts", "h_ts", RANGE_BEFORE, RANGE_AFTER, "full")
    # the event times are the times once more: written for every pair, they would be most of the files
    return spark.read.parquet(_files(spark, j.drop("ts", "h_ts"), "range-join")).select("i", "j", "time", "gen", "h_time", "val")


def stream_halo_merge(spark, sf):
    """The outer join of sources and halo rows as two tables that change: the
    readings come in four slices dealt at random, and every change upserts."""
    folder, out, ckpt = (scratch_path(spark, f"tables-{x}") for x in ("in", "out", "ckpt"))
    rows = load_readings(spark, sf, GRID)
    sink = keyed_batch_fn(out, ("tick", "i", "j"), _block(), ("f", "version"), ("version",))
    for n in range(4):
        rows.where(F.pmod(F.xxhash64("seq"), F.lit(4)) == n).write.mode("append").parquet(folder)
        with rocksdb(spark):
            run(to_batches(merge_halo_stream(stream_readings(spark, folder), NX, N_STRIPES, T, C), sink, ckpt, mode="update"))
    df = spark.read.schema("tick long, i int, j int, f double, version long, block long").parquet(out)
    return df.select("tick", "i", "j", q6("f").alias("f_e6"))


LATE_SLICES = 4


def stream_late_fold(spark, sf):
    """The fold over four time slices in which one reading in 17 comes two
    slices late: the history is that of all readings."""
    folder, out, ckpt = (scratch_path(spark, f"late-{x}") for x in ("in", "out", "ckpt"))
    rows = with_tick(load_readings(spark, sf, GRID), T)
    first, last = rows.agg(F.min("tick"), F.max("tick")).first()
    part = F.least(F.floor((F.col("tick") - F.lit(first)) * F.lit(LATE_SLICES) / F.lit(last - first + 1)), F.lit(LATE_SLICES - 1))
    slice_ = F.least(part + F.when(F.col("seq") % 17 == 0, 2).otherwise(0), F.lit(LATE_SLICES - 1))
    fold = LateFold(spark, out, GRID, FoldSpec(coeff=C), T, DELAY, "avg")
    for n in range(LATE_SLICES):
        rows.where(slice_ == n).drop("tick").write.mode("append").parquet(folder)
        run(to_batches(stream_readings(spark, folder), fold.batch, ckpt))
    return fold.history().select("tick", "i", "j", q6("u").alias("u_e6"))


def stream_block_fold(spark, sf):
    """The fold with its state per block in Spark's state store: four blocks
    that exchange halo rows every four ticks, over four time slices of the
    readings, stopped and started again after two."""
    folder, out, ckpt = (scratch_path(spark, f"blocks-{x}") for x in ("in", "out", "ckpt"))
    rows = with_tick(load_readings(spark, sf, GRID), T)
    first, last = rows.agg(F.min("tick"), F.max("tick")).first()
    if first is None:
        return spark.createDataFrame([], "tick long, i int, j int, u_e6 long")
    part = F.least(F.floor((F.col("tick") - F.lit(first)) * F.lit(4) / F.lit(last - first + 1)), F.lit(3))
    fold = BlockFold(spark, out, GRID, FoldSpec(coeff=C), T, first, steps=4, tile=(-(-NX // 2), -(-NY // 2)))
    fold.seed()
    for n in range(4):
        rows.where(part == n).drop("tick").coalesce(1).write.mode("append").parquet(folder)
        if n % 2:
            fold.drain(stream_readings(spark, folder, max_files=1), ckpt, DELAY, "avg")
    return fold.history().select("tick", "i", "j", q6("u").alias("u_e6"))


def stream_tee(spark, sf):
    out, halo = scratch_path(spark, "tee-out"), scratch_path(spark, "tee-halo")
    s = closed_ticks(stream_events(spark, sf, GRID), T, DELAY, "last")
    run(to_batches(s, tee_batch_fn(out, halo, NX, N_STRIPES, T), scratch_path(spark, "tee-ckpt")))
    return spark.read.schema("tick long, i int, j int, val double, epoch long").parquet(halo).select("tick", "i", "j", "val")


def stream_partitioned_sink(spark, sf):
    s = closed_ticks(stream_events(spark, sf, GRID), T, DELAY, "last")
    # one directory per stripe; tasks split by (stripe, tick) so a busy
    # stripe is not written by a single task
    s = s.withColumn("stripe", stripe_of("i", NX, N_STRIPES)).repartition("stripe", "tick")
    out = _files(spark, s, "stripes", partition_by=("stripe",))
    return spark.read.schema("tick long, i int, j int, f double, stripe int").parquet(out).select(
        "tick", "i", "j", "f", "stripe"
    )


def stream_poll(spark, sf):
    out = scratch_path(spark, "poll-out")
    run(to_batches(stream_events(spark, sf, GRID), poll_batch_fn(out, T), scratch_path(spark, "poll-ckpt")))
    polled = spark.read.schema("tick long, n_readings long, epoch long").parquet(out)
    return polled.groupBy("tick").agg(F.sum("n_readings").alias("n_readings"))


def stream_poll_metrics(spark, sf):
    """Input rows, observed rows and times, and rows that the watermark
    dropped, over all polls of a stream of closed ticks."""
    listener = PollListener()
    spark.streams.addListener(listener)
    try:
        rows = closed_ticks(observed(stream_events(spark, sf, GRID)), T, DELAY, "avg")
        out, ckpt, saved = (scratch_path(spark, f"metrics-{x}") for x in ("out", "ckpt", "table"))
        listener.wait(run(to_files(rows, out, ckpt)))
        listener.save(spark, saved)
    finally:
        spark.streams.removeListener(listener)
    return spark.read.schema(METRICS_DDL).parquet(saved).agg(
        F.sum("n_input").alias("n_input"),
        F.sum("n_readings").alias("n_readings"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.sum("n_dropped").alias("n_dropped"),
    )


def stream_fold(spark, sf):
    state = scratch_path(spark, "stream-fold-state")
    q = stream_tick_fold(
        spark, stream_events(spark, sf, GRID), GRID, FoldSpec(coeff=C), T, DELAY, state,
        scratch_path(spark, "stream-fold-ckpt"), dup="avg",
    )
    run(q)
    return read_states(spark, state).select("tick", "i", "j", q6("u").alias("u_e6"))


def stream_fold_hopping(spark, sf):
    """The streaming fold fed by closed hopping means: one tick a day."""
    state = scratch_path(spark, "hop-fold-state")
    ev = with_event_time(stream_events(spark, sf, GRID), DAY).withWatermark("event_time", delay(DELAY))
    rows = align_windows(ev, 2 * DAY, DAY, C, F.col("event_time"))
    fn = fold_batch_fn(spark, GRID, FoldSpec(coeff=C), DAY, state, scratch_path(spark, "hop-fold-stage"))
    run(to_batches(rows, fn, scratch_path(spark, "hop-fold-ckpt")))
    return read_states(spark, state).select("tick", "i", "j", q6("u").alias("u_e6"))


def stream_restart(spark, sf):
    """The streaming fold over four time slices of the readings: two arrive,
    the query ends, the others arrive and it starts again from its checkpoint."""
    folder, state, ckpt = (scratch_path(spark, f"restart-{x}") for x in ("in", "state", "ckpt"))
    rows = with_tick(load_readings(spark, sf, GRID), T)
    first, last = rows.agg(F.min("tick"), F.max("tick")).first()
    part = F.least(F.floor((F.col("tick") - F.lit(first)) * F.lit(4) / F.lit(last - first + 1)), F.lit(3))
    for n in range(4):
        rows.where(part == n).drop("tick").write.mode("append").parquet(folder)
        if n % 2:
            q = stream_tick_fold(spark, stream_readings(spark, folder), GRID, FoldSpec(coeff=C), T, DELAY, state, ckpt, dup="avg")
            run(q)
    return read_states(spark, state).select("tick", "i", "j", q6("u").alias("u_e6"))


def stream_store_results(spark, sf):
    """Streaming fold that also upserts every new tick into the results table."""
    from gridcast.sources.store import read_results

    state, results = scratch_path(spark, "sr-state"), scratch_path(spark, "sr-results")
    s = closed_ticks(stream_events(spark, sf, GRID), T, DELAY, "avg")
    fn = fold_batch_fn(
        spark, GRID, FoldSpec(coeff=C), T, state, scratch_path(spark, "sr-stage"), results_path=results
    )
    run(to_batches(s, fn, scratch_path(spark, "sr-ckpt")))
    r = read_results(spark, results)
    return r.select("tick_index", q6("x").alias("x_e6"), q6("y").alias("y_e6"), q6("temp").alias("temp_e6"))


def stream_log_round_trip(spark, sf):
    """Readings written as a keyed JSON log by one stream and read back by a
    second stream (the producer/consumer pair of a topic)."""
    from gridcast.streaming.sinks import as_log_records
    from gridcast.streaming.source import stream_log_readings

    log = scratch_path(spark, "log")
    run(to_files(as_log_records(stream_events(spark, sf, GRID)).select("value"), log, scratch_path(spark, "log-ckpt"), fmt="text"))
    back = stream_log_readings(spark, "text", log)
    return spark.read.parquet(_files(spark, back, "log-read")).select("time", "i", "j", "gen")


def stream_queries(base, fold_base, fold_sql, window_sql, halo_sql, q, x, stripe, y, window_rows_sql, range_sql, merge_sql):
    """``name -> (fn, oracle SQL)`` for the streaming queries; the SQL
    pieces come from the catalog so both forms share one definition."""
    closed = f"(SELECT max(tick) FROM ticked) - {DELAY}"

    tick_sql = f"""{base} SELECT seq, time, tick FROM ticked"""
    return {
        "stream_tick_snap": (stream_tick_snap, tick_sql),
        "stream_log_round_trip": (stream_log_round_trip, f"{base} SELECT time, i, j, gen FROM readings"),
        "stream_latest": (
            stream_latest,
            f"""{base} SELECT i, j, max(time) AS time, arg_max(gen, struct_pack(t := time, s := seq)) AS gen
            FROM readings GROUP BY i, j""",
        ),
        "stream_window_avg": (_window_query(DAY, None, "win"), window_sql(DAY, None)),
        "stream_hopping_avg": (_window_query(2 * DAY, DAY, "hop"), window_sql(2 * DAY, DAY)),
        "stream_dedup": (stream_dedup, f"{base} SELECT tick, i, j, f FROM last_rows"),
        "stream_interval_join": (
            stream_interval_join,
            f"""{base}, l AS (SELECT * FROM last_rows WHERE tick <= {closed}),
            h AS ({halo_sql('l')})
            SELECT coalesce(l.tick, h.tick) AS tick, coalesce(l.i, h.i) AS i, coalesce(l.j, h.j) AS j, l.f, h.val
            FROM l FULL OUTER JOIN h ON l.tick = h.tick AND l.i = h.i AND l.j = h.j
            WHERE coalesce(l.tick, h.tick) <= {closed}""",
        ),
        "stream_range_join": (stream_range_join, range_sql(True)),
        "stream_halo_merge": (stream_halo_merge, merge_sql),
        "stream_late_fold": (
            stream_late_fold,
            f"{fold_base}{fold_sql('zero', 'avg_rows', f'b.t1 - {DELAY}')}\nSELECT tick, i, j, {q('u')} AS u_e6 FROM hist",
        ),
        "stream_block_fold": (
            stream_block_fold,
            f"{fold_base}{fold_sql('zero', 'avg_rows', f'b.t1 - {DELAY}')}\nSELECT tick, i, j, {q('u')} AS u_e6 FROM hist",
        ),
        "stream_tee": (
            stream_tee,
            f"""{base}, l AS (SELECT * FROM last_rows WHERE tick <= {closed}) {halo_sql('l')}""",
        ),
        "stream_partitioned_sink": (
            stream_partitioned_sink,
            f"""{base} SELECT tick, i, j, f, CAST({stripe('i')} AS INTEGER) AS stripe FROM last_rows WHERE tick <= {closed}""",
        ),
        "stream_poll": (stream_poll, f"{base} SELECT tick, count(*) AS n_readings FROM ticked GROUP BY tick"),
        "stream_poll_metrics": (
            stream_poll_metrics,
            f"""{base} SELECT count(*) AS n_input, count(*) AS n_readings, min(time) AS first_time, max(time) AS last_time,
            CAST(0 AS BIGINT) AS n_dropped FROM readings""",
        ),
        "stream_store_results": (
            stream_store_results,
            f"""{fold_base}{fold_sql('zero', 'avg_rows', f'b.t1 - {DELAY}')}
            SELECT tick // {T} AS tick_index, {q(x('i'))} AS x_e6, {q(y('j'))} AS y_e6, {q('u')} AS temp_e6
            FROM hist WHERE tick >= (SELECT min(tick) FROM avg_rows)""",
        ),
        "stream_fold_hopping": (
            stream_fold_hopping,
            f"""{fold_base}{window_rows_sql(2 * DAY, DAY)},
            done AS (SELECT * FROM win_rows WHERE tick <= (SELECT max(time) FROM readings) - {DELAY}){fold_sql('zero', 'done')}
            SELECT tick, i, j, {q('u')} AS u_e6 FROM hist""",
        ),
        "stream_restart": (
            stream_restart,
            f"{fold_base}{fold_sql('zero', 'avg_rows', f'b.t1 - {DELAY}')}\nSELECT tick, i, j, {q('u')} AS u_e6 FROM hist",
        ),
        "stream_fold": (
            stream_fold,
            f"{fold_base}{fold_sql('zero', 'avg_rows', f'b.t1 - {DELAY}')}\nSELECT tick, i, j, {q('u')} AS u_e6 FROM hist",
        ),
    }


__all__ = ["stream_queries"]


def stream_window_avg_query(spark, sf):
    """Tumbling daily windows on the stream (the bench's streaming window)."""
    return _window_query(DAY, None, "win")(spark, sf)
