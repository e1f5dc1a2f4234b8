"""Streaming: late data, stream = batch, restart/replay idempotence."""

import os

from pyspark.sql import functions as F

from gridcast.config import FoldSpec, GridSpec, scratch_path
from gridcast.operators import align
from gridcast.plans.fold import tick_fold
from gridcast.schemas import READINGS
from gridcast.sources.readings import load_readings
from gridcast.sources.store import read_states
from gridcast.streaming.fold import fold_batch_fn
from gridcast.streaming.sinks import run, to_batches, to_files
from gridcast.streaming.source import stream_events, stream_readings
from gridcast.streaming.windows import closed_ticks, window_mean_stream

DAY = 86_400_000


def _write_batches(spark, folder, batches):
    seq = 0
    for k, batch in enumerate(batches):
        rows = []
        for t, v in batch:
            rows.append((seq, t, 0, 0, float(v)))
            seq += 1
        spark.createDataFrame(rows, READINGS).coalesce(1).write.parquet(f"{folder}/b{k:03d}")
        # the file source orders files by modification time
        for f in os.listdir(f"{folder}/b{k:03d}"):
            os.utime(f"{folder}/b{k:03d}/{f}", (1_000_000 + k, 1_000_000 + k))


def _window_sums(spark, tmp_dir, batches):
    src = f"{tmp_dir}/in"
    _write_batches(spark, src, batches)
    stream = spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true"
    ).parquet(src)
    w = window_mean_stream(stream, 100, 100, None, 1.0)
    out = f"{tmp_dir}/out"
    q = run(to_files(w, out, f"{tmp_dir}/ckpt"))
    got = spark.read.parquet(out).select((F.col("time") - 100).alias("start"), (F.col("f") * F.col("n_readings")).alias("s"))
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress if p["stateOperators"])
    return sorted((r.start, round(r.s, 9)) for r in got.collect()), dropped


def test_late_row_counts_when_watermark_of_previous_batch_allows(spark, tmp_dir):
    got, dropped = _window_sums(spark, tmp_dir, [[(100, 1)], [(450, 1)], [(250, 9), (360, 2)], [(2000, 1)]])
    assert got == [(100, 1), (200, 9), (300, 2), (400, 1)]
    assert dropped == 0


def test_late_row_dropped_one_batch_after_watermark_moves(spark, tmp_dir):
    got, dropped = _window_sums(
        spark, tmp_dir, [[(100, 1)], [(450, 1)], [(455, 1)], [(250, 9), (360, 2)], [(2000, 1)]]
    )
    assert got == [(100, 1), (300, 2), (400, 2)]
    assert dropped == 1


def _stream_fold(spark, sf, state, ckpt, stage):
    s = closed_ticks(stream_events(spark, sf), DAY, DAY, "avg")
    fn = fold_batch_fn(spark, GridSpec(12, 8), FoldSpec(), DAY, state, stage)
    return run(to_batches(s, fn, ckpt))


def test_stream_fold_equals_batch_fold_on_closed_ticks(spark):
    sf = "/root/testdata/sf0.001"
    state = scratch_path(spark, "t-state")
    _stream_fold(spark, sf, state, scratch_path(spark, "t-ck"), scratch_path(spark, "t-stage"))
    streamed = read_states(spark, state)
    a = align(load_readings(spark, sf), DAY, "avg")
    batch = tick_fold(spark, a, GridSpec(12, 8), FoldSpec(), DAY).history(spark)
    last_closed = streamed.agg(F.max("tick")).first()[0]
    assert last_closed == batch.agg(F.max("tick")).first()[0] - DAY
    b = batch.where(F.col("tick") <= last_closed)
    j = streamed.alias("s").join(b.alias("b"), ["tick", "i", "j"], "full")
    assert j.where(F.col("s.u").isNull() | F.col("b.u").isNull()).count() == 0
    assert j.select(F.max(F.abs(F.col("s.u") - F.col("b.u")))).first()[0] < 1e-9


def test_restart_and_replay_leave_state_unchanged(spark):
    sf = "/root/testdata/sf0.001"
    state, ckpt, stage = (scratch_path(spark, n) for n in ("r-state", "r-ck", "r-stage"))
    _stream_fold(spark, sf, state, ckpt, stage)
    before = sorted(read_states(spark, state).collect())
    # restart from the same checkpoint: nothing new to process
    _stream_fold(spark, sf, state, ckpt, stage)
    assert sorted(read_states(spark, state).collect()) == before
    # replay the epoch that closed the ticks (the no-data batch after the
    # first one under availableNow) with the same closed rows
    fn = fold_batch_fn(spark, GridSpec(12, 8), FoldSpec(), DAY, state, stage)
    last_closed = read_states(spark, state).agg(F.max("tick")).first()[0]
    replayed = align(load_readings(spark, sf), DAY, "avg").where(F.col("tick") <= last_closed)
    assert replayed.count() > 0
    fn(replayed, 1)
    assert sorted(read_states(spark, state).collect()) == before


def test_stream_source_reads_readings_files(spark, tmp_dir):
    rows = [(k, 100 * k, k % 3, 0, float(k)) for k in range(10)]
    spark.createDataFrame(rows, READINGS).write.parquet(f"{tmp_dir}/r")
    s = stream_readings(spark, f"{tmp_dir}/r")
    out = f"{tmp_dir}/o"
    run(to_files(s, out, f"{tmp_dir}/ck"))
    assert spark.read.parquet(out).count() == 10


def test_processing_time_trigger_fold_matches_available_now(spark):
    from gridcast.streaming.fold import stream_tick_fold
    from gridcast.streaming.sinks import drain

    sf = "/root/testdata/sf0.001"
    a_state, b_state = scratch_path(spark, "pt-a"), scratch_path(spark, "pt-b")
    run(stream_tick_fold(spark, stream_events(spark, sf), GridSpec(12, 8), FoldSpec(), DAY, DAY, a_state, scratch_path(spark, "pt-ck-a")))
    q = stream_tick_fold(
        spark, stream_events(spark, sf), GridSpec(12, 8), FoldSpec(), DAY, DAY, b_state, scratch_path(spark, "pt-ck-b"),
        trigger="200 milliseconds",
    )
    drain(q)
    a = sorted((r.tick, r.i, r.j, round(r.u, 9)) for r in read_states(spark, a_state).collect())
    b = sorted((r.tick, r.i, r.j, round(r.u, 9)) for r in read_states(spark, b_state).collect())
    assert a == b and len(a) > 0


def test_latest_per_cell_update_mode_over_several_batches(spark, tmp_dir):
    from gridcast.operators import latest_per_cell
    from gridcast.streaming.fold import latest_batch_fn

    src = f"{tmp_dir}/in"
    batches = [
        [(0, 10, 1, 1, 1.0), (1, 20, 2, 2, 2.0), (2, 30, 70, 3, 3.0)],
        [(3, 40, 1, 1, 4.0), (4, 5, 2, 2, 9.0)],  # (2,2) is older: no change
        [(5, 40, 1, 1, 5.0), (6, 50, 70, 3, 6.0)],  # same time, larger seq wins
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, READINGS).coalesce(1).write.parquet(f"{src}/b{k}")
        for f in os.listdir(f"{src}/b{k}"):
            os.utime(f"{src}/b{k}/{f}", (2_000_000 + k, 2_000_000 + k))
    stream = spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    out = f"{tmp_dir}/latest"
    q = run(to_batches(latest_per_cell(stream), latest_batch_fn(out), f"{tmp_dir}/ck", mode="update"))
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = sorted(spark.read.schema("i int, j int, time long, gen double, cblock int").parquet(out).select("i", "j", "time", "gen").collect())
    allrows = spark.createDataFrame([r for b in batches for r in b], READINGS)
    want = sorted(latest_per_cell(allrows).collect())
    assert got == want
    assert {r.gen for r in got} == {5.0, 2.0, 6.0}


def test_stream_fold_over_many_batches_equals_batch_fold(spark, tmp_dir):
    """Four files, one per trigger: each micro-batch closes other ticks and
    merges them into the state table's blocks."""
    from gridcast.sources.store import read_layout

    sf = "/root/testdata/sf0.001"
    r = load_readings(spark, sf)
    t0, t1 = r.agg(F.min("time"), F.max("time")).first()
    edges = [t0 + (t1 - t0) * k // 4 for k in range(5)]
    for k in range(4):
        lo, hi = edges[k], edges[k + 1]
        part = r.where((F.col("time") >= lo) & ((F.col("time") < hi) if k < 3 else (F.col("time") <= hi)))
        part.coalesce(1).write.parquet(f"{tmp_dir}/in/b{k}")
        for f in os.listdir(f"{tmp_dir}/in/b{k}"):
            os.utime(f"{tmp_dir}/in/b{k}/{f}", (3_000_000 + k, 3_000_000 + k))
    stream = spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true"
    ).parquet(f"{tmp_dir}/in")
    state = f"{tmp_dir}/state"
    fn = fold_batch_fn(spark, GridSpec(12, 8), FoldSpec(), DAY, state, f"{tmp_dir}/stage")
    q = run(to_batches(closed_ticks(stream, DAY, DAY, "avg"), fn, f"{tmp_dir}/ck"))
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4
    assert read_layout(spark, state).block_ticks > 1
    streamed = read_states(spark, state)
    batch = tick_fold(spark, align(r, DAY, "avg"), GridSpec(12, 8), FoldSpec(), DAY).history(spark)
    last = streamed.agg(F.max("tick")).first()[0]
    assert last == batch.agg(F.max("tick")).first()[0] - DAY
    j = streamed.alias("s").join(batch.where(F.col("tick") <= last).alias("b"), ["tick", "i", "j"], "full")
    assert j.where(F.col("s.u").isNull() | F.col("b.u").isNull()).count() == 0
    assert j.select(F.max(F.abs(F.col("s.u") - F.col("b.u")))).first()[0] < 1e-9


def test_stream_fold_fills_gap_ticks_between_batches(spark, tmp_dir):
    g = GridSpec(3, 3)
    files = [[(0, 100, 1, 1, 1.0), (1, 200, 0, 1, 2.0)], [(2, 600, 2, 2, 3.0)]]
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, READINGS).coalesce(1).write.parquet(f"{tmp_dir}/in/b{k}")
        for f in os.listdir(f"{tmp_dir}/in/b{k}"):
            os.utime(f"{tmp_dir}/in/b{k}/{f}", (4_000_000 + k, 4_000_000 + k))
    stream = spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true"
    ).parquet(f"{tmp_dir}/in")
    state = f"{tmp_dir}/state"
    fn = fold_batch_fn(spark, g, FoldSpec(), 100, state, f"{tmp_dir}/stage")
    run(to_batches(closed_ticks(stream, 100, 0, "last"), fn, f"{tmp_dir}/ck"))
    streamed = sorted((r.tick, r.i, r.j, round(r.u, 12)) for r in read_states(spark, state).collect())
    allrows = spark.createDataFrame([r for b in files for r in b], READINGS)
    batch = tick_fold(spark, align(allrows, 100, "last"), g, FoldSpec(), 100).history(spark)
    want = sorted((r.tick, r.i, r.j, round(r.u, 12)) for r in batch.collect())
    assert [t for t in sorted({x[0] for x in streamed})] == [0, 100, 200, 300, 400, 500, 600]
    assert streamed == want


def test_a_half_written_tick_is_not_a_state_to_start_from(spark, tmp_dir):
    """An epoch ended after a part of its ticks, and of one tick's cells, was
    written: its replay starts from the newest whole tick."""
    from gridcast.sources.store import latest_tick_before, write_states

    g, spec, path = GridSpec(4, 4), FoldSpec(), f"{tmp_dir}/state"
    fn = fold_batch_fn(spark, g, spec, 100, path, f"{tmp_dir}/stage")
    ddl = "tick long, i int, j int, f double"
    fn(spark.createDataFrame([(100, 1, 1, 8.0), (200, 2, 2, 4.0)], ddl), 0)
    write_states(spark.createDataFrame([(400, 1, 1, 99.0)], "tick long, i int, j int, u double"), path, 400, 400)
    assert latest_tick_before(spark, path, 500, 100, g.n_cells) == 200
    for _ in range(2):  # and the epoch again
        fn(spark.createDataFrame([(500, 1, 1, 1.0)], ddl), 1)
    want = tick_fold(spark, spark.createDataFrame([(100, 1, 1, 8.0), (200, 2, 2, 4.0), (500, 1, 1, 1.0)], ddl), g, spec, 100).history(spark)
    rows = lambda df: sorted((r.tick, r.i, r.j, round(r.u, 9)) for r in df.collect())
    assert rows(read_states(spark, path)) == rows(want)
    assert sorted(os.listdir(path)) == sorted(x for x in os.listdir(path) if x.startswith(("tick_block=", "_layout", "._layout", "_SUCCESS", "._SUCCESS")))


def test_a_table_with_only_later_ticks_is_not_started_anew(spark, tmp_dir):
    import pytest

    fn = fold_batch_fn(spark, GridSpec(4, 4), FoldSpec(), 100, f"{tmp_dir}/state", f"{tmp_dir}/stage")
    ddl = "tick long, i int, j int, f double"
    fn(spark.createDataFrame([(5000, 1, 1, 8.0)], ddl), 0)
    with pytest.raises(RuntimeError):
        fn(spark.createDataFrame([(100, 1, 1, 8.0)], ddl), 1)
