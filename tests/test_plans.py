"""Physical-plan properties: pruning, partial aggregation, exchange counts."""

from gridcast.config import FoldSpec, GridSpec
from gridcast.operators import align, densify_state, neighbour_step
from gridcast.plans import tiled
from gridcast.sources.readings import load_readings

SF = "/root/testdata/sf0.001"
G = GridSpec(12, 8)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    p = _plan(align(load_readings(spark, SF, G), 86_400_000, "avg"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p
    assert "event_type" not in p and "props" not in p


def test_alignment_aggregates_map_side(spark):
    for dup in ("avg", "sum", "last"):
        p = _plan(align(load_readings(spark, SF, G), 86_400_000, dup))
        assert "partial_" in p, dup
        assert p.count("Exchange") == 1, dup


def test_step_has_one_exchange(spark):
    st = densify_state(spark, None, G).repartition(4)
    p = _plan(neighbour_step(st, None, G, FoldSpec()))
    assert p.count("Exchange hashpartitioning(i") == 1
    assert "partial_sum" in p
    assert "BroadcastExchange" not in p


def test_tiled_round_has_one_exchange(spark, tmp_dir):
    st = densify_state(spark, None, G).repartition(4)
    src = spark.createDataFrame([(100, 1, 1, 1.0)], "tick long, i int, j int, f double")
    p = _plan(tiled.advance_tiles(st, src, 0, 4, G, FoldSpec(), 100, (6, 4)))
    assert p.count("Exchange hashpartitioning(ti") == 1
    assert "FlatMapGroupsInPandas" in p


def _written_plans(spark, monkeypatch, run) -> list[str]:
    """Plans of the rows that a fold writes, round by round."""
    from gridcast.plans import fold

    seen = []
    write = fold.write_states
    monkeypatch.setattr(fold, "write_states", lambda df, *a, **k: (seen.append(_plan(df)), write(df, *a, **k))[1])
    run()
    return seen


def test_a_round_of_the_fold_has_one_exchange(spark, tmp_dir, monkeypatch):
    from gridcast.plans.fold import tick_fold

    rows = spark.createDataFrame([(100 * t, t % 12, t % 8, 1.0) for t in range(1, 9)], "tick long, i int, j int, f double")
    plans = _written_plans(spark, monkeypatch, lambda: tick_fold(spark, rows, G, FoldSpec(), 100, tile=(6, 4), steps_per_round=4))
    assert len(plans) == 2
    assert all(p.count("Exchange hashpartitioning") == 1 for p in plans)


def test_a_chain_of_steps_is_one_job_with_one_exchange_per_step(spark, tmp_dir, monkeypatch):
    from gridcast.plans.fold import tick_fold

    rows = spark.createDataFrame([(100 * t, t % 12, t % 8, 1.0) for t in range(1, 9)], "tick long, i int, j int, f double")
    plans = _written_plans(spark, monkeypatch, lambda: tick_fold(spark, rows, G, FoldSpec(), 100, method="step", steps_per_round=4))
    assert len(plans) == 2
    # one per step, and the two sides of the join with the sources
    assert all(4 <= p.count("Exchange hashpartitioning(i") <= 6 for p in plans)


def test_halo_is_one_pass(spark):
    from gridcast.operators import halo_rows

    p = _plan(halo_rows(align(load_readings(spark, SF, G), 86_400_000, "last"), 12, 5, 86_400_000))
    assert p.count("FileScan") == 1 and p.count("Exchange") == 1


def test_results_and_ranges_prune_their_blocks(spark, tmp_dir):
    from gridcast.sources.store import Layout, read_ticks, results_at, upsert_results, write_states

    rows = spark.createDataFrame([(t, 0.0, 0.0, float(t)) for t in range(12)], "tick_index long, x double, y double, temp double")
    upsert_results(spark, rows, f"{tmp_dir}/r", ("temp",), block_ticks=4)
    point = results_at(spark, f"{tmp_dir}/r", 5)
    assert "PartitionFilters: [isnotnull(ti_block" in _plan(point) and [r.temp for r in point.collect()] == [5.0]
    st = spark.createDataFrame([(t, 0, 0, 1.0) for t in range(0, 1200, 100)], "tick long, i int, j int, u double")
    write_states(st, f"{tmp_dir}/s", 0, 1100, Layout(0, 100, 4))
    some = read_ticks(spark, f"{tmp_dir}/s", 300, 500)
    assert "PartitionFilters: [isnotnull(tick_block" in _plan(some) and sorted(r.tick for r in some.collect()) == [300, 400, 500]


def test_upsert_bounds_the_files_of_a_block(spark, tmp_dir):
    import glob

    from gridcast.sources import store

    rows = spark.range(20_000).selectExpr("id % 40 as tick_index", "double(id) as x", "0D as y", "1D as temp").repartition(32)
    for _ in range(2):
        store.upsert_results(spark, rows, f"{tmp_dir}/r", ("temp",), block_ticks=20)
    assert len(glob.glob(f"{tmp_dir}/r/ti_block=*/part-*")) <= 2 * store.UPSERT_CHUNKS
    assert store.read_results(spark, f"{tmp_dir}/r").count() == 20_000


def test_point_read_names_one_block_and_pushes_the_tick_filter(spark, tmp_dir):
    from gridcast.sources.store import Layout, read_ticks, write_states

    st = spark.createDataFrame([(t, 0, 0, 1.0) for t in range(0, 800, 100)], "tick long, i int, j int, u double")
    write_states(st, f"{tmp_dir}/s", 0, 700, Layout(0, 100, 4))
    df = read_ticks(spark, f"{tmp_dir}/s", 500, 500)
    p = _plan(df)
    assert "InMemoryFileIndex(1 paths)" in p and "tick_block=1" in p
    assert "EqualTo(tick,500)" in p or "GreaterThanOrEqual(tick,500)" in p
    assert [r.tick for r in df.collect()] == [500]


def test_stored_files_are_in_tick_and_cell_order(spark, tmp_dir):
    """O2: rows of each written file, in file order, are sorted."""
    import glob

    import pyarrow.parquet as pq

    from gridcast.plans.fold import tick_fold

    rows = spark.createDataFrame([(100 * t, t % 12, t % 8, 1.0) for t in range(1, 9)], "tick long, i int, j int, f double")
    for method in ("step", "tiled"):
        tick_fold(spark, rows, G, FoldSpec(), 100, out_path=f"{tmp_dir}/{method}", method=method)
        files = glob.glob(f"{tmp_dir}/{method}/tick_block=*/*.parquet")
        assert files
        for f in files:
            t = pq.ParquetFile(f).read().to_pydict()
            keys = list(zip(t["tick"], t["i"], t["j"], strict=True))
            assert keys == sorted(keys)


def test_streams_repartition_by_key_and_join_copartitioned(spark, tmp_dir):
    """T7, T12: a streaming aggregate is dealt by its key, and both sides of
    a stream-stream join by the join key."""
    from gridcast.streaming import queries as sq
    from gridcast.streaming.sinks import drain, to_files
    from gridcast.streaming.source import stream_events
    from gridcast.streaming.windows import closed_ticks

    def plan(df, name):
        q = to_files(df, f"{tmp_dir}/{name}", f"{tmp_dir}/{name}-ckpt")
        drain(q)
        return q._jsq.explainInternal(False)

    ticks = closed_ticks(stream_events(spark, SF, G), 86_400_000, 86_400_000, keep_ts=True)
    assert "StateStoreSave" in (p := plan(ticks, "ticks")) and "Exchange hashpartitioning(tick_ts" in p
    halo = sq.halo_stream(closed_ticks(stream_events(spark, SF, G), 86_400_000, 86_400_000, keep_ts=True))
    joined = ticks.join(halo, (ticks.tick_ts == halo.h_ts) & (ticks.i == halo.h_i) & (ticks.j == halo.h_j), "full_outer").select("tick", "h_tick", "f", "val")
    p = plan(joined, "joined")
    join = p[p.index("StreamingSymmetricHashJoin") :]
    assert "hashpartitioning(tick_ts" in join and "hashpartitioning(h_ts" in join


def test_no_task_holds_a_whole_grid_unless_asked_to(spark, monkeypatch):
    from gridcast.plans.fold import plan_rounds, tick_fold

    rows = spark.createDataFrame([(100 * t, t % 12, t % 8, 1.0) for t in range(1, 4)], "tick long, i int, j int, f double")
    plans = _written_plans(spark, monkeypatch, lambda: tick_fold(spark, rows, G, FoldSpec(), 100))
    assert not any("FlatMapGroupsInPandas" in p for p in plans)
    assert plan_rounds(spark, GridSpec(40, 40), 5000, "auto", steps_per_round=500) == ("step", (40, 40), 8)
    assert plan_rounds(spark, GridSpec(1000, 1000), 30, "auto")[0] == "tiled"
    assert plan_rounds(spark, G, 30, "auto", tile=(6, 4), steps_per_round=2) == ("tiled", (6, 4), 2)
    assert plan_rounds(spark, G, 30, "tiled")[0] == "tiled"
