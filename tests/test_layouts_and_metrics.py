"""Keyframes and changes, the layout by cells, poll metrics."""

import os
import random
import re

import pytest

from gridcast.config import GridSpec
from gridcast.plans.changes import changes, frames, read_changes, replay_changes, write_changes
from gridcast.plans.serve import replay
from gridcast.schemas import READINGS
from gridcast.sources.cells import history_of_rectangle, morton, write_cells
from gridcast.streaming.metrics import PollListener, observed
from gridcast.streaming.sinks import run, to_files
from gridcast.streaming.source import stream_readings
from gridcast.streaming.windows import closed_ticks

DDL = "tick long, i int, j int, u double"
T = 100


def _history(seed, nx, ny, n, first=-300):
    """A field of which few cells change from tick to tick."""
    r = random.Random(seed)
    now = {(i, j): 0.0 for i in range(nx) for j in range(ny)}
    out = []
    for k in range(n):
        for c in r.sample(sorted(now), 3):
            now[c] = r.choice((None, 0.0, 1.5, float(k)))
        out += [(first + k * T, *c, v) for c, v in now.items()]
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("key_every", [1, 4, 50])
def test_changes_rebuild_the_history_exactly(spark, tmp_dir, key_every):
    rows = _history(key_every, 6, 5, 21)
    history = spark.createDataFrame(rows, DDL).repartition(5)
    path = f"{tmp_dir}/changes"
    write_changes(history, path, T, key_every, -300)
    for lo, hi in ((0, 20), (3, 11), (7, 7), (20, 20)):
        a, b = -300 + lo * T, -300 + hi * T
        assert _rows(frames(spark, path, a, b, T, key_every, -300)) == sorted((r for r in rows if a <= r[0] <= b), key=repr)
    stored = spark.read.parquet(path).count()
    if key_every == 1:
        assert stored == len(rows)
    else:  # keyframes, and at most three cells a tick
        assert stored <= 30 * -(-21 // key_every) + 3 * 21
    got = replay_changes(spark, path, 0, 500, GridSpec(6, 5), T, key_every, -300).collect()
    assert got == replay(history, 0, 500, GridSpec(6, 5)).collect()
    write_changes(history, path, T, key_every, -300)  # again
    assert spark.read.parquet(path).count() == stored


def test_changes_of_odd_histories(spark):
    assert changes(spark.createDataFrame([], DDL), T, 4).count() == 0
    twice = spark.createDataFrame([(0, 0, 0, 1.0)] * 2 + [(100, 0, 0, 1.0)] * 2, DDL)
    assert _rows(changes(twice, T, 4)) == [(0, 200, 0, 0, 1.0, 0)]
    nan = spark.createDataFrame([(0, 0, 0, float("nan")), (100, 0, 0, float("nan")), (200, 0, 0, None)], DDL)
    assert [r[:2] for r in _rows(changes(nan, T, 4))] == [(0, 200), (200, 300)]
    with pytest.raises(ValueError):
        changes(twice, T, 0)


def test_a_replay_of_changes_shuffles_nothing_and_reads_its_segments(spark, tmp_dir):
    path = f"{tmp_dir}/changes"
    write_changes(spark.createDataFrame(_history(1, 4, 4, 20, 0), DDL), path, T, 4)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(frames(spark, path, 500, 900, T, 4))
    assert {r.segment for r in read_changes(spark, path, 500, 900, T, 4).collect()} == {1, 2}
    p = plan(changes(spark.createDataFrame(_history(1, 4, 4, 20), DDL).repartition(3), T, 4))
    assert p.count("Exchange hashpartitioning") == 1


def test_morton_interleaves_the_bits(spark):
    cells = [(i, j) for i in range(9) for j in range(9)]
    got = {(r.i, r.j): r.m for r in spark.createDataFrame(cells, "i int, j int").select("i", "j", morton("i", "j").alias("m")).collect()}
    code = lambda i, j: int("".join(a + b for a, b in zip(f"{i:06b}", f"{j:06b}", strict=True)), 2)
    assert got == {c: code(*c) for c in cells}


def test_a_rectangle_reads_the_files_of_its_blocks(spark, tmp_dir):
    nx, ny, n = 20, 12, 9
    rows = [(k * T, i, j, float(k + i * j)) for k in range(n) for i in range(nx) for j in range(ny)]
    path = f"{tmp_dir}/cells"
    write_cells(spark.createDataFrame(rows, DDL).repartition(6), path, T, side=4, span_ticks=5)
    inside = lambda i, j, a, b: sorted(r for r in rows if i[0] <= r[1] <= i[1] and j[0] <= r[2] <= j[1] and a <= r[0] <= b)
    for i, j, ticks in (((3, 4), (5, 6), (None, None)), ((0, 19), (0, 0), (None, 300)), ((7, 7), (7, 7), (500, 800)), ((30, 40), (0, 3), (None, None))):
        df = history_of_rectangle(spark, path, i, j, T, ticks, side=4, span_ticks=5)
        assert _rows(df) == sorted(inside(i, j, ticks[0] or 0, 10**9 if ticks[1] is None else ticks[1]), key=repr)
    whole = len([f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")])
    df = history_of_rectangle(spark, path, (3, 4), (5, 6), T, side=4, span_ticks=5)
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bi.*bj", scan) and re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(i,3\)", scan)
    assert "Exchange" not in scan
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    opened = leaf.metrics().apply("numFiles").value()
    assert whole == 5 * 3 * 2 and opened == 2 * 1 * 2  # two blocks of columns, one of rows, two spans of ticks


def test_poll_metrics_count_input_late_rows_and_state(spark, tmp_dir):
    """Files in order, one a poll; the third holds a row of a closed tick."""
    files = [[(0, 100, 0, 0, 1.0), (1, 200, 0, 0, 1.0)], [(2, 900, 1, 0, 1.0)], [(3, 950, 1, 1, 1.0)], [(4, 100, 2, 2, 9.0), (5, 960, 0, 0, 1.0)]]
    os.makedirs(f"{tmp_dir}/in")
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, READINGS).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        for f in os.listdir(f"{tmp_dir}/in"):
            if os.path.getmtime(f"{tmp_dir}/in/{f}") > 2_000_000:
                os.utime(f"{tmp_dir}/in/{f}", (1_000_000 + k, 1_000_000 + k))
    listener = PollListener()
    spark.streams.addListener(listener)
    try:
        rows = closed_ticks(observed(stream_readings(spark, f"{tmp_dir}/in", max_files=1)), T, 100, "sum")
        query = run(to_files(rows, f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))
        listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    got = [r for r in listener.table(spark).orderBy("epoch").collect() if r.n_input]
    assert [(r.n_input, r.n_readings, r.first_time, r.last_time) for r in got] == [(2, 2, 100, 200), (1, 1, 900, 900), (1, 1, 950, 950), (2, 2, 100, 960)]
    assert sum(r.n_dropped for r in listener.table(spark).collect()) == 1
    assert all(r.n_state > 0 for r in got)
    for _ in range(2):  # a second save has nothing new
        listener.save(spark, f"{tmp_dir}/metrics")
    saved = spark.read.parquet(f"{tmp_dir}/metrics")
    assert saved.count() == listener.table(spark).count() and saved.agg({"n_input": "sum"}).first()[0] == 6
