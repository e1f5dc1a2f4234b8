"""Range joins, panes, co-partitioned tables, changing tables, late readings."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from gridcast.config import TEST_GRID, FoldSpec, GridSpec
from gridcast.operators import align, halo_rows, hopping_mean, merge_halo, range_join, window_mean
from gridcast.plans.fold import tick_fold
from gridcast.schemas import READINGS
from gridcast.sources.bucketed import bucketed, merge_halo_bucketed, with_state
from gridcast.sources.readings import load_readings
from gridcast.streaming.joins import range_join_stream
from gridcast.streaming.late import LateFold
from gridcast.streaming.sinks import run, to_batches, to_files
from gridcast.streaming.source import stream_readings
from gridcast.streaming.tables import merge_halo_stream, rocksdb

SF = "/root/testdata/sf0.001"
DAY = 86_400_000
L, R = "k int, a long, x int", "k int, b long, y int"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _brute(left, right, before, after, how):
    out, met_l, met_r = [], set(), set()
    for n, (k, a, x) in enumerate(left):
        for m, (q, b, y) in enumerate(right):
            if None not in (k, a, q, b) and k == q and a - before <= b <= a + after:
                out.append((k, a, x, b, y))
                met_l.add(n)
                met_r.add(m)
    if how in ("left", "full"):
        out += [(*r, None, None) for n, r in enumerate(left) if n not in met_l]
    if how in ("right", "full"):
        out += [(r[0], None, None, *r[1:]) for m, r in enumerate(right) if m not in met_r]
    return sorted(out, key=repr)


@pytest.mark.parametrize("before,after", [(0, 0), (5, 0), (0, 7), (30, 10)])
def test_range_join_equals_all_pairs(spark, before, after):
    r = random.Random(before + after)
    side = lambda n: [(r.choice((0, 0, 0, 1, 2, None)), r.choice((None, *range(-60, 60))), i) for i in range(n)]
    left, right = side(70), side(60)
    left += left[:3]
    for how in ("inner", "left", "right", "full"):
        got = range_join(spark.createDataFrame(left, L), spark.createDataFrame(right, R), ("k",), "a", "b", before, after, how)
        assert got.columns == ["k", "a", "x", "b", "y"]
        assert _rows(got) == _brute(left, right, before, after, how)


def test_range_join_is_an_equality_join_and_refuses_bad_input(spark):
    left, right = spark.createDataFrame([(1, 1, 1)], L), spark.createDataFrame([(1, 1, 1)], R)
    plan = range_join(left, right, ("k",), "a", "b", 5, 5)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert range_join(left.limit(0), right, ("k",), "a", "b", 1, 1, "full").count() == 1
    for bad in (dict(how="cross"), dict(before=-1)):
        with pytest.raises(ValueError):
            range_join(left, right, ("k",), "a", "b", **{"before": 1, "after": 1, **bad})
    with pytest.raises(ValueError):
        range_join(left, left, ("k",), "a", "a", 1, 1)


def _slice(spark, folder, rows, n):
    """Append rows as one file that the source reads after the others."""
    spark.createDataFrame(rows, READINGS).coalesce(1).write.mode("append").parquet(folder)
    for f in glob.glob(f"{folder}/*.parquet"):
        if os.path.getmtime(f) > 2_000_000:
            os.utime(f, (1_000_000 + n, 1_000_000 + n))


def test_stream_range_join_over_restarts_equals_the_batch_join(spark, tmp_dir):
    """Slices in time order, a restart between them: all pairs are found, and
    an unmatched row comes once the watermark has passed its range."""
    r = random.Random(9)
    rows = sorted((r.randrange(0, 100_000), r.randrange(3), r.randrange(2)) for _ in range(400))
    rows = [(n, t, i, j, float(n)) for n, (t, i, j) in enumerate(rows)]
    folder, delay = f"{tmp_dir}/in", 500
    before, after = 400, 150

    def sides(df):
        left = df.where("seq % 2 = 0").select("i", "j", "time", "gen")
        return left, df.where("seq % 2 = 1").select("i", "j", F.col("time").alias("h_time"), F.col("gen").alias("val"))

    for n in range(4):
        _slice(spark, folder, rows[n * 100 : n * 100 + 100], n)
        left, right = sides(stream_readings(spark, folder))
        left = left.withColumn("ts", F.timestamp_millis("time")).withWatermark("ts", f"{delay} milliseconds")
        right = right.withColumn("h_ts", F.timestamp_millis("h_time")).withWatermark("h_ts", f"{delay} milliseconds")
        j = range_join_stream(left, right, ("i", "j"), "ts", "h_ts", before, after, "full").drop("ts", "h_ts")
        run(to_files(j, f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))
    got = _rows(spark.read.parquet(f"{tmp_dir}/out").select("i", "j", "time", "gen", "h_time", "val"))
    left, right = sides(spark.createDataFrame(rows, READINGS))
    mark = min(max(x[1] for x in rows[s::2]) for s in (0, 1)) - delay
    want = []
    for row in _rows(range_join(left, right, ("i", "j"), "time", "h_time", before, after, "full")):
        if row[4] is None and row[2] + after > mark or row[2] is None and row[4] + before > mark:
            continue
        want.append(row)
    assert got == sorted(want, key=repr)
    assert sum(x[4] is None for x in got) > 5 and sum(x[2] is None for x in got) > 5 and len({x[:2] for x in got}) == 6


@pytest.mark.parametrize("size,slide", [(2 * DAY, DAY), (7, 3), (30, 30), (12, 8), (DAY, 6 * 3_600_000)])
def test_panes_equal_windows(spark, size, slide):
    r = random.Random(size)
    span = 400 * size // slide if size < 100 else 20 * DAY
    rows = [(n, r.randrange(-span, span), r.randrange(2), 0, round(r.uniform(-5, 5), 2)) for n in range(300)]
    rows += [(300 + n, rows[n][1], rows[n][2], 0, 1.0) for n in range(20)]
    df = spark.createDataFrame(rows, READINGS)
    pick = lambda w: sorted((x.time, x.i, x.j, x.n_readings, round(x.f, 9)) for x in w.collect())
    assert pick(hopping_mean(df, size, slide, 0.5)) == pick(window_mean(df, size, None if size == slide else slide, 0.5))


def test_panes_do_not_copy_readings(spark):
    """The readings are aggregated as they are; only panes open into windows."""
    plan = hopping_mean(load_readings(spark, SF), 30 * DAY, 3_600_000)._jdf.queryExecution().executedPlan().toString()
    scan = plan.rindex("Generate explode")
    assert "Expand" not in plan and plan.count("Generate explode") == 1 and "HashAggregate" in plan[scan:]
    assert plan.count("Exchange hashpartitioning") == 2
    for bad in ((10, 20), (0, 0), (10, 0)):
        with pytest.raises(ValueError):
            hopping_mean(load_readings(spark, SF), *bad)


def test_bucketed_tables_join_without_exchange(spark):
    a = align(load_readings(spark, SF), DAY)
    h = halo_rows(a, 12, 5, DAY).groupBy("tick", "i", "j").agg(F.sum("val").alias("val"))
    key = ("tick", "i", "j")
    x, y, s = bucketed(a, key, 4), bucketed(h, key, 4), bucketed(a.withColumnRenamed("f", "u_prev"), key, 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (merge_halo_bucketed(x, y, 0.2), with_state(x, s)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert df.count() >= a.count()
        # one file per bucket, and unequal buckets do need a shuffle
        assert len({r[0] for r in x.select(F.input_file_name()).collect()}) <= 4
        assert "Exchange" in merge_halo_bucketed(x, bucketed(h, key, 3), 0.2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert _rows(merge_halo_bucketed(x, y, 0.2)) == _rows(merge_halo(a, halo_rows(a, 12, 5, DAY), 0.2))


@pytest.mark.parametrize("keep", [None, 10**9])
def test_changing_tables_equal_the_batch_join_for_any_split(spark, tmp_dir, keep):
    """Readings in an order dealt at random over three runs; each result row
    is the latest of its versions."""
    r = random.Random(4)
    rows = [(n, r.randrange(100, 600), r.randrange(12), r.randrange(2), float(r.randrange(100))) for n in range(300)]
    rows += [(300 + n, t, i, j, -1.0) for n, (_, t, i, j, _) in enumerate(rows[:30])]
    whole = spark.createDataFrame(rows, READINGS)
    r.shuffle(rows)
    latest = {}

    def sink(batch, epoch):
        for x in batch.collect():
            if x.version > latest.get((x.tick, x.i, x.j), (0, 0))[0]:
                latest[x.tick, x.i, x.j] = (x.version, round(x.f, 9))

    for n in range(3):
        _slice(spark, f"{tmp_dir}/in", rows[n * 110 : n * 110 + 110], n)
        with rocksdb(spark):
            stream = merge_halo_stream(stream_readings(spark, f"{tmp_dir}/in"), 12, 5, 100, 0.25, keep, 1000)
            run(to_batches(stream, sink, f"{tmp_dir}/ckpt", mode="update"))
    a = align(whole, 100)
    want = {(x.tick, x.i, x.j): round(x.f, 9) for x in merge_halo(a, halo_rows(a, 12, 5, 100), 0.25).collect()}
    assert {k: v[1] for k, v in latest.items()} == want
    assert max(v[0] for v in latest.values()) > 1


def test_timer_drops_the_state_of_old_ticks(spark, tmp_dir):
    """Behind ``keep_ms`` a key starts anew: its versions count from 1."""
    seen = []
    sink = lambda batch, epoch: seen.extend((x.tick, x.version) for x in batch.collect())
    for n, rows in enumerate(([(0, 100, 5, 0, 1.0)], [(1, 100_000, 5, 0, 1.0)], [(2, 100_000, 5, 0, 2.0)])):
        _slice(spark, f"{tmp_dir}/in", rows, n)
        with rocksdb(spark):
            stream = merge_halo_stream(stream_readings(spark, f"{tmp_dir}/in"), 12, 1, 100, 0.25, 1000, 100)
            run(to_batches(stream, sink, f"{tmp_dir}/ckpt", mode="update"))
    assert seen == [(100, 1), (100_000, 1), (100_000, 2)]
    state = spark.read.format("statestore").option("stateVarName", "version").load(f"{tmp_dir}/ckpt")
    assert [r.key.tick for r in state.collect()] == [100_000]


G = GridSpec(7, 5)


def _late_slices():
    r = random.Random(11)
    rows = [(n, 100 * t + r.randrange(-40, 40), r.randrange(7), r.randrange(5), float(r.randrange(1, 50))) for n, t in enumerate(sorted(r.choices(range(3, 20), k=90)))]
    slices = [rows[k * 30 : k * 30 + 30] for k in range(3)]
    # late ones: into closed ticks, before the first tick, beside an earlier reading
    slices[1] += [(900, 420, 2, 2, 30.0), (901, slices[0][5][1], slices[0][5][2], slices[0][5][3], 9.0)]
    slices[2] += [(902, 100, 6, 4, 8.0), (903, 700, 0, 0, -4.0), (904, 700, 0, 0, 7.0)]
    return slices


@pytest.mark.parametrize("dup", ["avg", "last"])
def test_late_readings_repair_the_history(spark, tmp_dir, dup):
    slices, spec = _late_slices(), FoldSpec(coeff=0.2, source_scale=0.5)
    fold = LateFold(spark, f"{tmp_dir}/fold", G, spec, 100, 200, dup)
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_dir}/fold/*/epoch=*/**/*.parquet", recursive=True)}
    for n, rows in enumerate(slices):
        _slice(spark, f"{tmp_dir}/in", rows, n)
        before = files() if n else {}
        run(to_batches(stream_readings(spark, f"{tmp_dir}/in"), fold.batch, f"{tmp_dir}/ckpt"))
        # nothing that an earlier epoch wrote is written again
        assert all(files()[f] == t for f, t in before.items())
    every = spark.createDataFrame([r for s in slices for r in s], READINGS)
    last = (max(r[1] for s in slices for r in s) + 50) // 100 * 100 - 200
    aligned = align(every, 100, dup).where(F.col("tick") <= last)
    want = tick_fold(spark, aligned, G, spec, 100, method="step", bounds=(aligned.agg(F.min("tick")).first()[0], last))
    pick = lambda df: {(x.tick, x.i, x.j): x.u for x in df.collect()}
    got, want = pick(fold.history()), pick(want.history(spark))
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    late = {r.seq for r in fold.late().collect()}
    assert late >= {900, 901, 902, 903, 904} and len(late) < 20


def test_a_replayed_epoch_and_a_small_cone(spark, tmp_dir):
    slices = _late_slices()[:2] + [[(900, 700, 3, 2, 30.0)]]
    fold = LateFold(spark, f"{tmp_dir}/fold", G, FoldSpec(), 100, 200)
    frames = [spark.createDataFrame(s, READINGS) for s in slices]
    for n, df in enumerate(frames):
        fold.batch(df, n)
    whole = _rows(fold.history())
    fold.batch(frames[2], 2)
    assert _rows(fold.history()) == whole
    # the change stays within its cone
    top = fold.done(2)[2]
    fixes = spark.read.parquet(f"{tmp_dir}/fold/fixes/epoch=2").collect()
    assert fixes and all(700 <= r.tick <= top and abs(r.i - 3) + abs(r.j - 2) <= (r.tick - 700) // 100 for r in fixes)


def test_late_fold_of_nothing(spark, tmp_dir):
    fold = LateFold(spark, f"{tmp_dir}/fold", TEST_GRID, FoldSpec(), 100, 200)
    fold.batch(spark.createDataFrame([], READINGS), 0)
    assert fold.history().count() == 0 and fold.late().count() == 0
    fold.batch(spark.createDataFrame([(1, 1000, 99, 0, 1.0)], READINGS), 1)  # outside the grid
    assert fold.history().count() == 0
    with pytest.raises(ValueError):
        LateFold(spark, tmp_dir, TEST_GRID, FoldSpec(), 100, 200, "most")
