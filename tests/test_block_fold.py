"""The streaming fold by blocks against the batch fold."""

import glob
import os
import random

import numpy as np
import pytest

from gridcast.config import FoldSpec, GridSpec
from gridcast.operators.align import align
from gridcast.plans.fold import tick_fold
from gridcast.schemas import READINGS
from gridcast.streaming.blocks import BlockFold, _Block
from gridcast.streaming.source import stream_readings

T = 1000


@pytest.fixture()
def two_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _readings(seed, grid, ticks):
    """Two readings a tick, all in the left half of the grid: blocks on the
    right live on halo rows and timers alone."""
    r = random.Random(seed)
    out = []
    for n, t in enumerate(t for t in ticks for _ in range(2)):
        out.append((n, t * T, r.randrange(max(grid.nx // 2, 1)), r.randrange(grid.ny), r.uniform(-2, 2)))
    return out


def _frame(spark, rows):
    order = {"seq": 0, "time": 1, "i": 2, "j": 3, "gen": 4}
    return spark.createDataFrame([tuple(r[order[f.name]] for f in READINGS.fields) for r in rows], READINGS)


def _table(df):
    return {(r.tick, r.i, r.j): r.u for r in df.collect()}


def _same(got, want):
    assert got.keys() == want.keys()
    keys = sorted(want)
    np.testing.assert_allclose([got[k] for k in keys], [want[k] for k in keys], rtol=0, atol=1e-12)


@pytest.mark.parametrize("edge,nx,ny,tile,steps", [("zero", 7, 5, (3, 2), 2), ("fixed", 6, 6, (4, 6), 3)])
def test_blocks_equal_the_batch_fold(spark, tmp_dir, two_partitions, edge, nx, ny, tile, steps):
    grid, spec = GridSpec(nx, ny), FoldSpec(coeff=0.2, source_scale=1.5, edge=edge)
    ticks = [1000, 1001, 1002, 1006, 1007, 1008, 1011]  # gaps: ticks that pass by timers
    rows = _readings(nx, grid, ticks)
    fold = BlockFold(spark, f"{tmp_dir}/out", grid, spec, T, 1000 * T, steps, tile)
    fold.seed()
    for n, some in enumerate((ticks[:2], ticks[2:3], ticks[3:6], ticks[6:])):
        _frame(spark, [r for r in rows if r[1] // T in some]).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        if n == 1:
            fold.drain(stream_readings(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/ckpt", T)
    # a new object over the same folders, as after a restart of the driver
    again = BlockFold(spark, f"{tmp_dir}/out", grid, spec, T, 1000 * T, steps, tile)
    again.seed()
    again.drain(stream_readings(spark, f"{tmp_dir}/in", max_files=1), f"{tmp_dir}/ckpt", T)
    history = again.history()
    got = _table(history)
    assert history.count() == len(got) and max(k[0] for k in got) == 1010 * T
    want = tick_fold(spark, align(_frame(spark, rows), T, "last"), grid, spec, T, f"{tmp_dir}/batch", method="tiled")
    _same(got, {k: v for k, v in _table(want.history(spark)).items() if k[0] <= 1010 * T})
    # both sides of a border wrote halo rows, at barrier ticks only
    halo = spark.read.parquet(f"{tmp_dir}/out/kind=halo").where("epoch >= 0")
    assert {(r.tick // T - 999) % steps for r in halo.select("tick").distinct().collect()} == {0}
    assert halo.select("epoch").distinct().count() > 1


def test_an_initial_state_and_a_replayed_epoch(spark, tmp_dir, two_partitions):
    grid, spec = GridSpec(4, 3), FoldSpec(coeff=0.25)
    start = spark.createDataFrame([(0, 0, 8.0), (3, 2, 4.0)], "i int, j int, u double")
    rows = [(0, 5 * T, 0, 0, 1.0), (1, 8 * T, 0, 0, 0.0)]
    fold = BlockFold(spark, f"{tmp_dir}/out", grid, spec, T, 5 * T, 1, (2, 3))
    fold.seed(start)
    _frame(spark, rows).write.parquet(f"{tmp_dir}/in")
    fold.drain(stream_readings(spark, f"{tmp_dir}/in"), f"{tmp_dir}/ckpt", T)
    before = _table(fold.history())
    # the last epoch is taken back and runs again
    last = max(glob.glob(f"{tmp_dir}/ckpt/commits/[0-9]*"), key=lambda p: int(p.rsplit("/", 1)[1]))
    for path in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(path):
            os.unlink(path)
    fold.drain(stream_readings(spark, f"{tmp_dir}/in"), f"{tmp_dir}/ckpt", T)
    assert _table(fold.history()) == before and fold.history().count() == len(before)
    u = np.zeros((4, 3))
    u[0, 0], u[3, 2] = 8.0, 4.0
    for tick in range(4, 8):
        if tick > 4:
            nb = np.pad(u, 1)
            u = 0.25 * (nb[2:, 1:-1] + nb[:-2, 1:-1] + nb[1:-1, 2:] + nb[1:-1, :-2])
            u[0, 0] += 1.0 if tick == 5 else 0.0
        np.testing.assert_allclose([[before[tick * T, i, j] for j in range(3)] for i in range(4)], u, atol=1e-12)
    assert len(before) == 4 * 12


@pytest.mark.parametrize("bad", [(0, 5 * T, 9, 0, 1.0), (0, 4 * T, 0, 0, 1.0)])
def test_readings_that_cannot_be_folded_end_the_query(spark, tmp_dir, two_partitions, bad):
    fold = BlockFold(spark, f"{tmp_dir}/out", GridSpec(4, 3), FoldSpec(coeff=0.25), T, 5 * T, 1, (2, 3))
    fold.seed()
    _frame(spark, [bad, (1, 9 * T, 0, 0, 0.0)]).write.parquet(f"{tmp_dir}/in")
    with pytest.raises(Exception, match="outside the grid"):
        fold.drain(stream_readings(spark, f"{tmp_dir}/in"), f"{tmp_dir}/ckpt", T)


def test_the_rim_is_what_neighbours_hold():
    grid, tile, k = GridSpec(7, 5), (3, 2), 2
    blocks = {}
    for ti in range(3):
        for tj in range(3):
            b = _Block(grid, FoldSpec(coeff=0.2), tile, k, T, 0)
            b._place((ti, tj))
            blocks[ti, tj] = b

    def cells(b, mask):
        return {(b.i0 + b.own[0].start + i, b.j0 + b.own[1].start + j) for i, j in zip(*np.nonzero(mask))}

    sent = set().union(*(cells(b, b._rim()) for b in blocks.values()))
    held = set()
    for b in blocks.values():
        outer = np.ones(b.shape, dtype=bool)
        outer[b.own] = False
        held |= {(b.i0 + i, b.j0 + j) for i, j in zip(*np.nonzero(outer))}
    assert held <= sent
