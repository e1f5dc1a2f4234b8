"""Neighbour step and tick fold: goldens, properties, and method agreement."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.config import FoldSpec, GridSpec
from gridcast.operators import align, densify_state, neighbour_step, step_by_lookup
from gridcast.plans.fold import tick_fold
from gridcast.plans.tiled import run_steps

C = 0.1875
G5 = GridSpec(5, 5)


def _impulse(spark):
    return densify_state(spark, spark.createDataFrame([(2, 2, 1.0)], "i int, j int, u double"), G5)


def _grid(df, g):
    a = np.zeros((g.nx, g.ny))
    for r in df.collect():
        a[r.i, r.j] = r.u
    return a


@pytest.mark.parametrize("edge", ["zero", "fixed"])
@pytest.mark.parametrize("lookup", [False, True])
def test_impulse_two_steps(spark, edge, lookup):
    op = step_by_lookup if lookup else neighbour_step
    spec = FoldSpec(coeff=C, edge=edge)
    s1 = op(_impulse(spark), None, G5, spec)
    a1 = _grid(s1, G5)
    assert a1[2, 2] == pytest.approx(0.25)
    assert a1[1, 2] == a1[3, 2] == a1[2, 1] == a1[2, 3] == pytest.approx(0.1875)
    assert a1.sum() == pytest.approx(1.0)
    a2 = _grid(op(densify_state(spark, s1, G5), None, G5, spec), G5)
    assert a2[2, 2] == pytest.approx(0.203125)
    assert a2[1, 2] == pytest.approx(0.09375)
    assert a2[1, 1] == pytest.approx(0.0703125)
    if edge == "zero":
        assert a2[0, 2] == pytest.approx(0.03515625)
        assert a2.sum() == pytest.approx(1.0)
    else:
        assert a2[0, 2] == 0.0
        assert a2.sum() == pytest.approx(0.859375)


def test_numpy_kernel_matches_impulse():
    u = np.zeros((5, 5))
    u[2, 2] = 1.0
    out = run_steps(u, np.zeros((2, 5, 5)), None, C)
    assert out[1][0, 2] == pytest.approx(0.03515625)


def test_linearity_and_mirror_symmetry(spark):
    g = GridSpec(7, 6)
    rng = np.random.default_rng(1)
    a = rng.random((7, 6))
    rows = [(i, j, float(a[i, j])) for i in range(7) for j in range(6)]
    st = spark.createDataFrame(rows, "i int, j int, u double")
    mirror = spark.createDataFrame([(6 - i, j, u) for i, j, u in rows], "i int, j int, u double")
    twice = spark.createDataFrame([(i, j, 2 * u) for i, j, u in rows], "i int, j int, u double")
    spec = FoldSpec(coeff=C)
    s = _grid(neighbour_step(st, None, g, spec), g)
    m = _grid(neighbour_step(mirror, None, g, spec), g)
    t = _grid(neighbour_step(twice, None, g, spec), g)
    assert np.allclose(s[::-1, :], m)
    assert np.allclose(2 * s, t)


def _fold_array(spark, res, g):
    h = res.history(spark).orderBy("tick", "i", "j").toPandas()
    ticks = sorted(h.tick.unique())
    return ticks, h.u.to_numpy().reshape(len(ticks), g.nx, g.ny)


@pytest.mark.parametrize("edge", ["zero", "fixed"])
def test_tiled_equals_step_for_all_tilings(spark, edge):
    """M9 = M4 for several tile shapes / stripe counts, both edge rules."""
    from gridcast.sources.readings import load_readings

    g = GridSpec(12, 8)
    a = align(load_readings(spark, "/root/testdata/sf0.001", g), 86_400_000, "avg")
    spec = FoldSpec(coeff=C, edge=edge)
    bounds = (1704067200000, 1704067200000 + 7 * 86_400_000)
    ref = _fold_array(spark, tick_fold(spark, a, g, spec, 86_400_000, bounds=bounds, method="step"), g)
    for tile, steps in [((12, 8), None), ((4, 8), 3), ((5, 3), 2), ((3, 8), 3), ((12, 2), 2)]:
        got = _fold_array(
            spark,
            tick_fold(spark, a, g, spec, 86_400_000, bounds=bounds, method="tiled", tile=tile, steps_per_round=steps),
            g,
        )
        assert got[0] == ref[0]
        assert np.allclose(got[1], ref[1], rtol=0, atol=1e-9), (tile, steps)


def test_gap_tick_is_a_step_with_zero_source(spark):
    g = GridSpec(3, 3)
    a = spark.createDataFrame([(100, 1, 1, 1.0), (300, 1, 1, 0.0)], "tick long, i int, j int, f double")
    res = tick_fold(spark, a, g, FoldSpec(coeff=C), 100, method="step")
    ticks, arr = _fold_array(spark, res, g)
    assert ticks == [0, 100, 200, 300]
    assert arr[1][1, 1] == 1.0
    assert arr[2][1, 1] == pytest.approx(0.25)  # decayed, no source at 200
    assert arr[2][0, 1] == pytest.approx(0.1875)


def test_conservation_until_edge(spark):
    g = GridSpec(9, 9)
    init = spark.createDataFrame([(4, 4, 1.0)], "i int, j int, u double")
    a = spark.createDataFrame([(100, 4, 4, 0.0)], "tick long, i int, j int, f double")
    res = tick_fold(spark, a, g, FoldSpec(coeff=C), 100, initial=init, bounds=(100, 400), method="tiled")
    _, arr = _fold_array(spark, res, g)
    # mass reaches the border after 4 steps; totals before that stay 1
    for k in range(1, 4):
        assert arr[k].sum() == pytest.approx(1.0)


def test_source_scale_and_initial_state(spark):
    g = GridSpec(3, 3)
    init = spark.createDataFrame([(1, 1, 2.0)], "i int, j int, u double")
    a = spark.createDataFrame([(100, 1, 1, 4.0)], "tick long, i int, j int, f double")
    res = tick_fold(spark, a, g, FoldSpec(coeff=C, source_scale=0.5), 100, initial=init, method="step")
    fin = _grid(res.final(spark), g)
    assert fin[1, 1] == pytest.approx(2.0 * 0.25 + 2.0)


def test_final_state_is_last_tick(spark):
    g = GridSpec(3, 3)
    a = spark.createDataFrame([(100, 1, 1, 1.0), (200, 0, 0, 1.0)], "tick long, i int, j int, f double")
    res = tick_fold(spark, a, g, FoldSpec(coeff=C), 100)
    f = res.final(spark)
    assert f.select(F.countDistinct("tick")).first()[0] == 1
    assert f.first().tick == 200
    assert f.count() == 9


def test_null_source_counts_as_zero_in_both_forms(spark):
    g = GridSpec(4, 4)
    a = spark.createDataFrame(
        [(100, 1, 1, 2.0), (100, 2, 2, None), (200, 2, 1, 1.0)], "tick long, i int, j int, f double"
    )
    x = _fold_array(spark, tick_fold(spark, a, g, FoldSpec(), 100, method="step"), g)
    y = _fold_array(spark, tick_fold(spark, a, g, FoldSpec(), 100, method="tiled"), g)
    assert x[0] == y[0]
    assert np.allclose(x[1], y[1]) and not np.isnan(y[1]).any()


def test_fold_into_given_table_twice_is_idempotent(spark, tmp_dir):
    from gridcast.sources.readings import load_readings

    g = GridSpec(12, 8)
    a = align(load_readings(spark, "/root/testdata/sf0.001", g), 86_400_000, "avg")
    ref = _fold_array(spark, tick_fold(spark, a, g, FoldSpec(), 86_400_000, steps_per_round=4), g)
    path = f"{tmp_dir}/hist"
    for _ in range(2):
        res = tick_fold(spark, a, g, FoldSpec(), 86_400_000, out_path=path, steps_per_round=4)
        got = _fold_array(spark, res, g)
        assert got[0] == ref[0]
        assert np.allclose(got[1], ref[1], atol=1e-12)
