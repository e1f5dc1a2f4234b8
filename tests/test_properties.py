"""Property tests: expressions against plain-Python definitions."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridcast.functions import cell_key, cell_key_i, cell_key_j, stripe_of, tick_snap
from gridcast.plans.tiled import round_length
from gridcast.config import GridSpec


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-10**12, 10**13), min_size=1, max_size=50), st.sampled_from([100, 1000, 86_400_000]))
def test_tick_snap_matches_definition(spark, times, tick):
    df = spark.createDataFrame([(t,) for t in times], "time long")
    got = [r.t for r in df.select(tick_snap("time", tick).alias("t")).collect()]
    want = [math.ceil(t / tick - 0.5) * tick for t in times]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**31 - 1), st.integers(0, 2**31 - 1)), min_size=1, max_size=50))
def test_cell_key_round_trip_any_cell(spark, cells):
    df = spark.createDataFrame(cells, "i int, j int")
    rows = df.select("i", "j", cell_key("i", "j").alias("k")).select(
        "i", "j", "k", cell_key_i("k").alias("ki"), cell_key_j("k").alias("kj")
    ).collect()
    for r in rows:
        assert r.k == (r.i << 32) + r.j and (r.ki, r.kj) == (r.i, r.j)


@settings(max_examples=5, deadline=None)
@given(st.integers(1, 200), st.integers(1, 12))
def test_stripes_are_contiguous_and_cover(spark, nx, n):
    rows = spark.range(nx).select(stripe_of(F.col("id").cast("int"), nx, n).alias("s")).collect()
    s = [r.s for r in rows]
    assert s == sorted(s) and s[0] == 0 and s[-1] == (nx - 1) * n // nx


@given(st.integers(1, 3000), st.integers(1, 3000), st.integers(1, 2000), st.integers(1, 10_000))
def test_round_length_respects_bounds(nx, ny, slots, n_steps):
    from gridcast.plans import tiled

    g = GridSpec(nx, ny)
    tile = tiled.default_tile(g, slots)
    k = round_length(g, tile, None, n_steps)
    assert 1 <= k <= n_steps
    owned = tile[0] * tile[1]
    ext = min(tile[0] + 2 * k, nx) * min(tile[1] + 2 * k, ny)
    assert owned * k <= tiled.MAX_GROUP_VALUES
    assert ext * k <= tiled.MAX_GROUP_WORK
    assert ext <= 2 * owned


def test_no_group_holds_the_grid_of_several_tiles():
    from gridcast.plans import tiled

    for side in (40, 250, 1000):
        for slots in (8, 1000):
            g = GridSpec(side, side)
            tile = tiled.default_tile(g, slots)
            k = round_length(g, tile, None, 5001)
            ext = min(tile[0] + 2 * k, side) * min(tile[1] + 2 * k, side)
            assert ext <= 2 * tile[0] * tile[1]
            assert tile == (side, side) if side <= tiled.MIN_TILE_SIDE else ext < side * side


def test_a_round_beyond_the_bounds_is_refused():
    import pytest

    with pytest.raises(ValueError):
        round_length(GridSpec(5000, 5000), (5000, 5000), None, 10)
    with pytest.raises(ValueError):
        round_length(GridSpec(300, 300), (256, 256), 1000, 1000)


def _brute(nx, ny, ticks, src, coeff, edge):
    """Plain per-cell loop of the recurrence (the definition, no numpy tricks)."""
    import numpy as np

    u = np.zeros((nx, ny))
    out = []
    for m in range(ticks):
        new = np.zeros_like(u)
        for i in range(nx):
            for j in range(ny):
                interior = 0 < i < nx - 1 and 0 < j < ny - 1
                if edge == "fixed" and not interior:
                    new[i, j] = u[i, j]
                    continue
                s = (1 - 4 * coeff) * u[i, j] + src[m][i][j]
                for di, dj in ((-1, 0), (1, 0), (0, -1), (0, 1)):
                    a, b = i + di, j + dj
                    if 0 <= a < nx and 0 <= b < ny:
                        s += coeff * u[a, b]
                new[i, j] = s
        u = new
        out.append(u)
    return out


@settings(max_examples=4, deadline=None)
@given(
    st.integers(2, 9), st.integers(2, 7), st.integers(1, 6), st.integers(1, 5), st.integers(1, 4),
    st.sampled_from(["zero", "fixed"]), st.integers(0, 10_000),
)
def test_tiled_fold_matches_definition(spark, nx, ny, tw, th, steps, edge, seed):
    import numpy as np

    from gridcast.config import FoldSpec
    from gridcast.plans.fold import tick_fold

    rng = np.random.default_rng(seed)
    n_ticks = 6
    src = np.round(rng.random((n_ticks, nx, ny)) * (rng.random((n_ticks, nx, ny)) < 0.3), 3)
    rows = [(100 * (m + 1), i, j, float(src[m, i, j])) for m in range(n_ticks) for i in range(nx) for j in range(ny) if src[m, i, j]]
    rows.append((100, 0, 0, 0.0))
    rows.append((100 * n_ticks, 0, 0, 0.0))
    a = spark.createDataFrame(rows, "tick long, i int, j int, f double")
    g = GridSpec(nx, ny)
    res = tick_fold(spark, a, g, FoldSpec(edge=edge), 100, method="tiled", tile=(min(tw, nx), min(th, ny)), steps_per_round=steps)
    h = res.history(spark).where("tick > 0").orderBy("tick", "i", "j").toPandas()
    want = _brute(nx, ny, n_ticks, src, 0.1875, edge)
    got = h.u.to_numpy().reshape(n_ticks, nx, ny)
    assert np.allclose(got, np.array(want), atol=1e-12)
