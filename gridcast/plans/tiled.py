"""Tiled fold: ``k`` ticks per shuffle.

Cells are grouped into rectangular tiles of ``tw x th`` owned cells.  Each
tile also receives the state and sources of a ``k``-cell halo around it (a
cell is copied to the tiles whose halo reaches it; ``explode`` of the
candidate offsets + a range filter, no join).  One ``applyInPandas`` call
per tile runs ``k`` steps on a dense numpy array; a value near the halo's
outer rim is wrong after a step, but the error moves one cell per step, so
after ``k`` steps the owned cells are exact.  Only owned cells leave.

Memory of one group is bounded by the tile shape and ``k`` (never by the
number of readings: sources are aligned, so at most one row per cell and
tick), and the number of groups grows with the grid.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.config import FoldSpec, GridSpec

# Bounds on one tile group per round (they keep a group's memory and time
# fixed however large the grid or the tick range is):
MAX_GROUP_VALUES = 1 << 22  # owned (cell, tick) values emitted
MAX_GROUP_WORK = 1 << 23  # extended cells x steps (dense sources: ~0.5 GB of rows at worst)
HALO_REDUNDANCY = 2.0  # extended area / owned area, wherever there is a second tile
# Tile sides.  A grid of up to MIN_TILE_SIDE cells a side is one tile: below
# that a step's arithmetic is cheaper than moving its halo.
MIN_TILE_SIDE, MAX_TILE_SIDE = 128, 256
OUT_SCHEMA = "tick long, i int, j int, u double"


def default_tile(grid: GridSpec, parallelism: int = 8) -> tuple[int, int]:
    """Even tiles, about one per task slot, each side 128..256 cells; large
    grids get as many 256 x 256 tiles as they need."""
    side = int((grid.n_cells / max(parallelism, 1)) ** 0.5)
    side = max(MIN_TILE_SIDE, min(MAX_TILE_SIDE, side))

    def even(n: int) -> int:
        parts = -(-n // side)
        return -(-n // parts)

    return even(grid.nx), even(grid.ny)


def _extended_area(grid: GridSpec, tile: tuple[int, int], k: int) -> int:
    tw, th = tile
    return min(tw + 2 * k, grid.nx) * min(th + 2 * k, grid.ny)


def round_length(grid: GridSpec, tile: tuple[int, int], steps_per_round: int | None, n_steps: int) -> int:
    """Steps per round (one shuffle each).

    The largest ``k <= n_steps`` (or the requested value) whose group stays
    within the output, work and halo-redundancy bounds above; a tile that
    breaks them with one step is refused.
    """
    tw, th = tile
    owned = min(tw, grid.nx) * min(th, grid.ny)

    def fits(k: int) -> bool:
        ext = _extended_area(grid, tile, k)
        return owned * k <= MAX_GROUP_VALUES and ext * k <= MAX_GROUP_WORK and ext <= HALO_REDUNDANCY * owned

    if steps_per_round is not None:
        # a caller's own choice of tile and round: bounded in memory only
        k = max(1, min(n_steps, steps_per_round))
        if owned * k > MAX_GROUP_VALUES or _extended_area(grid, tile, k) * k > MAX_GROUP_WORK:
            raise ValueError(f"{k} steps of a {tw} x {th} tile exceed the size of a group")
        return k
    if not fits(1):
        raise ValueError(f"one step of a {tw} x {th} tile exceeds the bounds of a group")
    hi = max(1, min(n_steps, steps_per_round or n_steps))
    if fits(hi):
        return hi
    lo = 1
    while lo < hi:  # fits() is monotone in k
        mid = (lo + hi + 1) // 2
        if fits(mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def _offsets(n_tiles: int, tile_side: int, halo: int):
    r = min(n_tiles - 1, -(-halo // tile_side)) if n_tiles > 1 else 0
    return range(-r, r + 1)


def replicate_to_tiles(
    df: DataFrame, grid: GridSpec, tile: tuple[int, int], halo: int
) -> DataFrame:
    """Copy each ``(i, j, ...)`` row to every tile whose extended range
    (owned cells plus ``halo``) contains it; adds ``ti, tj``.  Candidate
    tiles are the ``ceil(halo/side)`` rings around the owner: an ``explode``
    of a literal offset array and a range filter, no join."""
    tw, th = tile
    ntx, nty = -(-grid.nx // tw), -(-grid.ny // th)
    cands = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"))
            for a in _offsets(ntx, tw, halo)
            for b in _offsets(nty, th, halo)
        ]
    )
    ti = F.call_function("div", F.col("i"), F.lit(tw)) + F.col("o.a")
    tj = F.call_function("div", F.col("j"), F.lit(th)) + F.col("o.b")
    ex = df.select("*", F.explode(cands).alias("o")).select(
        "*", ti.cast("int").alias("ti"), tj.cast("int").alias("tj")
    )
    keep = (
        (F.col("ti") >= 0)
        & (F.col("ti") < ntx)
        & (F.col("tj") >= 0)
        & (F.col("tj") < nty)
        & (F.col("i") >= F.col("ti") * tw - halo)
        & (F.col("i") < (F.col("ti") + 1) * tw + halo)
        & (F.col("j") >= F.col("tj") * th - halo)
        & (F.col("j") < (F.col("tj") + 1) * th + halo)
    )
    return ex.where(keep).drop("o")


def run_steps(
    u: np.ndarray,
    src: np.ndarray,
    interior: np.ndarray | None,
    coeff: float,
    keep_slice: tuple[slice, slice] = (slice(None), slice(None)),
) -> np.ndarray:
    """``len(src)`` steps on a dense array; returns ``u[keep_slice]`` after
    each step (shape ``(k, ...)``).

    Cells outside the array count as 0.  With ``interior`` given (``fixed``
    rule), cells outside the mask keep their value and take no source.
    """
    k = src.shape[0]
    out = np.empty((k,) + u[keep_slice].shape, dtype=np.float64)
    keep = 1.0 - 4.0 * coeff
    for m in range(k):
        nb = np.zeros_like(u)
        nb[1:, :] += u[:-1, :]
        nb[:-1, :] += u[1:, :]
        nb[:, 1:] += u[:, :-1]
        nb[:, :-1] += u[:, 1:]
        new = keep * u + coeff * nb + src[m]
        if interior is not None:
            new = np.where(interior, new, u)
        u = new
        out[m] = u[keep_slice]
    return out


def _tile_fn(grid: GridSpec, spec: FoldSpec, tile, halo: int, k: int, t_prev: int, tick_ms: int):
    nx, ny = grid.nx, grid.ny
    tw, th = tile
    coeff, scale, fixed = float(spec.coeff), float(spec.source_scale), spec.edge == "fixed"

    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cti, ctj = int(key[0]), int(key[1])
        ilo, ihi = max(cti * tw - halo, 0), min((cti + 1) * tw + halo, nx)
        jlo, jhi = max(ctj * th - halo, 0), min((ctj + 1) * th + halo, ny)
        w, h = ihi - ilo, jhi - jlo
        m = pdf["m"].to_numpy()
        ii = pdf["i"].to_numpy() - ilo
        jj = pdf["j"].to_numpy() - jlo
        v = pdf["v"].to_numpy(dtype=np.float64)
        st = m < 0
        u = np.zeros((w, h))
        u[ii[st], jj[st]] = v[st]
        src = np.zeros((k, w, h))
        np.add.at(src, (m[~st], ii[~st], jj[~st]), v[~st] * scale)
        interior = None
        if fixed:
            gi = np.arange(ilo, ihi)
            gj = np.arange(jlo, jhi)
            interior = ((gi > 0) & (gi < nx - 1))[:, None] & ((gj > 0) & (gj < ny - 1))[None, :]
            src = src * interior[None, :, :]
        oi0, oi1 = cti * tw - ilo, min((cti + 1) * tw, nx) - ilo
        oj0, oj1 = ctj * th - jlo, min((ctj + 1) * th, ny) - jlo
        own = run_steps(u, src, interior, coeff, (slice(oi0, oi1), slice(oj0, oj1)))
        ow, oh = own.shape[1], own.shape[2]
        ticks = t_prev + tick_ms * np.arange(1, k + 1, dtype=np.int64)
        return pd.DataFrame(
            {
                "tick": np.repeat(ticks, ow * oh),
                "i": np.tile(np.repeat(np.arange(ilo + oi0, ilo + oi1, dtype=np.int32), oh), k),
                "j": np.tile(np.arange(jlo + oj0, jlo + oj1, dtype=np.int32), k * ow),
                "u": own.reshape(-1),
            }
        )

    return fn


def advance_tiles(
    state: DataFrame,
    sources: DataFrame,
    t_prev: int,
    k: int,
    grid: GridSpec,
    spec: FoldSpec,
    tick_ms: int,
    tile: tuple[int, int],
) -> DataFrame:
    """States of ticks ``t_prev + T .. t_prev + k*T`` from a dense state at
    ``t_prev`` and the aligned sources of those ticks (one shuffle)."""
    st = state.select(F.lit(-1).alias("m"), "i", "j", F.col("u").alias("v"))
    src = sources.select(
        F.call_function("div", F.col("tick") - F.lit(t_prev + tick_ms), F.lit(tick_ms)).cast("int").alias("m"),
        "i",
        "j",
        F.coalesce(F.col("f"), F.lit(0.0)).alias("v"),  # a missing value counts as 0
    ).where(
        (F.col("m") >= 0)
        & (F.col("m") < k)
        & (F.col("i") >= 0)
        & (F.col("i") < grid.nx)
        & (F.col("j") >= 0)
        & (F.col("j") < grid.ny)
    )
    rows = replicate_to_tiles(st.unionByName(src), grid, tile, k)
    fn = _tile_fn(grid, spec, tile, k, k, t_prev, tick_ms)
    return rows.groupBy("ti", "tj").applyInPandas(fn, OUT_SCHEMA)
