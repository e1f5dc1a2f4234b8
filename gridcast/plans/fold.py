"""The tick fold: carry the grid state forward over a regular tick sequence.

The recurrence ``u_t = step(u_{t-T}) + f_t`` depends on four neighbours'
previous values, so no SQL window can express it; it is a driver loop over
tick *metadata* (first and last tick), each iteration a distributed job.

Two physical forms share one contract (``(tick, i, j, u)`` history written
to a tick-partitioned table, initial state included at ``first - T``):

* ``method="step"``: ``CHAIN_STEPS`` neighbour steps per job, each one
  ``inline`` + grouped sum (one shuffle per tick), pure DataFrame; the ticks
  of a chain are written in one job and the last is read back, which cuts
  the lineage.
* ``method="tiled"``: ``k`` ticks per shuffle.  Cells are grouped into
  rectangular tiles plus a ``k``-wide halo, each tile runs ``k`` steps on a
  dense array in ``applyInPandas``, and only owned cells are kept (see
  :mod:`gridcast.plans.tiled`).

``method="auto"``, the default, takes tiles wherever there are several.  A
grid of one tile (up to 128 x 128 cells) is folded by the relational form, so
that no task holds the whole grid; ``"tiled"`` can be asked for there: it is
faster by the stage overhead of each step, on one core.

Sources are the aligned readings; ticks without readings are steps with
source 0.  The aligned rows are written once to the shared scratch area,
partitioned by blocks of ticks; the tick range and the rows outside the grid
come from the written copy, each round reads only the blocks it overlaps,
and the copy is removed when the fold ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import FoldSpec, GridSpec, scratch_path
from gridcast.functions.grid import in_domain
from gridcast.operators.densify import densify_state
from gridcast.operators.stencil import chained_steps
from gridcast.plans import tiled
from gridcast.sources.store import Layout, drop_scratch, ensure_layout, read_states, read_tick, write_states, write_tick


@dataclass
class FoldResult:
    path: str
    first_tick: int
    last_tick: int
    tick_ms: int

    def history(self, spark: SparkSession) -> DataFrame:
        return read_states(spark, self.path)

    def final(self, spark: SparkSession) -> DataFrame:
        return read_tick(spark, self.path, self.last_tick).select(
            F.lit(self.last_tick).cast("long").alias("tick"), "i", "j", "u"
        )


def plan_rounds(
    spark: SparkSession,
    grid: GridSpec,
    n_steps: int,
    method: str,
    tile: tuple[int, int] | None = None,
    steps_per_round: int | None = None,
) -> tuple[str, tuple[int, int], int]:
    """Method, tile shape and steps per round (one job per round).

    ``"auto"`` takes tiles where the default tiles (or the caller's own) are
    several, and the relational form on a grid that would be one tile: its
    whole history would else be computed by one task.
    """
    if method not in ("auto", "tiled", "step"):
        raise ValueError("method must be 'auto', 'tiled' or 'step'")
    own = tile is not None
    tile = tile or tiled.default_tile(grid, spark.sparkContext.defaultParallelism)
    if method == "auto":
        method = "step" if not own and tile[0] >= grid.nx and tile[1] >= grid.ny else "tiled"
        if method == "step":  # a long round of tiles would be a long plan
            steps_per_round = min(steps_per_round or CHAIN_STEPS, CHAIN_STEPS)
    if method == "step":
        return method, (grid.nx, grid.ny), max(1, min(n_steps, steps_per_round or CHAIN_STEPS))
    return method, tile, tiled.round_length(grid, tile, steps_per_round, max(n_steps, 1))


# Ticks per block of the staged sources, counted from time 0.
STAGE_BLOCK_TICKS = 64
# Cells per file of a staged block.
STAGE_CHUNK_CELLS = 1 << 20
# Steps per job of the relational form.
CHAIN_STEPS = 8


@dataclass
class StagedSources:
    """Aligned rows written once to the shared scratch area, partitioned by
    blocks of ticks; ``first`` and ``last`` are their ticks (None without
    rows) and ``outside`` counts the rows outside the grid."""

    spark: SparkSession
    path: str
    span: int
    first: int | None = None
    last: int | None = None
    outside: int = 0

    def rows(self) -> DataFrame:
        return self.spark.read.schema("tick long, i int, j int, f double, blk long").parquet(self.path)

    def read(self, lo: int, hi: int) -> DataFrame:
        """Rows of ticks ``lo..hi``: only the overlapping blocks are read."""
        blocks = F.col("blk").between(F.lit(lo // self.span), F.lit(hi // self.span))
        return self.rows().where(blocks & F.col("tick").between(F.lit(lo), F.lit(hi))).select("tick", "i", "j", "f")

    def drop(self) -> None:
        drop_scratch(self.spark, self.path, created_here=True)


def stage_sources(spark: SparkSession, aligned: DataFrame, grid: GridSpec, tick_ms: int, path: str | None = None) -> StagedSources:
    """Write the aligned rows once, partitioned by tick block and dealt by
    block and chunk of cells: the files of a block are as many as its chunks,
    whatever the number of tasks.  Sorted by tick inside each file, so a
    round's tick filter also prunes row groups."""
    path = path or scratch_path(spark, "aligned")
    staged = StagedSources(spark, path, STAGE_BLOCK_TICKS * tick_ms)
    blk = F.floor(F.col("tick") / F.lit(staged.span)).cast("long")
    chunk = F.call_function("div", F.col("i") * F.lit(grid.ny) + F.col("j"), F.lit(STAGE_CHUNK_CELLS))
    (
        aligned.select("tick", "i", "j", "f")
        .withColumn("blk", blk)
        .repartition(F.col("blk"), chunk)
        .sortWithinPartitions("blk", "tick", "i", "j")
        .write.mode("overwrite")
        .partitionBy("blk")
        .parquet(path)
    )
    inside = F.coalesce(in_domain("i", "j", grid), F.lit(False))
    row = staged.rows().agg(F.min("tick").alias("a"), F.max("tick").alias("b"), F.count_if(~inside).alias("n")).first()
    if row["a"] is not None:
        staged.first, staged.last, staged.outside = int(row["a"]), int(row["b"]), int(row["n"])
    return staged


def reject_outside(staged: StagedSources, grid: GridSpec, rejects: str | None) -> None:
    """Rows outside the grid go to the table ``rejects``, or the fold fails:
    they are never dropped silently."""
    if not staged.outside:
        return
    if rejects is None:
        staged.drop()
        raise ValueError(f"{staged.outside} aligned rows lie outside the {grid.nx} x {grid.ny} grid; name a table for them or filter them first")
    inside = F.coalesce(in_domain("i", "j", grid), F.lit(False))
    staged.rows().where(~inside).select("tick", "i", "j", "f").write.mode("append").parquet(rejects)


def store_layout(first: int, tick_ms: int, k: int) -> Layout:
    """A stored block holds the ticks of one round: every tile (or task)
    writes one sorted file of its own per round, with no further shuffle."""
    return Layout(first, tick_ms, k)


def tick_fold(
    spark: SparkSession,
    aligned: DataFrame,
    grid: GridSpec,
    spec: FoldSpec,
    tick_ms: int,
    out_path: str | None = None,
    initial: DataFrame | None = None,
    bounds: tuple[int, int] | None = None,
    method: str = "auto",
    steps_per_round: int | None = None,
    tile: tuple[int, int] | None = None,
    include_initial: bool = True,
    rejects: str | None = None,
) -> FoldResult | None:
    """Fold ``aligned`` (tick, i, j, f) over the grid; return where it went.

    ``initial`` is an optional ``(i, j, u)`` state before the first tick
    (missing cells are 0).  ``bounds`` overrides the (first, last) tick.
    Rows outside the grid fail the fold, or go to the table ``rejects``.
    Returns None when there is no reading and no bound.
    """
    staged = stage_sources(spark, aligned, grid, tick_ms)
    try:
        reject_outside(staged, grid, rejects)
        if bounds is None and staged.first is None:
            return None
        first, last = bounds or (staged.first, staged.last)
        n_steps = (last - first) // tick_ms + 1
        method, tile, k = plan_rounds(spark, grid, n_steps, method, tile, steps_per_round)
        sole = out_path is None  # a new table is filled in tick order by this fold alone
        out_path = out_path or scratch_path(spark, "fold")
        ensure_layout(spark, out_path, store_layout(first, tick_ms, k))
        state = densify_state(spark, initial, grid)
        prev = first - tick_ms
        if include_initial:
            write_tick(state, out_path, prev, sole=sole)
            state = read_tick(spark, out_path, prev)
        advance(spark, state, prev, last, staged.read, grid, spec, tick_ms, out_path, method, tile, k, sole)
        return FoldResult(out_path, first, last, tick_ms)
    finally:
        staged.drop()  # intermediate copy of the sources


def advance(
    spark: SparkSession,
    state: DataFrame,
    prev_tick: int,
    last_tick: int,
    sources,
    grid: GridSpec,
    spec: FoldSpec,
    tick_ms: int,
    out_path: str,
    method: str = "auto",
    tile: tuple[int, int] | None = None,
    k: int | None = None,
    sole: bool = False,
) -> None:
    """Advance a dense ``(i, j, u)`` state at ``prev_tick`` up to ``last_tick``,
    writing every tick to ``out_path``.  ``sources(lo, hi)`` returns the
    aligned rows of ticks ``lo..hi``; rounds of ``k`` ticks start at
    ``prev_tick + T``."""
    n_steps = (last_tick - prev_tick) // tick_ms
    if n_steps <= 0:
        return
    if method == "auto" or tile is None or k is None:
        method, tile, k = plan_rounds(spark, grid, n_steps, method, tile, k)
    ensure_layout(spark, out_path, store_layout(prev_tick + tick_ms, tick_ms, k))
    done = 0
    while done < n_steps:
        m = min(k, n_steps - done)
        t_prev = prev_tick + done * tick_ms
        src = sources(t_prev + tick_ms, t_prev + m * tick_ms)
        if method == "step":
            out = chained_steps(state, src, t_prev + tick_ms, m, tick_ms, grid, spec)
        else:
            out = tiled.advance_tiles(state, src, t_prev, m, grid, spec, tick_ms, tile)
        write_states(out, out_path, t_prev + tick_ms, t_prev + m * tick_ms, sole=sole)
        done += m
        state = read_tick(spark, out_path, prev_tick + done * tick_ms)
