"""Streaming fold in Spark's state store: one key per block of cells.

A block's state (``transformWithState``) is its cells with a halo of ``k``
cells around them.  It folds up to ``k`` ticks by itself, each as soon as the
watermark has closed it (an event-time timer, so that ticks without readings
pass too).  After ``k`` ticks the halo is used up: the block sends its rim as
halo rows, and goes on once the rims of all its neighbours at that same tick
have come.  Halo rows are written by the running query and are one of its own
input streams, so results feed the next ticks and nothing but the blocks on
either side of a border waits for it.

State of a key: the extended block at the current tick, the frame of the next
barrier tick as far as it has come, and the sources of the ticks not folded
yet.  The first two are bounded by the block's shape; the third holds one
value per cell and tick between the folded tick and the watermark.  A block is
at most one barrier ahead of its neighbours.

The output is a folder by kind and epoch: ``kind=state`` is the history,
``kind=halo`` the feedback.  A replayed epoch writes its own folders again;
halo rows that come twice change nothing.  The initial state (zero, or given)
is the first halo input and names the tick before ``first``.  Readings outside
the grid or before ``first`` end the query with an error; late ones are dropped
by the watermark, which starts at the epoch: ticks must be later.  Of the
output only the history is read again; old ``kind=halo`` folders may be removed
once their epoch is committed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from gridcast.config import FoldSpec, GridSpec
from gridcast.operators.densify import densify_state
from gridcast.plans.tiled import default_tile, replicate_to_tiles, round_length, run_steps
from gridcast.streaming.sinks import drain, to_batches
from gridcast.streaming.tables import rocksdb
from gridcast.streaming.windows import closed_ticks

OUT = "kind string, tick long, i int, j int, u double"
STATE = "tick long, i int, j int, u double"
#: Timer of a block that got rows: due as soon as there is a watermark.
AT_ONCE = 1


class _Block(StatefulProcessor):
    """Folds one block; see the module's text."""

    def __init__(self, grid: GridSpec, spec: FoldSpec, tile: tuple[int, int], k: int, tick_ms: int, first: int):
        self.grid, self.spec, self.tile, self.k, self.tick_ms, self.first = grid, spec, tile, k, tick_ms, first

    def init(self, handle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "base long, done int, u binary")
        self.frames = handle.getMapState("frames", "tick long", "u binary, got binary")
        self.sources = handle.getMapState("sources", "tick long", "cell binary, f binary")

    def _place(self, key) -> None:
        """Extended and owned range of the block ``key``."""
        (ti, tj), (tw, th), k = (int(x) for x in key), self.tile, self.k
        nx, ny = self.grid.nx, self.grid.ny
        self.i0, self.j0 = max(ti * tw - k, 0), max(tj * th - k, 0)
        self.shape = (min((ti + 1) * tw + k, nx) - self.i0, min((tj + 1) * th + k, ny) - self.j0)
        self.own = (
            slice(ti * tw - self.i0, min((ti + 1) * tw, nx) - self.i0),
            slice(tj * th - self.j0, min((tj + 1) * th, ny) - self.j0),
        )
        self.inner = None
        if self.spec.edge == "fixed":
            i = np.arange(self.i0, self.i0 + self.shape[0])
            j = np.arange(self.j0, self.j0 + self.shape[1])
            self.inner = ((i > 0) & (i < nx - 1))[:, None] & ((j > 0) & (j < ny - 1))[None, :]

    def _frame(self, tick: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.frames.containsKey((tick,)):
            return np.zeros(self.shape), np.zeros(self.shape, dtype=bool)
        u, got = self.frames.getValue((tick,))
        return (
            np.frombuffer(bytes(u)).reshape(self.shape).copy(),
            np.frombuffer(bytes(got), dtype=bool).reshape(self.shape).copy(),
        )

    def _keep_frame(self, tick: int, u: np.ndarray, got: np.ndarray) -> None:
        self.frames.updateValue((tick,), (u.tobytes(), got.tobytes()))

    def handleInputRows(self, key, rows, timerValues):
        self._place(key)
        base = self.now.get()[0] if self.now.exists() else self.first - 2 * self.tick_ms
        for pdf in rows:
            is_state = pdf["is_state"].to_numpy(dtype=bool)
            for tick, part in pdf[is_state & (pdf["tick"].to_numpy() > base)].groupby("tick"):
                u, got = self._frame(int(tick))
                at = (part["i"].to_numpy() - self.i0, part["j"].to_numpy() - self.j0)
                u[at], got[at] = part["v"].to_numpy(dtype=np.float64), True
                self._keep_frame(int(tick), u, got)
            for tick, part in pdf[~is_state].groupby("tick"):
                cell = ((part["i"].to_numpy() - self.i0) * self.shape[1] + part["j"].to_numpy() - self.j0).astype(np.int64)
                f = part["v"].to_numpy(dtype=np.float64)
                at = (int(tick),)
                old = self.sources.getValue(at) if self.sources.containsKey(at) else (b"", b"")
                self.sources.updateValue(at, (bytes(old[0]) + cell.tobytes(), bytes(old[1]) + f.tobytes()))
        # rows of a key may come in several pieces: fold when all are there
        self.handle.registerTimer(AT_ONCE)
        return iter(())

    def _source(self, tick: int) -> np.ndarray:
        """The source of a closed tick; its state is no longer needed."""
        src = np.zeros(self.shape)
        if self.sources.containsKey((tick,)):
            cell, f = self.sources.getValue((tick,))
            np.add.at(src.reshape(-1), np.frombuffer(bytes(cell), dtype=np.int64), np.frombuffer(bytes(f)) * float(self.spec.source_scale))
            self.sources.removeKey((tick,))
        return src if self.inner is None else src * self.inner

    def _rows(self, kind: str, ticks: list[int], u: np.ndarray, pick: np.ndarray | None = None) -> pd.DataFrame:
        """Owned values (``u`` has one layer per tick) where ``pick`` holds."""
        pick = np.ones(u.shape[1:], dtype=bool) if pick is None else pick
        i, j = np.nonzero(pick)
        return pd.DataFrame(
            {
                "kind": kind,
                "tick": np.repeat(np.array(ticks, dtype=np.int64), len(i)),
                "i": np.tile((i + self.i0 + self.own[0].start).astype(np.int32), len(ticks)),
                "j": np.tile((j + self.j0 + self.own[1].start).astype(np.int32), len(ticks)),
                "u": u[:, i, j].reshape(-1),
            }
        )

    def _rim(self) -> np.ndarray:
        """Owned cells that lie in a neighbour's halo."""
        k, (a, b) = self.k, self.own
        i = np.arange(self.i0 + a.start, self.i0 + a.stop)
        j = np.arange(self.j0 + b.start, self.j0 + b.stop)
        near_i = ((i < i[0] + k) & (i[0] > 0)) | ((i > i[-1] - k) & (i[-1] < self.grid.nx - 1))
        near_j = ((j < j[0] + k) & (j[0] > 0)) | ((j > j[-1] - k) & (j[-1] < self.grid.ny - 1))
        return near_i[:, None] | near_j[None, :]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._place(key)
        closed, T, k = timerValues.getCurrentWatermarkInMs(), self.tick_ms, self.k
        base, done, u = self.first - T - k * T, k, None  # a new block waits for the initial state
        if self.now.exists():
            base, done, u = self.now.get()
            u = np.frombuffer(bytes(u)).reshape(self.shape)
        while True:
            if done == k:
                u_next, got = self._frame(base + k * T)
                if not got.all():
                    break  # rims of the neighbours are still to come; they bring a timer
                if not self.now.exists():
                    yield self._rows("state", [base + k * T], u_next[self.own][None])
                base, done, u = base + k * T, 0, u_next
                self.frames.removeKey((base,))
                self.now.update((base, done, u.tobytes()))
            until = min(k, (closed - base) // T)
            if until <= done:
                due = base + (done + 1) * T
                # a timer is due before or at the watermark, whichever Spark takes
                self.handle.registerTimer(due if closed >= due - 1 else due - 1)
                break
            ticks = [base + m * T for m in range(done + 1, until + 1)]
            layers = run_steps(u, np.stack([self._source(t) for t in ticks]), self.inner, float(self.spec.coeff))
            own = layers[(slice(None), *self.own)]
            yield self._rows("state", ticks, own)
            u, done = layers[-1], until
            if done == k:
                frame, got = self._frame(ticks[-1])
                frame[self.own], got[self.own] = own[-1], True
                self._keep_frame(ticks[-1], frame, got)
                yield self._rows("halo", ticks[-1:], own[-1:], self._rim())
            self.now.update((base, done, np.ascontiguousarray(u).tobytes()))

    def close(self) -> None:
        pass


class BlockFold:
    """The streaming fold by blocks into ``out`` (see the module's text).

    ``tile`` is the block's shape and ``steps`` the ticks between two
    exchanges of halo rows (the width of the halo); both, the grid and
    ``first`` must stay the same over restarts."""

    def __init__(self, spark: SparkSession, out: str, grid: GridSpec, spec: FoldSpec, tick_ms: int, first: int, steps: int = 8, tile: tuple[int, int] | None = None):
        self.spark, self.out, self.grid, self.spec, self.tick_ms, self.first = spark, out.rstrip("/"), grid, spec, tick_ms, first
        self.tile = tile or default_tile(grid)
        self.steps = round_length(grid, self.tile, steps, steps)

    def seed(self, state: DataFrame | None = None) -> None:
        """Write the initial state ``(i, j, u)`` (missing cells are 0), once
        for a new ``out``; written again it replaces itself."""
        dense = densify_state(self.spark, state, self.grid)
        rows = dense.select(F.lit("halo").alias("kind"), F.lit(self.first - self.tick_ms).cast("long").alias("tick"), "i", "j", "u")
        self._write(rows, -1)

    def _write(self, rows: DataFrame, epoch: int) -> None:
        out = rows.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite")
        out.option("partitionOverwriteMode", "dynamic").partitionBy("kind", "epoch").parquet(self.out)

    def frames(self, readings: DataFrame, delay_ms: int, dup: str) -> DataFrame:
        """Rows ``(kind, tick, i, j, u)`` of a READINGS stream and the halo
        rows written so far; start the query inside ``rocksdb``."""
        f, (tw, th) = F.coalesce(F.col("f"), F.lit(0.0)), self.tile
        closed = closed_ticks(readings, self.tick_ms, delay_ms, dup)
        inside = F.col("i").between(0, self.grid.nx - 1) & F.col("j").between(0, self.grid.ny - 1) & (F.col("tick") >= self.first)
        i = F.when(inside, F.col("i")).otherwise(F.raise_error(F.lit("reading outside the grid or before the first tick")).cast("int"))
        # the column that deals rows to blocks is the check, so nothing can be dropped before it
        closed = closed.select(F.lit(False).alias("is_state"), "tick", i.alias("i"), "j", f.alias("v"))
        closed = replicate_to_tiles(closed, self.grid, self.tile, self.steps)
        fed = self.spark.readStream.schema(STATE).parquet(f"{self.out}/kind=halo")
        fed = fed.select(F.lit(True).alias("is_state"), "tick", "i", "j", F.col("u").alias("v"))
        fed = replicate_to_tiles(fed, self.grid, self.tile, self.steps)
        owner = (F.col("ti") == F.call_function("div", F.col("i"), F.lit(tw))) & (F.col("tj") == F.call_function("div", F.col("j"), F.lit(th)))
        fed = fed.where(~owner | (F.col("tick") == F.lit(self.first - self.tick_ms)))
        block = _Block(self.grid, self.spec, self.tile, self.steps, self.tick_ms, self.first)
        return closed.unionByName(fed).groupBy("ti", "tj").transformWithStateInPandas(block, OUT, "Append", "EventTime")

    def start(self, readings: DataFrame, checkpoint: str, delay_ms: int, dup: str = "last", trigger: str = "0 seconds"):
        """The running query.  Its own halo rows are input, so it takes a
        processing-time trigger; ``drain`` ends it where no more can be folded."""
        with rocksdb(self.spark):
            return to_batches(self.frames(readings, delay_ms, dup), self._write, checkpoint, trigger=trigger)

    def drain(self, readings: DataFrame, checkpoint: str, delay_ms: int, dup: str = "last") -> None:
        """Fold what the input holds, then stop."""
        query = self.start(readings, checkpoint, delay_ms, dup)
        try:
            drain(query)
        finally:
            query.stop()

    def history(self) -> DataFrame:
        """All folded ticks ``(tick, i, j, u)``, the initial state included."""
        return self.spark.read.schema(STATE).parquet(f"{self.out}/kind=state")
