"""Streaming tick fold that repairs its history when late readings arrive.

A watermark closes a tick; a reading of a closed tick is late.  Late readings
are kept in a side table and change the stored history: the difference that
they make to their cell's source is folded through its dependency cone
(``plans.cone``), up to the newest folded tick.

Everything is stored by epoch (the micro-batch number of Spark's checkpoint),
as a log whose folders a replayed epoch writes again with the same rows:

* ``parts``  sums, counts and newest reading per (tick, i, j) of the epoch
* ``late``   the epoch's late readings
* ``base``   the states of the ticks that the epoch closed
* ``fixes``  changes of states of ticks closed by earlier epochs
* ``done``   one row: newest tick seen, first and last folded tick

A state is its base plus the sum of its fixes.  An epoch reads only what
earlier epochs wrote (and its own ``parts``), so it may be replayed at any
point, and no file of another epoch is rewritten: blocks that a late reading
does not reach stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import DUP_POLICIES, FoldSpec, GridSpec, scratch_path
from gridcast.functions.grid import in_domain
from gridcast.operators.align import with_tick
from gridcast.operators.densify import densify_state
from gridcast.plans.cone import CHANGE_DDL, cone_changes
from gridcast.plans.fold import CHAIN_STEPS, advance
from gridcast.sources.readings import grid_scaffold
from gridcast.sources.store import Layout, _fs_exists, drop_scratch, write_states

PARTS_DDL = "tick long, i int, j int, s double, n long, newest struct<time:long,seq:long,gen:double>, epoch long"
DONE_DDL = "newest long, first long, last long, epoch long"
LATE_DDL = "seq long, time long, i int, j int, gen double, tick long, epoch long"


@dataclass(frozen=True)
class LateFold:
    """A repaired fold's tables under ``path``."""

    spark: SparkSession
    path: str
    grid: GridSpec
    spec: FoldSpec
    tick_ms: int
    delay_ms: int
    dup: str = "avg"

    def __post_init__(self):
        if self.dup not in DUP_POLICIES:
            raise ValueError(f"dup must be one of {DUP_POLICIES}")

    def _table(self, name: str, schema: str) -> DataFrame:
        where = f"{self.path}/{name}"
        if not _fs_exists(self.spark, where):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(where)

    def late(self) -> DataFrame:
        """The side table: late readings with their tick and epoch."""
        return self._table("late", LATE_DDL)

    def _aligned(self, before: int) -> DataFrame:
        """``tick, i, j, f`` of all readings of the epochs before ``before``."""
        parts = self._table("parts", PARTS_DDL).where(F.col("epoch") < F.lit(before))
        value = {"avg": F.sum("s") / F.sum("n"), "sum": F.sum("s"), "last": F.max("newest")["gen"]}[self.dup]
        return parts.groupBy("tick", "i", "j").agg(value.alias("f"))

    def _states(self, before: int) -> DataFrame:
        """``tick, i, j, u`` with the fixes of the epochs before ``before``."""
        rows = None
        for name, deep in (("base", "tick_block long"), ("fixes", "chain long")):
            found = self._table(name, f"{CHANGE_DDL}, epoch long, {deep}").where(F.col("epoch") < F.lit(before)).select("tick", "i", "j", "u")
            rows = found if rows is None else rows.unionByName(found)
        return rows

    def history(self, before: int | None = None) -> DataFrame:
        """Every state ``(tick, i, j, u)`` as it stands: of the epochs that
        are done, or of those before ``before``."""
        if before is None:
            before = (self._table("done", DONE_DDL).agg(F.max("epoch")).first()[0] or 0) + 1
        return self._states(before).groupBy("tick", "i", "j").agg(F.sum("u").alias("u"))

    def done(self, before: int) -> tuple[int | None, int | None, int | None]:
        """Newest tick seen, first and last folded tick before an epoch."""
        rows = self._table("done", DONE_DDL).where(F.col("epoch") < F.lit(before))
        row = rows.orderBy(F.desc("epoch")).first()
        return (row["newest"], row["first"], row["last"]) if row else (None, None, None)

    def _zeros(self, first: int, last: int, epoch: int) -> None:
        """Zero states of ticks that a late reading puts before the first."""
        ticks = F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"), F.lit(self.tick_ms).cast("long")))
        rows = grid_scaffold(self.spark, self.grid).select(ticks.alias("tick"), "i", "j", F.lit(0.0).alias("u"))
        rows.write.mode("overwrite").parquet(f"{self.path}/base/epoch={epoch}/tick_block=-1")

    def _repair(self, epoch: int, staged: DataFrame, last: int) -> int | None:
        """Fold what the epoch's late readings change; their first tick."""
        late = staged.where(F.col("tick") <= F.lit(last))
        late.select("seq", "time", "i", "j", "gen", "tick").write.mode("overwrite").parquet(f"{self.path}/late/epoch={epoch}")
        late = self.late().where(F.col("epoch") == F.lit(epoch))
        first, upto = late.agg(F.min("tick"), F.max("tick")).first()
        if first is None:
            return None
        keys = late.select("tick", "i", "j").distinct()
        of = lambda before: self._aligned(before).where(F.col("tick").between(F.lit(first), F.lit(upto))).join(keys, ["tick", "i", "j"], "left_semi")
        old, new = of(epoch).select("tick", "i", "j", (-F.col("f")).alias("f")), of(epoch + 1)
        differ = new.unionByName(old).groupBy("tick", "i", "j").agg(F.sum("f").alias("f"))
        path = scratch_path(self.spark, "late-differences")
        differ.write.parquet(path)
        try:
            rows = self.spark.read.schema("tick long, i int, j int, f double").parquet(path)
            changed = lambda lo, hi: rows.where(F.col("tick").between(F.lit(lo), F.lit(hi)))
            cone_changes(self.spark, changed, first, last, self.grid, self.spec, self.tick_ms, f"{self.path}/fixes/epoch={epoch}")
        finally:
            drop_scratch(self.spark, path)
        return first

    def batch(self, batch: DataFrame, epoch: int) -> None:
        """The ``foreachBatch`` body."""
        spark, t = self.spark, self.tick_ms
        stage = scratch_path(spark, "late-batch")
        with_tick(batch, t).select("seq", "time", "i", "j", "gen", "tick").where(in_domain("i", "j", self.grid)).write.parquet(stage)
        try:
            rows = spark.read.schema("seq long, time long, i int, j int, gen double, tick long").parquet(stage)
            newest = F.max(F.struct("time", "seq", "gen"))
            sums = rows.groupBy("tick", "i", "j").agg(F.sum("gen").alias("s"), F.count("*").alias("n"), newest.alias("newest"))
            sums.write.mode("overwrite").parquet(f"{self.path}/parts/epoch={epoch}")
            seen, first, last = self.done(epoch)
            top = rows.agg(F.max("tick")).first()[0]
            seen = max((x for x in (seen, top) if x is not None), default=None)
            if seen is None:
                return
            if last is not None:
                earliest = self._repair(epoch, rows, last)
                if earliest is not None and earliest < first:
                    self._zeros(earliest - t, first - 2 * t, epoch)
                    first = earliest
            closed = (seen - self.delay_ms) // t * t
            start = first if last is not None else self._aligned(epoch + 1).agg(F.min("tick")).first()[0]
            prev = last if last is not None else start - t
            if closed > prev:
                base = f"{self.path}/base/epoch={epoch}"
                if last is None:
                    state = densify_state(spark, None, self.grid)
                    write_states(state.withColumn("tick", F.lit(prev).cast("long")), base, prev, prev, Layout(start, t, CHAIN_STEPS), sole=True)
                else:
                    # its own fixes count: they end at the last folded tick
                    state = self.history(epoch + 1).where(F.col("tick") == F.lit(last)).select("i", "j", "u")
                source = self._aligned(epoch + 1)
                between = lambda lo, hi: source.where(F.col("tick").between(F.lit(lo), F.lit(hi)))
                advance(spark, state, prev, closed, between, self.grid, self.spec, t, base, method="step", sole=True)
                first, last = start, closed
            record = spark.createDataFrame([(seen, first, last)], "newest long, first long, last long")
            record.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/done/epoch={epoch}")
        finally:
            drop_scratch(spark, stage)
