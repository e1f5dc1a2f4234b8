"""Two-sided outer join of keyed tables that both change (update mode).

Each side is a table that grows by upserts: a reading replaces the source of
its cell and tick, and replaces the halo row that it sends to the column
across a stripe edge.  Whenever *either* side of a key changes, the joined row
is emitted anew with a higher version, and the result table keeps the latest
one.  Nothing waits for the other side, and the order in which rows arrive
does not matter: the final table is that of the batch join.

The state of a key is one value for the source and a map of one value per
sending column, in Spark's state store (``transformWithState``): its size is
bounded by the key's columns, not by the number of readings.  With
``keep_ms`` an event-time timer drops a key's state that long after its tick,
which bounds the store; rows of ticks that the watermark has passed are then
dropped (it starts at the epoch, so ticks must be later).

A cell that holds very many of a batch's readings is reduced before the
shuffle: only its newest reading of each Arrow batch goes on.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from gridcast.functions.grid import is_left_stripe_edge, is_right_stripe_edge
from gridcast.functions.ticks import tick_snap, tick_ts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Column that names the source itself among the sending columns.
SOURCE = -1
CHANGE = "tick long, tick_ts timestamp, i int, j int, sender int, time long, seq long, val double"
MERGED = "tick long, i int, j int, f double, version long"


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which
    ``transformWithState`` asks for; others are left as they are."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _newest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    key = ["tick", "i", "j", "sender"]
    for rows in batches:
        yield rows.sort_values(["time", "seq", "val"], na_position="first", kind="stable").drop_duplicates(key, keep="last")


def changes(readings: DataFrame, nx: int, n_stripes: int, tick_ms: int) -> DataFrame:
    """Upserts of both tables from a READINGS stream: a reading's own source
    (``sender`` -1), and its halo rows, keyed by the cell and tick that they
    reach and named by the column that sends them."""
    tick = tick_snap("time", tick_ms)

    def row(edge, di: int, later: int, sender):
        made = F.struct(
            (F.col("tick") + F.lit(later)).alias("tick"),
            (F.col("i") + F.lit(di)).cast("int").alias("i"),
            F.col("j").alias("j"),
            sender.cast("int").alias("sender"),
        )
        return F.when(edge, made)

    left = row(is_left_stripe_edge("i", nx, n_stripes), -1, tick_ms, F.col("i"))
    right = row(is_right_stripe_edge("i", nx, n_stripes), 1, tick_ms, F.col("i"))
    all_ = F.filter(F.array(row(F.lit(True), 0, 0, F.lit(SOURCE)), left, right), lambda r: r.isNotNull())
    rows = readings.withColumn("tick", tick).select(F.explode(all_).alias("r"), "time", "seq", "gen")
    out = rows.select("r.tick", tick_ts("r.tick").alias("tick_ts"), "r.i", "r.j", "r.sender", "time", "seq", F.col("gen").alias("val"))
    return out.mapInPandas(_newest, CHANGE)


class _OuterJoin(StatefulProcessor):
    """A key's newest source and halo values; emits their merge on change."""

    def __init__(self, coeff: float, keep_ms: int | None):
        self.coeff, self.keep_ms = coeff, keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.sides = handle.getMapState("sides", "sender int", "time long, seq long, val double")
        self.version = handle.getValueState("version", "version long")

    def handleInputRows(self, key, rows, timerValues):
        rank = lambda r: tuple((x is not None, x) for x in r)
        changed = False
        for r in rows:
            new, at = (r.time, r.seq, r.val), (r.sender,)
            old = tuple(self.sides.getValue(at)) if self.sides.containsKey(at) else None
            if old is None or rank(new) > rank(old):
                self.sides.updateValue(at, new)
                changed = True
        if not changed:
            return
        held = {k[0]: v[2] for k, v in self.sides.iterator()}
        n = (self.version.get()[0] if self.version.exists() else 0) + 1
        self.version.update((n,))
        if self.keep_ms is not None and n == 1:
            self.handle.registerTimer(key[0] + self.keep_ms)
        halo = sum(held[k] or 0.0 for k in sorted(held) if k != SOURCE)
        yield Row(tick=key[0], i=key[1], j=key[2], f=(held.get(SOURCE) or 0.0) + self.coeff * halo, version=n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.sides.clear()
        self.version.clear()
        return iter(())

    def close(self) -> None:
        pass


def merge_halo_stream(readings: DataFrame, nx: int, n_stripes: int, tick_ms: int, coeff: float, keep_ms: int | None = None, delay_ms: int = 0) -> DataFrame:
    """Every change of ``f' = coalesce(f, 0) + C * halo`` per (tick, i, j), in
    update mode; start the query inside ``rocksdb``."""
    rows = changes(readings, nx, n_stripes, tick_ms)
    mode = "None"
    if keep_ms is not None:
        rows, mode = rows.withWatermark("tick_ts", f"{int(delay_ms)} milliseconds"), "EventTime"
    return rows.groupBy("tick", "i", "j").transformWithState(_OuterJoin(float(coeff), keep_ms), MERGED, "Update", mode)
