"""A history laid out by cells: all ticks of a rectangle from few files.

The state table is laid out by ticks, so the history of one cell touches all
of its blocks.  This copy is partitioned by square blocks of cells (``bi``,
``bj``) and by long spans of ticks; inside a file rows follow the Morton order
of the cells, then the tick, so that a row group covers a compact square and
its minima and maxima of ``i`` and ``j`` prune it.

A reader's rectangle becomes range filters on the partition columns: no list
of blocks reaches the driver, and the files opened are those of the blocks
that the rectangle touches, times the spans of the tick range.

One shuffle deals the rows by (block, span); a group has ``side * side *
span_ticks`` rows, whatever the grid or the number of ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS_DDL = "tick long, i int, j int, u double, span long, bi int, bj int"
#: Cells a side of a block, and ticks of a span.
SIDE, SPAN_TICKS = 64, 1024


def morton(i: str | Column, j: str | Column, bits: int = 16) -> Column:
    """Bits of ``i`` and ``j`` interleaved (those of ``i`` above): cells near
    each other in both directions get near numbers.  Negative indexes are not
    defined."""
    i, j = (F.col(c) if isinstance(c, str) else c for c in (i, j))

    def bit(c: Column, b: int) -> Column:
        return F.shiftright(c, b).bitwiseAND(F.lit(1)).cast("long")

    code = F.lit(0).cast("long")
    for b in range(bits):
        code = code.bitwiseOR(F.shiftleft(bit(i, b), 2 * b + 1)).bitwiseOR(F.shiftleft(bit(j, b), 2 * b))
    return code


def _block(c: str, side: int) -> Column:
    return F.floor(F.col(c) / F.lit(side)).cast("int")


def write_cells(history: DataFrame, path: str, tick_ms: int, side: int = SIDE, span_ticks: int = SPAN_TICKS) -> None:
    """Write ``(tick, i, j, u)`` rows by blocks of cells.  Blocks and spans
    that ``history`` touches are replaced, so they must come whole."""
    rows = history.select(
        "tick", "i", "j", "u",
        F.floor(F.col("tick") / F.lit(span_ticks * tick_ms)).cast("long").alias("span"),
        _block("i", side).alias("bi"),
        _block("j", side).alias("bj"),
    )
    inner = morton(F.pmod("i", F.lit(side)), F.pmod("j", F.lit(side)), max(1, (side - 1).bit_length()))
    (
        rows.repartition("span", "bi", "bj")
        .sortWithinPartitions("span", "bi", "bj", inner, "tick")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("span", "bi", "bj")
        .parquet(path)
    )


def history_of_rectangle(
    spark: SparkSession,
    path: str,
    i: tuple[int, int],
    j: tuple[int, int],
    tick_ms: int,
    ticks: tuple[int | None, int | None] = (None, None),
    side: int = SIDE,
    span_ticks: int = SPAN_TICKS,
) -> DataFrame:
    """``(tick, i, j, u)`` of the cells ``i[0]..i[1]`` by ``j[0]..j[1]`` over
    all ticks, or over ``ticks[0]..ticks[1]`` (either may be open)."""
    rows = spark.read.schema(CELLS_DDL).parquet(path)
    for c, b, (lo, hi) in (("i", "bi", i), ("j", "bj", j)):
        rows = rows.where(F.col(b).between(F.lit(lo // side), F.lit(hi // side)) & F.col(c).between(F.lit(lo), F.lit(hi)))
    width = span_ticks * tick_ms
    if ticks[0] is not None:
        rows = rows.where((F.col("span") >= F.lit(ticks[0] // width)) & (F.col("tick") >= F.lit(ticks[0])))
    if ticks[1] is not None:
        rows = rows.where((F.col("span") <= F.lit(ticks[1] // width)) & (F.col("tick") <= F.lit(ticks[1])))
    return rows.select("tick", "i", "j", "u")
