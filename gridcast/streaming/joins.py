"""Stream-stream join of keyed rows within a time range.

The streaming form of ``operators.ranges.range_join``: keys are equal and the
right event time lies in ``[left - before, left + after]``.  Both sides carry
a watermark on their time column, so Spark keeps a row only as long as a
partner can still come: a left row until the watermark passes ``left +
after``, a right row until it passes ``right + before``.  An outer join emits
an unmatched row when its state goes, once and never earlier.

Spark tries a row against every kept row of equal join keys, so time is part
of them: buckets as wide as the range, a left row in the two that its range
touches, a right row in its own.  This join finds every pair once, and the
right rows without any.  A left row stands in two buckets, so a second join
finds the left rows without a partner, each in a single, narrower bucket.
There a right row matters to few left buckets: those that its range only
reaches in part, and those that lie within it as a whole, for which one right
row per narrow bucket stands for all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.streaming.source import delay

HOW = {"inner": "inner", "left": "left_outer", "right": "right_outer", "full": "full_outer"}
#: Narrow buckets in a range, about.
CUTS = 8


def _bucket(micros: Column, width_ms: int) -> Column:
    width = F.lit(width_ms * 1000)
    return F.call_function("div", micros - F.pmod(micros, width), width)


def _opened(column: Column, offsets: list[int]) -> Column:
    """A row per offset of the bucket; a row without a time stays one."""
    return F.explode_outer(F.when(column.isNotNull(), F.array(*[column + F.lit(n) for n in offsets])))


def _to_left_buckets(right: DataFrame, on: tuple[str, ...], time: str, before_ms: int, after_ms: int) -> DataFrame:
    """Keys and times of right rows in the narrow left buckets ``_bucket`` that
    they decide."""
    width = max((before_ms + after_ms) // CUTS, 1)
    up, down = before_ms // width, after_ms // width
    part = sorted({up, -(-before_ms // width), -down, after_ms // -width})
    whole = list(range(1 - down, up))
    times = right.select(*on, time, _bucket(F.unix_micros(time), width).alias("_own"))
    out = times.select(*on, time, _opened(F.col("_own"), part).alias("_bucket"))
    if whole:
        first = times.dropDuplicatesWithinWatermark([*on, "_own"])
        out = out.unionByName(first.select(*on, time, _opened(F.col("_own"), whole).alias("_bucket")))
    return out


def range_join_stream(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, ...],
    left_time: str,
    right_time: str,
    before_ms: int,
    after_ms: int,
    how: str = "inner",
) -> DataFrame:
    """Columns: the keys, the other columns of ``left``, those of ``right``;
    apart from the keys no name may stand on both sides."""
    if before_ms < 0 or after_ms < 0:
        raise ValueError("the range must not be negative")
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if how not in HOW:
        raise ValueError(f"how must be one of {tuple(HOW)}")
    mine = [c for c in left.columns if c not in on]
    theirs = [c for c in right.columns if c not in on]
    within = F.expr(f"{right_time} >= {left_time} - INTERVAL {delay(before_ms)} AND {right_time} <= {left_time} + INTERVAL {delay(after_ms)}")
    key = [*on, "_bucket"]

    def joined(l: DataFrame, r: DataFrame, kind: str) -> DataFrame:  # noqa: E741
        cond = within
        for c in key:
            cond = cond & (F.col(c) == F.col(f"_r_{c}"))
        return l.join(r.withColumnsRenamed({c: f"_r_{c}" for c in key}), cond, kind)

    width = max(before_ms + after_ms, 1)
    at = F.unix_micros(left_time)
    first = _bucket(at - F.lit(before_ms * 1000), width)
    last = _bucket(at + F.lit(after_ms * 1000), width)
    l = left.withColumn("_bucket", F.explode(F.sequence(first, last)))  # noqa: E741
    r = right.withColumn("_bucket", _bucket(F.unix_micros(right_time), width))
    pairs = joined(l, r, HOW["right" if how in ("right", "full") else "inner"])
    out = pairs.select(*[F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) for c in on], *mine, *theirs)
    if how in ("left", "full"):
        narrow = max(width // CUTS, 1)
        l = left.withColumn("_bucket", _bucket(at, narrow))  # noqa: E741
        alone = joined(l, _to_left_buckets(right, on, right_time, before_ms, after_ms), HOW["left"]).where(F.col(right_time).isNull())
        none = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in theirs]
        out = out.unionByName(alone.select(*on, *mine, *none))
    return out
