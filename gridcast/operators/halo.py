"""Stripe-edge halo rows and their merge into the source of the next tick.

A stripe is a range of grid columns.  Rows on the first (last) column of a
stripe are sent to the column on their left (right) and shifted to the
next tick, so the neighbouring stripe sees them one tick later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.grid import branch_tag, is_left_stripe_edge, is_right_stripe_edge, missing_as_zero


def halo_branch(df: DataFrame, nx: int, n_stripes: int) -> DataFrame:
    """Tag rows by ordered predicates (left edge 0, right edge 1); first match
    wins and rows matching neither are dropped."""
    tag = branch_tag(is_left_stripe_edge("i", nx, n_stripes), is_right_stripe_edge("i", nx, n_stripes))
    return df.withColumn("branch", tag).where(F.col("branch").isNotNull())


def halo_rows(df: DataFrame, nx: int, n_stripes: int, tick_ms: int, value: str = "f") -> DataFrame:
    """HALO rows: left-edge rows go to ``i-1``, right-edge rows to ``i+1``,
    both at ``tick + T``; a one-column stripe sends both ways.  One pass over
    ``df``: each row opens into up to two."""

    def sent(edge, di: int):
        row = F.struct(
            (F.col("tick") + F.lit(tick_ms)).cast("long").alias("tick"),
            (F.col("i") + F.lit(di)).cast("int").alias("i"),
            F.col("j").alias("j"),
            F.col(value).alias("val"),
        )
        return F.when(edge, row)

    both = F.array(sent(is_left_stripe_edge("i", nx, n_stripes), -1), sent(is_right_stripe_edge("i", nx, n_stripes), 1))
    return df.select(F.inline(F.filter(both, lambda r: r.isNotNull())))


def merge_halo(aligned: DataFrame, halo: DataFrame, coeff: float) -> DataFrame:
    """Full outer join of source and halo on (tick, i, j):
    ``f' = coalesce(f, 0) + C * val`` (halo term only when present)."""
    h = halo.groupBy("tick", "i", "j").agg(F.sum("val").alias("val"))
    j = aligned.select("tick", "i", "j", "f").join(h, ["tick", "i", "j"], "full")
    return j.select(
        "tick",
        "i",
        "j",
        (missing_as_zero("f") + F.lit(float(coeff)) * missing_as_zero("val")).alias("f"),
    )
