"""Repair of a folded history after sources have changed.

The fold is linear: a source that changes by ``df`` at a tick changes the
states behind it by the fold of ``df`` alone, and only inside its dependency
cone: the cells within ``m`` steps of the source, ``m`` ticks later.  The
differences are therefore folded from a sparse state that holds nothing but
the cells reached so far; cells outside the cone are neither read nor
written, whatever the size of the grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import FoldSpec, GridSpec
from gridcast.functions.grid import in_domain
from gridcast.operators.stencil import chained_steps
from gridcast.plans.fold import CHAIN_STEPS

CHANGE_DDL = "tick long, i int, j int, u double"


def cone_changes(spark: SparkSession, changed, first: int, last: int, grid: GridSpec, spec: FoldSpec, tick_ms: int, path: str) -> None:
    """Write the changes ``(tick, i, j, u)`` of the states of ticks ``first
    .. last`` to ``path``, a folder per chain of steps.  ``changed(lo, hi)``
    returns the source differences ``(tick, i, j, f)`` of these ticks.

    A replayed call writes the same folders.
    """
    state, tick, n = None, first, 0
    while tick <= last:
        k = min(CHAIN_STEPS, (last - tick) // tick_ms + 1)
        end = tick + (k - 1) * tick_ms
        sources = changed(tick, end).where(in_domain("i", "j", grid))
        # a cell whose source changes within the chain joins the sparse state
        reached = sources.select("i", "j", F.lit(0.0).alias("u"))
        if state is not None:
            reached = reached.unionByName(state)
        seed = reached.groupBy("i", "j").agg(F.sum("u").alias("u"))
        steps = chained_steps(seed, sources, tick, k, tick_ms, grid, spec).where("u IS NOT NULL AND u <> 0")
        steps.sortWithinPartitions("tick", "i", "j").write.mode("overwrite").parquet(f"{path}/chain={n}")
        state = spark.read.schema(CHANGE_DDL).parquet(f"{path}/chain={n}").where(F.col("tick") == F.lit(end)).select("i", "j", "u")
        tick, n = end + tick_ms, n + 1
