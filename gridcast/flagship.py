"""The flagship query: the grid after the last tick of the readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridcast.config import TEST_GRID, TEST_TICK_MS, FoldSpec, GridSpec
from gridcast.operators.align import align
from gridcast.plans.fold import tick_fold
from gridcast.plans.serve import present
from gridcast.sources.readings import load_readings


def last_state(
    spark: SparkSession,
    sf_dir: str,
    grid: GridSpec = TEST_GRID,
    tick_ms: int = TEST_TICK_MS,
    spec: FoldSpec = FoldSpec(),
    dup: str = "avg",
) -> DataFrame:
    aligned = align(load_readings(spark, sf_dir, grid), tick_ms, dup)
    res = tick_fold(spark, aligned, grid, spec, tick_ms, method="step")
    return present(res.final(spark), grid).orderBy("i", "j")


__all__ = ["last_state"]
