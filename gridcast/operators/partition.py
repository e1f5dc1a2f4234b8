"""Range partitioning of cells (stripes of columns, ordered by i then j)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_partition(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """``repartitionByRange(n, i, j, tick)``: contiguous, disjoint key ranges
    per partition (Spark samples the keys to pick the bounds).  The tick is
    last, so that a cell with very many ticks is cut as well."""
    return df.repartitionByRange(n, *(cols or [c for c in ("i", "j", "tick") if c in df.columns]))


def partition_key_ranges(df: DataFrame) -> DataFrame:
    """Per partition: min and max of ``struct(i, j)`` (for layout checks)."""
    return (
        df.withColumn("pid", F.spark_partition_id())
        .groupBy("pid")
        .agg(F.min(F.struct("i", "j")).alias("lo"), F.max(F.struct("i", "j")).alias("hi"), F.count(F.lit(1)).alias("n"))
    )
