"""Co-partitioned tables: inputs that join without a shuffle.

A bucketed table is dealt by its keys once, when it is written; tables with
equal keys and an equal number of buckets have equal rows in equal buckets,
so that a join on these keys reads bucket by bucket and plans no exchange.
That pays where a table is joined more than once, as the grid's states and
sources are.

The files lie in the shared scratch area (or under ``path``), the table is
registered in the session's catalog.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.config import scratch_path
from gridcast.functions.grid import missing_as_zero

#: Buckets unless given: a multiple of the shuffle's partitions keeps tasks even.
BUCKETS = 16


def bucketed(df: DataFrame, keys: tuple[str, ...], buckets: int = BUCKETS, name: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``keys``; the table read back.

    Rows are dealt by the bucket's own hash first, so that a bucket is one
    file written by one task and a job writes no more files than buckets.
    """
    spark = df.sparkSession
    name = name or f"gridcast_{uuid.uuid4().hex[:12]}"
    path = path or scratch_path(spark, "bucketed")
    (
        df.repartition(buckets, *keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    return spark.table(name)


def merge_halo_bucketed(aligned: DataFrame, halo: DataFrame, coeff: float) -> DataFrame:
    """``merge_halo`` of two tables bucketed by (tick, i, j), the halo with
    one row per key: a full outer join with no exchange."""
    j = aligned.join(halo, ["tick", "i", "j"], "full")
    return j.select("tick", "i", "j", (missing_as_zero("f") + F.lit(float(coeff)) * missing_as_zero("val")).alias("f"))


def with_state(aligned: DataFrame, states: DataFrame) -> DataFrame:
    """Each aligned row with its cell's state of the tick before, 0 if
    absent; ``states`` ``(tick, i, j, u_prev)`` are stamped with the tick that
    reads them.  With both tables bucketed by (tick, i, j) no exchange."""
    j = aligned.join(states, ["tick", "i", "j"], "left")
    return j.select("tick", "i", "j", "f", missing_as_zero("u_prev").alias("u_prev"))
