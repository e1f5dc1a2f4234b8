"""Minimax contiguous partition of documents into shards of near equal bytes.

A document's size is the UTF-8 bytes of its text plus a fixed overhead.
Documents with equal texts form an atomic group.  Groups stand in the order
(size descending, text key); a shard is a contiguous range of that order.
For each shard in turn the smallest capacity that lets the remaining groups
fit the remaining shards is found by binary search, checking a capacity
greedily, and the shard is cut there.  The first capacity is the minimax
optimum; solving again for the rest keeps the shards behind a very large
group near equal instead of leaving the last ones empty.

Only the number of groups of each size decides the cuts, so the driver gets
one row per distinct group size: at most ``sqrt(2 * total bytes)`` rows, and
never more than the largest group has bytes.  Ranks and offsets come from
one global sort of (size, key, doc_id) rows plus one total per sorted
partition; no shard or group is gathered into a task.  The keys of the cuts
are looked up by row number among the sorted groups of the cuts' sizes: one
row per shard.

Cases: a null text has no bytes and counts as the empty text; a null doc_id
is a row like others; repeated rows stay separate rows of one group; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, text_key

OVERHEAD = 16


def _end(size: np.ndarray, count_sum: np.ndarray, byte_sum: np.ndarray, start: int, capacity: int) -> int:
    """First group that no longer fits behind ``start`` (group numbers)."""
    run = int(np.searchsorted(count_sum, start, side="right")) - 1
    at = int(byte_sum[run]) + (start - int(count_sum[run])) * int(size[run])
    limit = at + capacity
    run = int(np.searchsorted(byte_sum, limit, side="right")) - 1
    if run >= len(size):
        return int(count_sum[-1])
    return int(count_sum[run]) + (limit - int(byte_sum[run])) // int(size[run])


def cuts(size: np.ndarray, count: np.ndarray, shards: int) -> list[int]:
    """First group number of each shard, for ``count`` groups of each
    ``size`` in order."""
    count_sum = np.concatenate(([0], np.cumsum(count)))
    byte_sum = np.concatenate(([0], np.cumsum(size * count)))
    groups, total = int(count_sum[-1]), int(byte_sum[-1])

    def start_byte(g: int) -> int:
        run = min(int(np.searchsorted(count_sum, g, side="right")) - 1, len(size) - 1)
        return int(byte_sum[run]) + (g - int(count_sum[run])) * int(size[run])

    def feasible(start: int, left: int, capacity: int) -> bool:
        for _ in range(left):
            if start >= groups:
                return True
            start = _end(size, count_sum, byte_sum, start, capacity)
        return start >= groups

    out, start = [], 0
    for shard in range(shards):
        out.append(start)
        if start >= groups:
            continue
        left = shards - shard
        rest = total - start_byte(start)
        low = -(-rest // left)
        first = min(int(np.searchsorted(count_sum, start, side="right")) - 1, len(size) - 1)
        low = max(low, int(size[first:].max()))
        high = rest
        while low < high:
            mid = (low + high) // 2
            if feasible(start, left, mid):
                high = mid
            else:
                low = mid + 1
        start = _end(size, count_sum, byte_sum, start, low)
    return out


def assign(docs: DataFrame, shards: int = 40, overhead: int = OVERHEAD) -> DataFrame:
    """Rows ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    spark = docs.sparkSession
    text = F.coalesce(docs["text"], F.lit(""))
    slim = staged(
        docs.select(docs["doc_id"].alias("doc_id"), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), text_key(docs["text"]).alias("key")),
        "shard-slim",
    )
    groups = staged(slim.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies")), "shard-groups")
    # one row per distinct group size (bounded, see above)
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("n")).orderBy(F.desc("bytes")).toPandas()
    size, count = sizes["bytes"].to_numpy(np.int64), sizes["n"].to_numpy(np.int64)
    first = cuts(size, count, shards) if len(size) else [0] * shards

    # groups in order: offsets of each sorted partition from its totals
    many = groups.where("copies > 1").select(F.col("key").alias("k"), "bytes")
    rows = slim.join(many, F.col("key") == F.col("k"), "left").withColumn("bytes", F.coalesce("bytes", "size"))
    local, offset = _numbered(rows.select("doc_id", "size", "text_crc32", "bytes", "key"), (F.desc("bytes"), "key", "doc_id"), "shard-order")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    offsets = F.broadcast(spark.createDataFrame([(p, before) for p, before, _ in offset], "p long, before long"))
    ranked = local.join(offsets, part == F.col("p")).withColumn("rank", F.col("before") + row)

    # a cut at group g is the key and size of that group: found by rank among groups
    marks = _marks(groups.select("bytes", "key"), size, count, first)
    shard = F.lit(-1)
    for b, k in marks:
        if b is None:
            continue
        behind = (F.col("bytes") < F.lit(b)) | ((F.col("bytes") == F.lit(b)) & (F.col("key") >= F.lit(k)))
        shard = shard + behind.cast("int")
    placed = ranked.withColumn("shard", shard.cast("int"))
    starts = {r["shard"]: r["lo"] for r in placed.groupBy("shard").agg(F.min("rank").alias("lo")).collect()}
    low = F.broadcast(spark.createDataFrame(sorted(starts.items()), "s int, lo long"))
    return placed.join(low, F.col("shard") == F.col("s")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("lo")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def _numbered(rows: DataFrame, order: tuple, name: str) -> tuple[DataFrame, list[tuple]]:
    """``rows`` in global order, staged with a number ``at`` that counts up
    inside each sorted partition, and (partition, rows before it, its rows):
    a partition's rows follow those of the one before."""
    local = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), name)
    before, offset = 0, []
    for t in local.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("rows")).orderBy("part").collect():
        offset.append((t["part"], before, t["rows"]))
        before += t["rows"]
    return local, offset


def _marks(heads: DataFrame, size: np.ndarray, count: np.ndarray, first: list[int]) -> list[tuple]:
    """(bytes, key) of the first group of each shard; None for empty shards.

    The groups of the sizes that hold a cut are numbered in order, so a cut
    is one row number: at most one row per shard reaches the driver.
    """
    count_sum = np.concatenate(([0], np.cumsum(count)))
    groups = int(count_sum[-1])
    runs = {g: int(np.searchsorted(count_sum, g, side="right")) - 1 for g in first if g < groups}
    if not runs:
        return [(None, None)] * len(first)
    held = sorted(set(runs.values()))
    skipped = dict(zip(held, np.concatenate(([0], np.cumsum(count[held])))))  # staged groups of larger sizes
    inside = heads.where(F.col("bytes").isin([int(size[r]) for r in held]))
    local, offset = _numbered(inside, (F.desc("bytes"), "key"), "shard-cuts")
    at = {}
    for g, r in runs.items():
        rank = int(skipped[r]) + g - int(count_sum[r])
        part, before = next((p, lo) for p, lo, n in offset if lo <= rank < lo + n)
        at[g] = (part << 33) + rank - before
    found = {x["at"]: (x["bytes"], x["key"]) for x in local.where(F.col("at").isin(list(at.values()))).collect()}
    return [found[at[g]] if g in at else (None, None) for g in first]
