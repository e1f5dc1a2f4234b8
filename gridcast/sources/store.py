"""The state store and the results table.

State layout: Parquet partitioned by ``tick_block`` (``<root>/tick_block=<b>/``),
rows ``(tick, i, j, u)`` sorted by tick inside each file.  A block holds
``block_ticks`` consecutive ticks counted from ``origin``; the three numbers
are recorded in ``<root>/_layout``.  Large grids use one tick per block
(one partition per tick); small grids put many ticks in a block so a table
does not turn into one tiny file per tick.

Writes that cover whole blocks replace them (dynamic partition overwrite);
writes that cover part of a block merge into it (read-modify-write of that
block only).  Either way a replayed write leaves the table unchanged.
Readers name only the blocks of the ticks they ask for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import GridSpec, scratch_path, shared_dir
from gridcast.functions.grid import coord_x, coord_y

STATE_DDL = "tick long, i int, j int, u double, tick_block long"
LAYOUT = "_layout"
RESULTS_DDL = "tick_index long, x double, y double, temp double, ti_block long"
RESULTS_LAYOUT = "_results_layout"


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def drop_scratch(spark: SparkSession, path: str, created_here: bool = False) -> None:
    """Delete an intermediate table this library created: a unique folder in
    its own scratch area, or (``created_here``) a folder the caller's code
    just wrote itself, such as one micro-batch's staged copy."""
    if not path.startswith(f"{shared_dir(spark)}/gridcast/") and not created_here:
        raise ValueError(f"refusing to delete a path outside the gridcast scratch area: {path}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@dataclass(frozen=True)
class Layout:
    """Ticks ``origin + n * tick_ms`` grouped ``block_ticks`` at a time."""

    origin: int
    tick_ms: int
    block_ticks: int

    @property
    def span(self) -> int:
        return self.tick_ms * self.block_ticks

    def block(self, tick: int) -> int:
        return (tick - self.origin) // self.span

    def block_col(self, tick: str = "tick") -> Column:
        d = F.col(tick) - F.lit(self.origin)
        return F.call_function("div", d - F.pmod(d, F.lit(self.span)), F.lit(self.span)).cast("long")

    def covers_whole_blocks(self, lo: int, hi: int) -> bool:
        start = self.origin + self.block(lo) * self.span
        end = self.origin + (self.block(hi) + 1) * self.span - self.tick_ms
        return lo == start and hi == end


PER_TICK = Layout(0, 1, 1)


def read_layout(spark: SparkSession, path: str) -> Layout | None:
    text = _read_text(spark, f"{path}/{LAYOUT}")
    if text is None:
        return None
    origin, tick_ms, block_ticks = (int(v) for v in text.split())
    return Layout(origin, tick_ms, block_ticks)


def ensure_layout(spark: SparkSession, path: str, layout: Layout | None = None) -> Layout:
    """The table's layout; a new table records ``layout`` (default: one
    tick per block).  A table of another tick length or phase is refused."""
    found = read_layout(spark, path)
    if found is not None:
        if layout is not None and found != PER_TICK:
            if found.tick_ms != layout.tick_ms or (found.origin - layout.origin) % found.tick_ms:
                raise ValueError(f"{path} holds ticks of {found.tick_ms} ms from {found.origin}, not {layout.tick_ms} ms from {layout.origin}")
        return found
    layout = layout or PER_TICK
    _write_text(spark, f"{path}/{LAYOUT}", f"{layout.origin} {layout.tick_ms} {layout.block_ticks}")
    return layout


def write_states(
    states: DataFrame,
    path: str,
    lo: int | None = None,
    hi: int | None = None,
    layout: Layout | None = None,
    sole: bool = False,
) -> None:
    """Write ``(tick, i, j, u)`` rows of ticks ``lo..hi``.

    Whole blocks (and every write of a one-tick-per-block table) replace
    their partitions; a partly covered block is merged, new rows winning.
    ``sole=True`` tells that the touched blocks hold no other ticks (a table
    being filled in tick order by one writer), so they are replaced too.
    """
    spark = states.sparkSession
    lay = ensure_layout(spark, path, layout)
    rows = states.select("tick", "i", "j", "u").withColumn("tick_block", lay.block_col())
    whole = sole or lay.block_ticks == 1 or (lo is not None and hi is not None and lay.covers_whole_blocks(lo, hi))
    if whole:
        (
            rows.sortWithinPartitions("tick_block", "tick", "i", "j")  # each task's file of a block is sorted
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("tick_block")
            .parquet(path)
        )
    else:
        upsert_by_key(spark, rows, path, ("tick_block", "tick", "i", "j"), "tick_block", ("u",), ("u",))


def write_tick(
    state: DataFrame, path: str, tick: int, layout: Layout | None = None, sole: bool = False
) -> None:
    """Write a dense ``(i, j, u)`` state as tick ``tick``."""
    write_states(state.withColumn("tick", F.lit(tick).cast("long")), path, tick, tick, layout, sole)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The whole state history as ``(tick, i, j, u)``."""
    return spark.read.schema(STATE_DDL).parquet(path).select("tick", "i", "j", "u")


def read_ticks(spark: SparkSession, path: str, lo: int, hi: int) -> DataFrame:
    """Ticks ``lo..hi``: the block directory is named to the reader when one
    holds them all (no listing of the table); a longer range prunes the
    partitions by block.  The tick filter prunes row groups inside."""
    lay = read_layout(spark, path) or PER_TICK
    a, b = lay.block(lo), lay.block(hi)
    source = spark.read.schema(STATE_DDL).option("basePath", path)
    if a == b:
        if not _fs_exists(spark, f"{path}/tick_block={a}"):
            return spark.createDataFrame([], "tick long, i int, j int, u double")
        rows = source.parquet(f"{path}/tick_block={a}")
    else:
        rows = source.parquet(path).where((F.col("tick_block") >= F.lit(a)) & (F.col("tick_block") <= F.lit(b)))
    return rows.where((F.col("tick") >= F.lit(lo)) & (F.col("tick") <= F.lit(hi))).select("tick", "i", "j", "u")


def read_tick(spark: SparkSession, path: str, tick: int) -> DataFrame:
    """The dense ``(i, j, u)`` state of one tick."""
    return read_ticks(spark, path, tick, tick).select("i", "j", "u")


def stored_ticks(spark: SparkSession, path: str, column: str = "tick", check_committed: bool = True) -> list[int]:
    """Partition values present under ``path`` from a directory listing
    (metadata only: no data file is opened).  ``check_committed`` skips
    directories a failed writer left half-written (one extra call each)."""
    if not _fs_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    prefix = f"{column}="
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith(prefix)):
            continue
        # a committed partition has no `_temporary` folder left in it
        if check_committed and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_temporary")):
            continue
        out.append(int(name[len(prefix):]))
    return sorted(out)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small metadata file that is written once and never replaced."""
    jvm, p, fs = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(tmp, p)


def _read_text(spark: SparkSession, path: str) -> str | None:
    jvm, p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")).strip()
    finally:
        stream.close()


def latest_tick_before(spark: SparkSession, path: str, tick: int, tick_ms: int, cells: int) -> int | None:
    """Newest tick strictly before ``tick`` that is stored with all its
    ``cells`` (a write that was cut short may leave fewer).

    Mostly it is the tick before, in a block that is named to the reader.
    After a gap the blocks are listed and the newest ones before ``tick`` are
    looked into.  None only for a table that holds no tick at all: one that
    holds later ticks alone is refused, it must not be started anew.
    """
    lay = read_layout(spark, path)
    if lay is None:
        return None

    def newest(lo: int, hi: int) -> int | None:
        return read_ticks(spark, path, lo, hi).groupBy("tick").count().where(F.col("count") == F.lit(cells)).agg(F.max("tick")).first()[0]

    before = tick - tick_ms
    if newest(before, before) is not None:
        return before
    blocks = stored_ticks(spark, path, "tick_block", check_committed=False)
    for b in reversed([b for b in blocks if b <= lay.block(before)]):
        start = lay.origin + b * lay.span
        found = newest(start, min(start + lay.span - lay.tick_ms, before))
        if found is not None:
            return int(found)
    if blocks:
        raise RuntimeError(f"{path} holds ticks but no whole one before {tick}")
    return None


# --- results table: (tick_index, x, y, temp), key ((tick_index), x, y) -----


def to_results(states: DataFrame, grid: GridSpec, tick_ms: int, anchor: str = "node") -> DataFrame:
    """Project states to the stored results layout: tick index and coordinates."""
    return states.select(
        F.call_function("div", F.col("tick"), F.lit(tick_ms)).cast("long").alias("tick_index"),
        coord_x("i", grid, anchor).alias("x"),
        coord_y("j", grid, anchor).alias("y"),
        F.col("u").alias("temp"),
    )


UPSERT_CHUNKS = 16


def upsert_by_key(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    key: tuple[str, ...],
    part: str,
    values: tuple[str, ...],
    version: tuple[str, ...],
) -> None:
    """Upsert ``rows`` into a Parquet table partitioned by ``part``.

    1. The batch is reduced to one row per ``key`` (largest ``version``
       columns, compared in order, then the largest value) with one
       ``max_by`` aggregate (a hot key is pre-reduced map-side) and staged.
       This is the only pass over the input.
    2. The touched partitions of the table, found by a join on ``part`` that
       prunes the others at run time, are merged with it, new rows winning,
       and replace the old ones in one write (dynamic overwrite: the new
       files are complete before an old one goes).  Rows are dealt by
       ``part`` and ``UPSERT_CHUNKS`` chunks of the key, which bounds the
       files of a partition whatever the number of tasks.
    Running the same upsert twice leaves the table unchanged.  ``part`` must
    be one of the key columns (an integral bucket of the key).
    """
    key, cols = list(key), [*key, *values]
    vals = F.struct(*[F.col(c) for c in values])
    stage_new = scratch_path(spark, "upsert-new")
    reduced = rows.groupBy(*key).agg(F.max_by(vals, F.struct(*[F.col(c) for c in version], vals.alias("_value"))).alias("_v"))
    reduced = reduced.select(*key, *[F.col(f"_v.{c}").alias(c) for c in values])
    try:
        reduced.write.parquet(stage_new)
        new = spark.read.schema(reduced.schema).parquet(stage_new)
        if new.isEmpty():
            return
        merged = new
        if stored_ticks(spark, path, part, check_committed=False):
            old = spark.read.schema(reduced.schema).parquet(path).select(*cols).join(new.select(part).distinct(), part, "left_semi").select(*cols)
            both = new.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)))
            merged = both.groupBy(*key).agg(F.max_by(vals, F.col("_new")).alias("_v")).select(*key, *[F.col(f"_v.{c}").alias(c) for c in values])
        chunk = F.pmod(F.xxhash64(*[c for c in key if c != part]), F.lit(UPSERT_CHUNKS))
        (
            merged.repartition(F.col(part), chunk)
            .sortWithinPartitions(*key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(part)
            .parquet(path)
        )
    finally:
        drop_scratch(spark, stage_new)


def upsert_results(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    version: tuple[str, ...],
    block_ticks: int = 1,
) -> None:
    """Upsert ``(tick_index, x, y, temp, *version)`` into the results table,
    keyed by (tick_index, x, y) and partitioned by blocks of ``block_ticks``
    tick indexes (see :func:`upsert_by_key`).  The block size is recorded
    with the table on its first write and reused by every later writer."""
    recorded = _read_text(spark, f"{path}/{RESULTS_LAYOUT}")
    if recorded is None:
        _write_text(spark, f"{path}/{RESULTS_LAYOUT}", str(int(block_ticks)))
        recorded = str(int(block_ticks))
    b = int(recorded)
    blocked = rows.withColumn(
        "ti_block", F.call_function("div", F.col("tick_index"), F.lit(b)).cast("long")
    )
    upsert_by_key(spark, blocked, path, ("ti_block", "tick_index", "x", "y"), "ti_block", ("temp",), version)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The results table as ``(tick_index, x, y, temp)``."""
    return spark.read.schema(RESULTS_DDL).parquet(path).select("tick_index", "x", "y", "temp")


def results_at(spark: SparkSession, path: str, tick_index: int) -> DataFrame:
    """The results of one tick index: only its block is read."""
    b = int(_read_text(spark, f"{path}/{RESULTS_LAYOUT}") or 1)
    block = F.col("ti_block") == F.lit(int(tick_index / b))  # as SQL's div: towards zero
    rows = spark.read.schema(RESULTS_DDL).parquet(path).where(block & (F.col("tick_index") == F.lit(tick_index)))
    return rows.select("tick_index", "x", "y", "temp")
