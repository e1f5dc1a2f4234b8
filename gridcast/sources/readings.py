"""Reading sources: the test-data adapter, JSON lines, and the grid scaffold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import GridSpec, TEST_GRID
from gridcast.functions.grid import cell_key
from gridcast.schemas import JSON_READING, JSON_RENAMES, READINGS


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def utc_millis(df: DataFrame, name: str):
    """Epoch milliseconds of a timestamp column; one without a zone is read
    as UTC, by its distance from the epoch, and no session zone plays a part."""
    if dict(df.dtypes)[name] != "timestamp_ntz":
        return F.unix_millis(F.col(name))
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {name})")


def readings_from_events(events: DataFrame, grid: GridSpec = TEST_GRID) -> DataFrame:
    """Map the ``events`` table onto READINGS.

    ``i = user_id % nx``, ``j = event_id % ny``, ``time`` = epoch ms of
    ``ts`` read as UTC (whatever the session's zone), ``gen = value``, ``seq = event_id``.  Only these four source columns are
    read, so the scan prunes the rest.
    """
    return events.select(
        F.col("event_id").cast("long").alias("seq"),
        utc_millis(events, "ts").alias("time"),
        (F.col("user_id") % F.lit(grid.nx)).cast("int").alias("i"),
        (F.col("event_id") % F.lit(grid.ny)).cast("int").alias("j"),
        F.col("value").cast("double").alias("gen"),
    )


def load_readings(spark: SparkSession, sf_dir: str, grid: GridSpec = TEST_GRID) -> DataFrame:
    return readings_from_events(spark.read.parquet(table_path(sf_dir, "events")), grid)


def readings_dump(readings: DataFrame) -> DataFrame:
    """Bounded dump of a reading log with packed keys and values."""
    return readings.select(
        cell_key("i", "j").alias("cell_key"), F.col("time"), F.col("gen")
    )


def grid_scaffold(spark: SparkSession, grid: GridSpec) -> DataFrame:
    """Every cell of the grid as ``(i, j)``, generated on the executors.

    ``range(nx * ny)`` split into ``i = id div ny`` and ``j = id % ny``: one
    generated range, no driver-side list and no join.  Partition count grows
    with the number of cells.
    """
    n = grid.n_cells
    parts = n // 1_000_000 + 1
    return spark.range(0, n, 1, parts).select(
        F.call_function("div", F.col("id"), F.lit(grid.ny)).cast("int").alias("i"),
        (F.col("id") % F.lit(grid.ny)).cast("int").alias("j"),
    )


def readings_to_json(readings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object per reading (column ``value``) with the text
    generator's field names; ``keep`` columns are carried alongside."""
    return readings.select(
        *keep,
        F.to_json(
            F.struct(
                F.col("i").alias("x"),
                F.col("j").alias("y"),
                F.col("time").cast("double").alias("timestamp"),
                F.col("gen"),
            )
        ).alias("value")
    )


def parse_json_readings(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse JSON-lines readings into READINGS (``seq`` stays null).

    ``timestamp`` is read as a double (it may be printed as ``1e+06``) and
    cast to bigint; the documented names ``gridX/gridY/time`` are accepted
    as aliases of ``x/y/timestamp``.
    """
    fields = list(JSON_READING.fieldNames()) + list(JSON_RENAMES)
    schema = ", ".join(
        f"{name} {'double' if name in ('timestamp', 'time', 'gen') else 'int'}"
        for name in fields
    )
    p = lines.select(F.from_json(F.col(value_col), schema).alias("r")).select("r.*")
    alias = {v: k for k, v in JSON_RENAMES.items()}
    pick = lambda name: F.coalesce(F.col(name), F.col(alias[name]))
    return p.select(
        F.lit(None).cast("long").alias("seq"),
        pick("timestamp").cast("long").alias("time"),
        pick("x").cast("int").alias("i"),
        pick("y").cast("int").alias("j"),
        F.col("gen").cast("double").alias("gen"),
    )


def read_json_readings(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder of JSON-lines reading files."""
    return parse_json_readings(spark.read.text(path))


__all__ = [
    "READINGS",
    "grid_scaffold",
    "load_readings",
    "parse_json_readings",
    "read_json_readings",
    "readings_dump",
    "readings_from_events",
    "readings_to_json",
    "table_path",
]
