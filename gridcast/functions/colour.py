"""Presentation: red-scale colour strings and palette buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference viewers: red channel scale 255.9, palette
# size factor 0.9999, 1024 palette levels.
RED_SCALE = 255.9
PALETTE_FACTOR = 0.9999
PALETTE_LEVELS = 1024


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp01(u) -> Column:
    return F.least(F.greatest(_col(u).cast("double"), F.lit(0.0)), F.lit(1.0))


def red_scale(u) -> Column:
    """``#rr0000`` with ``rr = int(255.9 * clamp(u))`` in two hex digits."""
    level = (clamp01(u) * F.lit(RED_SCALE)).cast("int")
    return F.format_string("#%02x0000", level)


def palette_bucket(u, levels: int = PALETTE_LEVELS) -> Column:
    """Palette index ``min(int(clamp(u) * n*0.9999), n-1)``."""
    idx = (clamp01(u) * F.lit(levels * PALETTE_FACTOR)).cast("int")
    return F.least(idx, F.lit(levels - 1))
