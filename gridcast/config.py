"""Grid geometry, fold parameters and session helpers.

Everything here is plain data or a thin read of session settings; no
Spark job is started by this module.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

EDGE_RULES = ("zero", "fixed")
ANCHORS = ("node", "center")
DUP_POLICIES = ("last", "avg", "sum")


@dataclass(frozen=True)
class GridSpec:
    """A regular ``nx`` x ``ny`` grid over the rectangle [x0,x1] x [y0,y1].

    Column index ``i`` runs along x, row index ``j`` along y.  Spacing is
    ``(x1-x0)/(nx-1)`` and ``(y1-y0)/(ny-1)`` (rows use ``ny``; see the
    README for why this differs from one of the reference programs).
    """

    nx: int
    ny: int
    x0: float = -10.0
    x1: float = 10.0
    y0: float = -10.0
    y1: float = 10.0

    def __post_init__(self):
        if self.nx < 1 or self.ny < 1:
            raise ValueError("grid needs at least one column and one row")

    @property
    def dx(self) -> float:
        return (self.x1 - self.x0) / (self.nx - 1) if self.nx > 1 else 0.0

    @property
    def dy(self) -> float:
        return (self.y1 - self.y0) / (self.ny - 1) if self.ny > 1 else 0.0

    @property
    def n_cells(self) -> int:
        return self.nx * self.ny


@dataclass(frozen=True)
class FoldSpec:
    """Parameters of the neighbour-weighted carry-forward.

    ``coeff`` is the neighbour weight C; the cell keeps ``1 - 4C`` of its
    own value.  ``edge`` selects how the domain border behaves:

    * ``"zero"``: every cell is updated; cells one past the border count as 0.
    * ``"fixed"``: border cells keep their value and take no source; only
      interior cells are updated (they still read border neighbours).

    ``source_scale`` multiplies every aligned reading before it is added.
    """

    coeff: float = 0.1875
    edge: str = "zero"
    source_scale: float = 1.0

    def __post_init__(self):
        if self.edge not in EDGE_RULES:
            raise ValueError(f"edge must be one of {EDGE_RULES}")
        if not 0.0 <= self.coeff:
            raise ValueError("coeff must be >= 0")
        if self.coeff > 0.25:
            # the cell's own weight 1 - 4C turns negative: values oscillate
            warnings.warn("coeff > 0.25 gives a negative self weight", stacklevel=2)

    def with_(self, **kw) -> "FoldSpec":
        return replace(self, **kw)


# The test-data adapter: a 12 x 8 grid and daily ticks over `events`.
TEST_GRID = GridSpec(12, 8)
TEST_TICK_MS = 86_400_000


def stripe_width(nx: int, n_stripes: int) -> int:
    """Nominal stripe width ``ceil(nx / n)`` (integer, no float round-off)."""
    return -(-nx // n_stripes)


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch area.

    It is the folder named by ``spark.checkpoint.dir``.  When the session
    has none (tests, local runs) and runs in local mode, a private folder is
    created and registered as the checkpoint directory.  On a cluster an
    unset checkpoint directory is an error: a machine-local folder would not
    survive the loss of an executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
        if current:
            base = os.path.dirname(current.rstrip("/"))
        elif sc.master.startswith("local"):
            base = tempfile.mkdtemp(prefix="gridcast-ckpt-")
            sc.setCheckpointDir(base)
        else:
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder before running gridcast jobs"
            )
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch area."""
    return f"{shared_dir(spark)}/gridcast/{name}-{uuid.uuid4().hex[:12]}"
