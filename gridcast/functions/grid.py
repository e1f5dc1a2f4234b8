"""Cell-level expressions: coordinates, edges, stripes, keys, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridcast.config import GridSpec, stripe_width
from gridcast.functions.ticks import int_div


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coord_x(i, grid: GridSpec, anchor: str = "node") -> Column:
    """x coordinate of column ``i``: ``x0 + i*dx`` (node) or ``+ dx/2`` (center)."""
    c = F.lit(grid.x0) + _col(i).cast("double") * F.lit(grid.dx)
    return c + F.lit(grid.dx / 2.0) if anchor == "center" else c


def coord_y(j, grid: GridSpec, anchor: str = "node") -> Column:
    c = F.lit(grid.y0) + _col(j).cast("double") * F.lit(grid.dy)
    return c + F.lit(grid.dy / 2.0) if anchor == "center" else c


def is_interior(i, j, grid: GridSpec) -> Column:
    i, j = _col(i), _col(j)
    return (i > 0) & (i < grid.nx - 1) & (j > 0) & (j < grid.ny - 1)


def in_domain(i, j, grid: GridSpec) -> Column:
    i, j = _col(i), _col(j)
    return (i >= 0) & (i < grid.nx) & (j >= 0) & (j < grid.ny)


def is_domain_edge(i, j, grid: GridSpec) -> Column:
    i, j = _col(i), _col(j)
    return (i == 0) | (i == grid.nx - 1) | (j == 0) | (j == grid.ny - 1)


def stripe_of(i, nx: int, n_stripes: int) -> Column:
    """Stripe (range bucket) of column ``i``: ``i * n div nx``."""
    return int_div(_col(i) * F.lit(n_stripes), F.lit(nx)).cast("int")


def is_left_stripe_edge(i, nx: int, n_stripes: int) -> Column:
    """First column of a stripe, domain edge excluded (stripe ids differ)."""
    i = _col(i)
    return (i > 0) & (stripe_of(i, nx, n_stripes) != stripe_of(i - 1, nx, n_stripes))


def is_right_stripe_edge(i, nx: int, n_stripes: int) -> Column:
    """Last column of a stripe, domain edge excluded."""
    i = _col(i)
    return (i < nx - 1) & (stripe_of(i, nx, n_stripes) != stripe_of(i + 1, nx, n_stripes))


def is_left_stripe_edge_nominal(i, nx: int, n_stripes: int) -> Column:
    """Legacy predicate: fixed width ``ceil(nx/n)``; ``i % w == 0``, i > 0.

    It disagrees with :func:`is_left_stripe_edge` when ``n`` does not divide
    ``nx`` and is kept only as a named expression.
    """
    i, w = _col(i), stripe_width(nx, n_stripes)
    return (i != 0) & ((i % F.lit(w)) == 0)


def is_right_stripe_edge_nominal(i, nx: int, n_stripes: int) -> Column:
    i, w = _col(i), stripe_width(nx, n_stripes)
    return (i != nx - 1) & ((i % F.lit(w)) == w - 1)


def branch_tag(*predicates: Column) -> Column:
    """Index of the first predicate that holds, else null (first match wins)."""
    out = None
    for k, p in enumerate(predicates):
        out = F.when(p, F.lit(k)) if out is None else out.when(p, F.lit(k))
    return out


def cell_key(i, j) -> Column:
    """Pack a cell into one bigint: ``(i << 32) + j`` (i, j >= 0)."""
    return F.shiftleft(_col(i).cast("long"), 32) + _col(j).cast("long")


def cell_key_i(key) -> Column:
    return F.shiftrightunsigned(_col(key), 32).cast("int")


def cell_key_j(key) -> Column:
    return (_col(key).bitwiseAND(F.lit(0xFFFFFFFF))).cast("int")


def cell_label(i, j) -> Column:
    """Display form ``(i,j)`` of a cell."""
    return F.format_string("(%d,%d)", _col(i), _col(j))


def value_label(time, value) -> Column:
    """Display form ``Time: <t> Temp: <v>`` of a timed value (the number text
    of ``v`` follows Spark's double formatting)."""
    return F.format_string("Time: %d Temp: %s", _col(time), _col(value).cast("string"))


def missing_as_zero(c) -> Column:
    """An absent state or absent join side counts as 0."""
    return F.coalesce(_col(c), F.lit(0.0))
