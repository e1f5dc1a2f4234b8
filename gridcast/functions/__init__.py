"""Column expressions (pure, JVM-side, codegen-friendly)."""

from gridcast.functions.colour import clamp01, palette_bucket, red_scale
from gridcast.functions.grid import (
    branch_tag,
    cell_key,
    cell_key_i,
    cell_key_j,
    cell_label,
    coord_x,
    coord_y,
    in_domain,
    is_domain_edge,
    is_interior,
    is_left_stripe_edge,
    is_left_stripe_edge_nominal,
    is_right_stripe_edge,
    is_right_stripe_edge_nominal,
    missing_as_zero,
    stripe_of,
    value_label,
)
from gridcast.functions.ticks import event_time, tick_index, tick_snap, tick_ts

__all__ = [
    "branch_tag",
    "cell_key",
    "cell_key_i",
    "cell_key_j",
    "cell_label",
    "clamp01",
    "coord_x",
    "coord_y",
    "event_time",
    "in_domain",
    "is_domain_edge",
    "is_interior",
    "is_left_stripe_edge",
    "is_left_stripe_edge_nominal",
    "is_right_stripe_edge",
    "is_right_stripe_edge_nominal",
    "missing_as_zero",
    "palette_bucket",
    "red_scale",
    "stripe_of",
    "tick_index",
    "tick_snap",
    "tick_ts",
    "value_label",
]
