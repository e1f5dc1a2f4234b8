"""Relational operators over readings and grid states."""

from gridcast.operators.align import align, align_windows, latest_per_cell, readings_per_tick, split_by_grid, window_mean, with_tick
from gridcast.operators.densify import dense_ticks, densify, densify_state, reading_bounds, tick_bounds
from gridcast.operators.halo import halo_branch, halo_rows, merge_halo
from gridcast.operators.panes import hopping_mean, pane_sums
from gridcast.operators.partition import partition_key_ranges, range_partition
from gridcast.operators.ranges import range_join
from gridcast.operators.stencil import chained_steps, contributions, neighbour_step, source_terms, step_by_lookup, striped_step

__all__ = [
    "align",
    "align_windows",
    "chained_steps",
    "contributions",
    "dense_ticks",
    "densify",
    "densify_state",
    "halo_branch",
    "halo_rows",
    "hopping_mean",
    "latest_per_cell",
    "merge_halo",
    "neighbour_step",
    "pane_sums",
    "partition_key_ranges",
    "range_join",
    "range_partition",
    "reading_bounds",
    "readings_per_tick",
    "source_terms",
    "split_by_grid",
    "step_by_lookup",
    "striped_step",
    "tick_bounds",
    "window_mean",
    "with_tick",
]
