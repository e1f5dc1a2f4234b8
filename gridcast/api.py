"""The composite operators, under the names users call them by.

| name | what it does |
|---|---|
| ``align`` | readings -> one value per (tick, cell): ``last`` / ``avg`` / ``sum`` |
| ``align_windows`` | readings -> mean of the window that ends at each tick |
| ``densify`` | aligned rows -> every cell of every tick (absent = 0) |
| ``neighbour_step`` | one weighted self + 4-neighbour step of a grid state |
| ``tick_fold`` | the step carried over all ticks, every tick stored |
| ``halo_rows`` / ``merge_halo`` | stripe-edge rows for the next tick, merged into the source |
| ``stream_tick_fold`` | the fold as a Structured Streaming query over closed ticks |
| ``striped_step`` | the step made stripe by stripe, with halo rows of the state |
| ``split_by_grid`` | readings of the grid's cells, and the rejected rest |
| ``snapshot_table`` / ``replay_table`` / ``replay_loop`` | stored states with coordinates and colours, by block |
| ``results_at`` | the results of one tick index |
"""

from gridcast.config import FoldSpec, GridSpec
from gridcast.operators import align, align_windows, densify, halo_rows, merge_halo, neighbour_step, split_by_grid, striped_step
from gridcast.plans.fold import tick_fold
from gridcast.plans.serve import replay_loop, replay_table, snapshot_table
from gridcast.sources.store import results_at
from gridcast.sources.readings import load_readings, readings_from_events
from gridcast.streaming.fold import stream_tick_fold

__all__ = [
    "FoldSpec",
    "GridSpec",
    "align",
    "align_windows",
    "densify",
    "halo_rows",
    "load_readings",
    "merge_halo",
    "neighbour_step",
    "readings_from_events",
    "replay_loop",
    "replay_table",
    "results_at",
    "snapshot_table",
    "split_by_grid",
    "stream_tick_fold",
    "striped_step",
    "tick_fold",
]
