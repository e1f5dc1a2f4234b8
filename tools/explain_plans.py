"""Print the formatted physical plans of the main operators.

    python tools/explain_plans.py [sf_dir]

Shows what to look for: the pruned ``ReadSchema`` of the scan, partial
aggregates before each exchange, one exchange per neighbour step and per
tiled round, and the partition filter of a snapshot.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    from gridcast.config import FoldSpec, GridSpec, TEST_TICK_MS
    from gridcast.operators import align, densify_state, neighbour_step
    from gridcast.plans import tiled
    from gridcast.plans.fold import tick_fold
    from gridcast.plans.serve import snapshot_table
    from gridcast.session import local_session
    from gridcast.sources.readings import load_readings

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    grid = GridSpec(12, 8)
    aligned = align(load_readings(spark, sf, grid), TEST_TICK_MS, "avg")
    state = densify_state(spark, None, grid).repartition(4)
    src = aligned.where(aligned.tick == aligned.tick)  # any source frame
    sections = {
        "alignment (avg per tick and cell)": aligned,
        "one neighbour step": neighbour_step(state, src.select("i", "j", "f"), grid, FoldSpec()),
        "one tiled round (4 ticks, 6x4 tiles)": tiled.advance_tiles(
            state, src, 0, 4, grid, FoldSpec(), TEST_TICK_MS, (6, 4)
        ),
    }
    res = tick_fold(spark, aligned, grid, FoldSpec(), TEST_TICK_MS)
    sections["snapshot of one stored tick (one block read)"] = snapshot_table(spark, res.path, res.last_tick, grid)
    for title, df in sections.items():
        print(f"===== {title}")
        df.explain("formatted")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
