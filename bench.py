"""Benchmark of the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is executed in full (results are written to the ``noop`` sink
or to the store, never collected).  The fold runs at a size that moves real
data: a 120 x 80 grid with hourly ticks over the 30 days of ``events``
(721 ticks x 9,600 cells); its throughput is reported as cell updates per
second next to the reference's published batch figure (about 1,500/s).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridcast.config import FoldSpec, GridSpec  # noqa: E402
from gridcast.operators import align, halo_rows, merge_halo, window_mean  # noqa: E402
from gridcast.plans.fold import tick_fold  # noqa: E402
from gridcast.plans.serve import replay_table, snapshot_table  # noqa: E402
from gridcast.session import local_session  # noqa: E402
from gridcast.sources.readings import load_readings  # noqa: E402

HOUR = 3_600_000
DAY = 86_400_000
BIG = GridSpec(120, 80)
SMALL = GridSpec(12, 8)
# 90 minutes for 5,000 steps of a 40 x 40 grid.
REFERENCE_CELL_UPDATES_PER_SEC = 1500
REFERENCE_SEC_PER_STEP = 1.08


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="gridcast-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # warm-up: JVM, Python workers, file listing
    _run(load_readings(spark, sf_dir, SMALL))

    big_readings = load_readings(spark, sf_dir, BIG)
    timed("align_hourly_avg", lambda: _run(align(big_readings, HOUR, "avg")))
    timed("align_hourly_last", lambda: _run(align(big_readings, HOUR, "last")))
    timed("window_daily_mean", lambda: _run(window_mean(big_readings, DAY, None, 0.1875)))
    timed(
        "halo_merge_hourly",
        lambda: _run(merge_halo(align(big_readings, HOUR, "last"), halo_rows(align(big_readings, HOUR, "last"), BIG.nx, 6, HOUR), 0.1875)),
    )
    res = timed(
        "fold_tiled_hourly_120x80",
        lambda: tick_fold(spark, align(big_readings, HOUR, "avg"), BIG, FoldSpec(), HOUR, method="tiled"),
    )
    n_ticks = (res.last_tick - res.first_tick) // HOUR + 1
    mid = res.first_tick + (n_ticks // 2) * HOUR
    timed("snapshot_one_tick", lambda: _run(snapshot_table(spark, res.path, mid, BIG)))
    timed("replay_24_ticks", lambda: _run(replay_table(spark, res.path, mid, mid + 23 * HOUR, BIG)))
    # the shape of the reference's published batch run: 40 x 40 cells,
    # 5,000 steps (the 30 days of readings cut into 518.4 s ticks)
    ref_grid, ref_tick = GridSpec(40, 40), 518_400
    ref = timed(
        "fold_tiled_40x40_5000_steps",
        lambda: tick_fold(spark, align(load_readings(spark, sf_dir, ref_grid), ref_tick, "avg"), ref_grid, FoldSpec(), ref_tick, method="tiled"),
    )
    ref_steps = (ref.last_tick - ref.first_tick) // ref_tick + 1
    # a large grid: 1,000 x 1,000 cells, daily ticks over all readings
    large = GridSpec(1000, 1000)
    lg = timed(
        "fold_tiled_daily_1000x1000",
        lambda: tick_fold(spark, align(load_readings(spark, sf_dir, large), DAY, "avg"), large, FoldSpec(), DAY),
    )
    lg_updates = ((lg.last_tick - lg.first_tick) // DAY + 1) * large.n_cells
    small = align(load_readings(spark, sf_dir, SMALL), DAY, "avg")
    timed("fold_step_daily_12x8", lambda: tick_fold(spark, small, SMALL, FoldSpec(), DAY, method="step"))
    timed("fold_tiled_daily_12x8", lambda: tick_fold(spark, small, SMALL, FoldSpec(), DAY, method="tiled"))

    from gridcast.streaming.queries import stream_fold, stream_window_avg_query

    timed("stream_fold_daily_12x8", lambda: _run(stream_fold(spark, sf_dir)))
    timed("stream_window_daily", lambda: _run(stream_window_avg_query(spark, sf_dir)))

    fold_sec = times["fold_tiled_hourly_120x80"]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "fold_ticks": n_ticks,
                "fold_cells": BIG.n_cells,
                "fold_cell_updates_per_sec": int(n_ticks * BIG.n_cells / fold_sec),
                "fold_1000x1000_cell_updates_per_sec": int(lg_updates / times["fold_tiled_daily_1000x1000"]),
                "fold_40x40_steps": ref_steps,
                "fold_40x40_sec_per_step": round(times["fold_tiled_40x40_5000_steps"] / ref_steps, 5),
                "reference_sec_per_step_40x40": REFERENCE_SEC_PER_STEP,
                "reference_cell_updates_per_sec": REFERENCE_CELL_UPDATES_PER_SEC,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
