"""Command line: ``python -m gridcast {fold,stream,snapshot} ...``.

Meant for ``spark-submit`` (the session comes from the submit settings;
``--master`` is only a convenience for local runs).  Inputs are either
READINGS Parquet (``seq, time, i, j, gen``) or, with ``--events``, an
``events`` table mapped by the test-data adapter.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    b = SparkSession.builder.appName(f"gridcast-{args.cmd}")
    if args.master:
        b = b.master(args.master).config("spark.ui.enabled", "false")
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _grid(args):
    from gridcast.config import GridSpec

    return GridSpec(args.nx, args.ny, args.x0, args.x1, args.y0, args.y1)


def _spec(args):
    from gridcast.config import FoldSpec

    return FoldSpec(coeff=args.coeff, edge=args.edge, source_scale=args.source_scale)


def _readings(spark, args, grid):
    from gridcast.schemas import READINGS
    from gridcast.sources.readings import readings_from_events

    if args.events:
        return readings_from_events(spark.read.parquet(args.readings), grid)
    return spark.read.schema(READINGS).parquet(args.readings)


def cmd_fold(spark, args) -> None:
    from gridcast.operators import align
    from gridcast.plans.fold import tick_fold
    from gridcast.sources.store import to_results, upsert_results

    grid = _grid(args)
    aligned = align(_readings(spark, args, grid), args.tick_ms, args.dup)
    res = tick_fold(spark, aligned, grid, _spec(args), args.tick_ms, out_path=args.out, method=args.method)
    if res is None:
        print("no readings")
        return
    if args.results:
        upsert_results(
            spark, to_results(res.history(spark), grid, args.tick_ms, args.anchor), args.results,
            ("temp",), block_ticks=16,
        )
    print(f"stored ticks {res.first_tick - args.tick_ms}..{res.last_tick} in {res.path}")


def cmd_stream(spark, args) -> None:
    from gridcast.streaming.fold import stream_tick_fold
    from gridcast.streaming.sinks import run
    from gridcast.streaming.source import stream_readings

    grid = _grid(args)
    readings = stream_readings(spark, args.readings)
    q = stream_tick_fold(
        spark, readings, grid, _spec(args), args.tick_ms, args.delay_ms, args.out, args.checkpoint,
        dup=args.dup, trigger=args.trigger, results_path=args.results,
    )
    if args.trigger:
        q.awaitTermination()
    else:
        run(q)


def cmd_snapshot(spark, args) -> None:
    from gridcast.plans.serve import snapshot_table

    s = snapshot_table(spark, args.state, args.tick, _grid(args), args.anchor)
    s.orderBy("i", "j").write.mode("overwrite").parquet(args.out)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gridcast")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--nx", type=int, required=True)
        sp.add_argument("--ny", type=int, required=True)
        for name, val in (("x0", -10.0), ("x1", 10.0), ("y0", -10.0), ("y1", 10.0)):
            sp.add_argument(f"--{name}", type=float, default=val)
        sp.add_argument("--tick-ms", type=int, default=100)
        sp.add_argument("--coeff", type=float, default=0.1875)
        sp.add_argument("--edge", choices=("zero", "fixed"), default="zero")
        sp.add_argument("--source-scale", type=float, default=1.0)
        sp.add_argument("--dup", choices=("last", "avg", "sum"), default="last")
        sp.add_argument("--anchor", choices=("node", "center"), default="node")

    f = sub.add_parser("fold", help="fold a table of readings; store every tick")
    common(f)
    f.add_argument("--readings", required=True)
    f.add_argument("--events", action="store_true", help="input is an events table")
    f.add_argument("--out", required=True)
    f.add_argument("--results", default=None, help="also upsert (tick_index, x, y, temp) here")
    f.add_argument("--method", choices=("tiled", "step", "auto"), default="tiled",
                   help="tiled: fewest jobs (a grid of up to 128 x 128 cells in one task); step: every step over all tasks; auto: step on such grids")

    s = sub.add_parser("stream", help="fold a stream of READINGS files")
    common(s)
    s.add_argument("--readings", required=True, help="folder watched for READINGS Parquet files")
    s.add_argument("--delay-ms", type=int, default=100)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--results", default=None)
    s.add_argument("--trigger", default=None, help='e.g. "200 milliseconds"; default: available now')

    n = sub.add_parser("snapshot", help="export one stored tick with coordinates and colours")
    common(n)
    n.add_argument("--state", required=True)
    n.add_argument("--tick", type=int, required=True, help="tick in ms")
    n.add_argument("--out", required=True)

    args = p.parse_args(argv)
    spark = _session(args)
    {"fold": cmd_fold, "stream": cmd_stream, "snapshot": cmd_snapshot}[args.cmd](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
