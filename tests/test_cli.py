"""The command line runs the batch fold and the snapshot export."""

from gridcast.__main__ import main
from gridcast.sources.store import read_results, read_states


def test_cli_fold_and_snapshot(spark, tmp_dir):
    args = ["--nx", "12", "--ny", "8", "--tick-ms", "86400000"]
    assert main(["fold", *args, "--readings", "/root/testdata/sf0.001/events.parquet", "--events",
                 "--dup", "avg", "--out", f"{tmp_dir}/h", "--results", f"{tmp_dir}/r"]) == 0
    h = read_states(spark, f"{tmp_dir}/h")
    assert h.count() == 32 * 96
    assert read_results(spark, f"{tmp_dir}/r").count() == 32 * 96
    assert main(["snapshot", *args, "--state", f"{tmp_dir}/h", "--tick", "1704931200000", "--out", f"{tmp_dir}/s"]) == 0
    s = spark.read.parquet(f"{tmp_dir}/s")
    assert s.count() == 96 and {"x", "y", "temp", "colour", "bucket"} <= set(s.columns)


def test_cli_stream_matches_batch_on_closed_ticks(spark, tmp_dir):
    from pyspark.sql import functions as F

    from gridcast.config import FoldSpec, GridSpec
    from gridcast.operators import align
    from gridcast.plans.fold import tick_fold
    from gridcast.sources.readings import load_readings

    day = 86_400_000
    r = load_readings(spark, "/root/testdata/sf0.001")
    r.write.parquet(f"{tmp_dir}/in")
    assert main(["stream", "--nx", "12", "--ny", "8", "--tick-ms", str(day), "--delay-ms", str(day),
                 "--dup", "avg", "--readings", f"{tmp_dir}/in", "--out", f"{tmp_dir}/state",
                 "--checkpoint", f"{tmp_dir}/ck"]) == 0
    streamed = read_states(spark, f"{tmp_dir}/state")
    batch = tick_fold(spark, align(r, day, "avg"), GridSpec(12, 8), FoldSpec(), day).history(spark)
    last = streamed.agg(F.max("tick")).first()[0]
    j = streamed.alias("s").join(batch.where(F.col("tick") <= last).alias("b"), ["tick", "i", "j"], "full")
    assert j.where(F.col("s.u").isNull() | F.col("b.u").isNull()).count() == 0
    assert j.select(F.max(F.abs(F.col("s.u") - F.col("b.u")))).first()[0] < 1e-9
