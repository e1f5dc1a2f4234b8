"""The streaming range join by buckets of time."""

import glob
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from gridcast.operators import range_join
from gridcast.schemas import READINGS
from gridcast.streaming.joins import range_join_stream
from gridcast.streaming.sinks import run, to_files
from gridcast.streaming.source import stream_readings


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("before,after,how", [(400, 150, "full"), (0, 0, "full"), (0, 333, "left"), (501, 7, "right"), (40, 3, "full")])
def test_stream_range_join_equals_the_batch_join(spark, tmp_dir, before, after, how):
    """Time is part of the stream's join keys; rows open at the end are left."""
    r = random.Random(before)
    rows = [(n, r.choice((r.randrange(60_000), 30_000 + r.randrange(50))), r.randrange(2), 0, float(n % 5)) for n in range(240)]
    rows += [(1000 + n, 200_000, 9, n % 2, 0.0) for n in range(4)]

    def sides(df):
        left = df.where("seq % 2 = 0").select("i", "j", "time", "gen")
        return left, df.where("seq % 2 = 1").select("i", "j", F.col("time").alias("h_time"), F.col("gen").alias("val"))

    spark.createDataFrame(rows, READINGS).write.parquet(f"{tmp_dir}/in")
    left, right = sides(stream_readings(spark, f"{tmp_dir}/in"))
    left = left.withColumn("ts", F.timestamp_millis("time")).withWatermark("ts", "10 seconds")
    right = right.withColumn("h_ts", F.timestamp_millis("h_time")).withWatermark("h_ts", "10 seconds")
    j = range_join_stream(left, right, ("i", "j"), "ts", "h_ts", before, after, how).drop("ts", "h_ts")
    assert "_r__bucket" in _plan(j)
    run(to_files(j, f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))
    got = spark.read.parquet(f"{tmp_dir}/out").select("i", "j", "time", "gen", "h_time", "val")
    left, right = sides(spark.createDataFrame(rows, READINGS))
    want = range_join(left, right, ("i", "j"), "time", "h_time", before, after, how)
    closed = "(time is not null and h_time is not null) or coalesce(time, h_time) < 100000"
    assert _rows(got) == _rows(want.where(closed)) and got.where("time is not null").count() > 50


def test_query_writes_the_columns_of_its_result(spark, tmp_dir):
    """Event times of every pair would be most of the files."""
    from gridcast.streaming.queries import stream_range_join

    start = 1_704_067_200
    r = random.Random(5)
    rows = [(n, start + r.randrange(5 * 86_400), r.randrange(60), "view", float(n), "{}") for n in range(600)]
    events = spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double, props string")
    events = events.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    events.coalesce(1).write.parquet(f"{tmp_dir}/made")
    os.mkdir(f"{tmp_dir}/sf")
    shutil.copy(*glob.glob(f"{tmp_dir}/made/part-*"), f"{tmp_dir}/sf/events.parquet")
    got = stream_range_join(spark, f"{tmp_dir}/sf")
    assert got.where("time is not null and h_time is not null").count() > 0
    written = spark.read.parquet(*got.inputFiles())
    assert written.columns == got.columns == ["i", "j", "time", "gen", "h_time", "val"]
