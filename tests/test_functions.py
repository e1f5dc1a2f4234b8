"""Golden cases for the column expressions (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from gridcast.config import GridSpec
from gridcast.functions import (
    cell_key,
    cell_key_i,
    cell_key_j,
    cell_label,
    coord_x,
    coord_y,
    is_left_stripe_edge,
    is_left_stripe_edge_nominal,
    is_right_stripe_edge,
    palette_bucket,
    red_scale,
    stripe_of,
    tick_index,
    tick_snap,
)


def test_tick_snap_halves_go_down(spark):
    df = spark.createDataFrame([(t,) for t in (149, 150, 151, 250, -50)], "time long")
    got = [r.tick for r in df.select(tick_snap("time", 100).alias("tick")).collect()]
    assert got == [100, 100, 200, 200, -100]


def test_tick_index_is_integer_division(spark):
    df = spark.createDataFrame([(0,), (99,), (100,), (86_400_000 * 3 + 5,)], "time long")
    got = [r.k for r in df.select(tick_index("time", 100).alias("k")).collect()]
    assert got == [0, 0, 1, 864_000 * 3]


def test_stripes_40_columns_6_stripes(spark):
    df = spark.range(40).select(F.col("id").cast("int").alias("i"))
    rows = df.select(
        "i",
        stripe_of("i", 40, 6).alias("s"),
        is_left_stripe_edge("i", 40, 6).alias("left"),
        is_right_stripe_edge("i", 40, 6).alias("right"),
        is_left_stripe_edge_nominal("i", 40, 6).alias("nominal"),
    ).orderBy("i").collect()
    assert [r.i for r in rows if r.left] == [7, 14, 20, 27, 34]
    assert [r.i for r in rows if r.right] == [6, 13, 19, 26, 33]
    assert [r.i for r in rows if r.nominal] == [7, 14, 21, 28, 35]
    assert rows[0].s == 0 and rows[39].s == 5


def test_cell_key_round_trip(spark):
    df = spark.createDataFrame([(3, 5), (0, 0), (11, 7)], "i int, j int")
    rows = df.select(
        cell_key("i", "j").alias("k"),
    ).select("k", cell_key_i("k").alias("i"), cell_key_j("k").alias("j")).collect()
    assert rows[0].k == 12884901893 and (rows[0].i, rows[0].j) == (3, 5)
    assert [(r.i, r.j) for r in rows] == [(3, 5), (0, 0), (11, 7)]


def test_cell_label(spark):
    df = spark.createDataFrame([(3, 5)], "i int, j int")
    assert df.select(cell_label("i", "j").alias("s")).first().s == "(3,5)"


def test_colour_and_bucket(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.7,), (-2.0,)], "u double")
    rows = df.select(red_scale("u").alias("c"), palette_bucket("u").alias("b")).collect()
    assert [r.c for r in rows] == ["#000000", "#7f0000", "#ff0000", "#000000"]
    assert [r.b for r in rows] == [0, 511, 1023, 0]


def test_coordinates_node_and_center(spark):
    g = GridSpec(5, 3, -10, 10, -1, 1)
    df = spark.createDataFrame([(0, 0), (4, 2)], "i int, j int")
    rows = df.select(
        coord_x("i", g).alias("x"), coord_y("j", g).alias("y"), coord_x("i", g, "center").alias("xc")
    ).collect()
    assert (rows[0].x, rows[0].y, rows[0].xc) == (-10.0, -1.0, -7.5)
    assert (rows[1].x, rows[1].y) == (10.0, 1.0)


def test_value_label_and_fold_spec_checks(spark):
    import warnings

    import pytest

    from gridcast.config import FoldSpec
    from gridcast.functions import value_label

    df = spark.createDataFrame([(1000, 2.5)], "time long, v double")
    assert df.select(value_label("time", "v").alias("s")).first().s == "Time: 1000 Temp: 2.5"
    with pytest.raises(ValueError):
        FoldSpec(edge="reflect")
    with pytest.raises(ValueError):
        FoldSpec(coeff=-0.1)
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        FoldSpec(coeff=0.3)
        assert any("negative self weight" in str(x.message) for x in w)
