"""Replay wrap-around, first-match branching, densify over a gap."""


from gridcast.config import GridSpec
from gridcast.operators import densify, halo_branch
from gridcast.plans.serve import replay_loop
from gridcast.sources.store import write_states


def test_replay_loop_wraps_to_first_tick(spark, tmp_dir):
    g = GridSpec(2, 2)
    st = spark.createDataFrame(
        [(t, i, j, float(t)) for t in (0, 100, 200) for i in range(2) for j in range(2)],
        "tick long, i int, j int, u double",
    )
    write_states(st, f"{tmp_dir}/s")
    r = replay_loop(spark, f"{tmp_dir}/s", 0, 3, 100, -1, 5, g)
    frames = [(row.frame, row.tick) for row in r.select("frame", "tick").distinct().orderBy("frame").collect()]
    assert frames == [(0, 200), (1, 0), (2, 100), (3, 200), (4, 0)]
    assert r.count() == 5 * 4


def test_branch_first_match_sends_both_edge_column_left_only(spark):
    df = spark.createDataFrame([(0, i, 0, 1.0) for i in range(3)], "tick long, i int, j int, f double")
    tags = {r.i: r.branch for r in halo_branch(df, 3, 3).collect()}
    # three one-column stripes: column 1 is a left and a right edge; first match wins
    assert tags == {0: 1, 1: 0, 2: 0}


def test_densify_fills_gap_tick_with_zeros(spark):
    g = GridSpec(2, 1)
    a = spark.createDataFrame([(100, 0, 0, 5.0), (300, 1, 0, 7.0)], "tick long, i int, j int, f double")
    d = densify(spark, a, g, 100, (100, 300)).orderBy("tick", "i").collect()
    assert [(r.tick, r.i, r.f) for r in d] == [(100, 0, 5.0), (100, 1, 0.0), (200, 0, 0.0), (200, 1, 0.0), (300, 0, 0.0), (300, 1, 7.0)]
