"""Registered queries over the test tables, each with a DuckDB twin.

Every query reads ``events`` (or data Spark derives from it) in full.  The
test-data adapter maps it onto a 12 x 8 grid with daily ticks (see
``gridcast.sources.readings``).  Doubles produced by arithmetic are
compared as ``floor(x * 1e6 + 0.41421356)`` in both engines (columns with
an ``_e6`` suffix): summation order differs between engines and exact
decimal ties would otherwise round differently.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, duckdb_sql or None)``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcast.config import TEST_GRID, TEST_TICK_MS, FoldSpec, GridSpec, scratch_path
from gridcast.functions import (
    cell_key,
    cell_key_i,
    cell_key_j,
    cell_label,
    coord_x,
    coord_y,
    event_time,
    is_domain_edge,
    is_interior,
    is_left_stripe_edge,
    is_left_stripe_edge_nominal,
    is_right_stripe_edge,
    is_right_stripe_edge_nominal,
    palette_bucket,
    red_scale,
    stripe_of,
    tick_index,
    tick_snap,
    value_label,
)
from gridcast.operators import (
    align,
    align_windows,
    contributions,
    densify,
    halo_branch,
    halo_rows,
    hopping_mean,
    latest_per_cell,
    merge_halo,
    neighbour_step,
    range_join,
    range_partition,
    readings_per_tick,
    split_by_grid,
    step_by_lookup,
    striped_step,
    reading_bounds,
    window_mean,
)
from gridcast.plans.changes import replay_changes, write_changes
from gridcast.plans.fold import tick_fold
from gridcast.plans.serve import replay_loop, replay_table, snapshot_table
from gridcast.sources.bucketed import bucketed, merge_halo_bucketed, with_state
from gridcast.sources.cells import history_of_rectangle, write_cells
from gridcast.sources.readings import (
    grid_scaffold,
    load_readings,
    read_json_readings,
    readings_dump,
    readings_to_json,
)
from gridcast.sources.store import read_results, results_at, to_results, upsert_results
from gridcast.streaming import queries as sq

# Fixed parameters of the registered queries.
GRID = TEST_GRID
NX, NY = GRID.nx, GRID.ny
T = TEST_TICK_MS
C = 0.1875
N_STRIPES = 5
SOURCE_SCALE = 0.25
COLOUR_RANGE = 100.0
DAY = 86_400_000
SNAPSHOT_OFFSET_TICKS = 10
REPLAY_TICKS = 5
FOLD_SPEC = FoldSpec(coeff=C, edge="zero")
SMALL_TILE = (5, 3)

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return deco


def q6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * F.lit(1e6) + F.lit(0.41421356)).cast("long")


def _r(spark: SparkSession, sf: str) -> DataFrame:
    return load_readings(spark, sf, GRID)


def _aligned(spark: SparkSession, sf: str, dup: str) -> DataFrame:
    return align(_r(spark, sf), T, dup)


# ---------------------------------------------------------------- SQL parts


def Q(x: str) -> str:
    return f"CAST(floor(({x}) * 1000000.0::DOUBLE + 0.41421356::DOUBLE) AS BIGINT)"


def D(v: float) -> str:
    return f"{float(v)!r}::DOUBLE"


R_SQL = f"""readings AS (
  SELECT CAST(event_id AS BIGINT) AS seq, epoch_us(ts) // 1000 AS time,
         CAST(user_id % {NX} AS INTEGER) AS i, CAST(event_id % {NY} AS INTEGER) AS j,
         CAST(value AS DOUBLE) AS gen
  FROM events)"""
TICK_SQL = f"CAST(ceil(time / {D(T)} - {D(0.5)}) * {T} AS BIGINT)"
TICKED_SQL = f"ticked AS (SELECT *, {TICK_SQL} AS tick FROM readings)"
LAST_SQL = """last_rows AS (
  SELECT tick, i, j, arg_max(gen, struct_pack(t := time, s := seq, v := gen)) AS f
  FROM ticked GROUP BY tick, i, j)"""
AVG_SQL = "avg_rows AS (SELECT tick, i, j, avg(gen) AS f FROM ticked GROUP BY tick, i, j)"
CELLS_SQL = f"cells AS (SELECT CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j FROM range({NX}) a(i), range({NY}) b(j))"
BASE = f"WITH {R_SQL},\n{TICKED_SQL},\n{LAST_SQL},\n{AVG_SQL},\n{CELLS_SQL}"


def X(i: str, anchor: str = "node") -> str:
    s = f"({D(GRID.x0)} + CAST({i} AS DOUBLE) * {D(GRID.dx)})"
    return f"({s} + {D(GRID.dx / 2.0)})" if anchor == "center" else s


def Y(j: str, anchor: str = "node") -> str:
    s = f"({D(GRID.y0)} + CAST({j} AS DOUBLE) * {D(GRID.dy)})"
    return f"({s} + {D(GRID.dy / 2.0)})" if anchor == "center" else s


def INTERIOR(i: str, j: str) -> str:
    return f"({i} > 0 AND {i} < {NX - 1} AND {j} > 0 AND {j} < {NY - 1})"


def INDOMAIN(i: str, j: str) -> str:
    return f"({i} >= 0 AND {i} < {NX} AND {j} >= 0 AND {j} < {NY})"


def STRIPE(i: str) -> str:
    return f"(({i}) * {N_STRIPES} // {NX})"


def CLAMP(u: str) -> str:
    return f"least(greatest({u}, {D(0.0)}), {D(1.0)})"


def RED(u: str) -> str:
    return f"printf('#%02x0000', CAST(trunc({CLAMP(u)} * {D(255.9)}) AS INTEGER))"


def BUCKET(u: str, levels: int = 1024) -> str:
    return f"least(CAST(trunc({CLAMP(u)} * {D(levels * 0.9999)}) AS INTEGER), {levels - 1})"


WEIGHTS_SQL = f"""w AS (SELECT * FROM (VALUES (0, 0, {D(1 - 4 * C)}), (-1, 0, {D(C)}), (1, 0, {D(C)}),
  (0, -1, {D(C)}), (0, 1, {D(C)})) t(di, dj, w))"""


def fold_sql(edge: str = "zero", src: str = "avg_rows", upto: str = "b.t1") -> str:
    """Recursive fold ``u_k = step(u_{k-1}) + f_k`` from a zero grid at
    ``t0 - T``; yields CTE ``hist(tick, i, j, u)``."""
    if edge == "zero":
        ok = INDOMAIN("u.i + w.di", "u.j + w.dj")
        wt = "w.w"
        src_ok = "TRUE"
    else:
        ok = f"((w.di = 0 AND w.dj = 0) OR {INTERIOR('u.i + w.di', 'u.j + w.dj')})"
        wt = f"CASE WHEN w.di = 0 AND w.dj = 0 AND NOT {INTERIOR('u.i', 'u.j')} THEN {D(1.0)} ELSE w.w END"
        src_ok = INTERIOR("g.i", "g.j")
    return f""",
{WEIGHTS_SQL},
b AS (SELECT min(tick) AS t0, max(tick) AS t1 FROM {src}),
nsteps AS (SELECT ({upto} - b.t0) // {T} AS n, b.t0 FROM b),
u(k, i, j, u) AS (
  SELECT -1, i, j, {D(0.0)} FROM cells
  UNION ALL
  SELECT g.k, g.i, g.j, g.v + CASE WHEN {src_ok} THEN coalesce(s.f, {D(0.0)}) ELSE {D(0.0)} END
  FROM (
    SELECT u.k + 1 AS k, u.i + w.di AS i, u.j + w.dj AS j, sum(u.u * {wt}) AS v
    FROM u, w, nsteps
    WHERE u.k < nsteps.n AND {ok}
    GROUP BY 1, 2, 3) g
  CROSS JOIN nsteps
  LEFT JOIN {src} s ON s.tick = nsteps.t0 + CAST(g.k AS BIGINT) * {T} AND s.i = g.i AND s.j = g.j
),
hist AS (SELECT CAST(nsteps.t0 + CAST(u.k AS BIGINT) * {T} AS BIGINT) AS tick, CAST(u.i AS INTEGER) AS i,
                CAST(u.j AS INTEGER) AS j, u.u AS u FROM u, nsteps)"""


RBASE = f"WITH {R_SQL}"
FOLD_BASE = BASE.replace("WITH ", "WITH RECURSIVE ", 1)


# ------------------------------------------------------ projections (P*, S5)


@register("readings", f"{RBASE} SELECT seq, time, i, j, gen FROM readings")
def q_readings(spark, sf):
    return _r(spark, sf).select("seq", "time", "i", "j", "gen")


@register(
    "readings_dump",
    f"{RBASE} SELECT (CAST(i AS BIGINT) << 32) + j AS cell_key, time, gen FROM readings",
)
def q_readings_dump(spark, sf):
    return readings_dump(_r(spark, sf))


@register("tick_snap", f"{RBASE} SELECT seq, time, {TICK_SQL} AS tick FROM readings")
def q_tick_snap(spark, sf):
    return _r(spark, sf).select("seq", "time", tick_snap("time", T).alias("tick"))


@register(
    "tick_index",
    f"{RBASE} SELECT seq, {TICK_SQL} AS tick, {TICK_SQL} // {T} AS tick_index, time // {T} AS time_index FROM readings",
)
def q_tick_index(spark, sf):
    r = _r(spark, sf).withColumn("tick", tick_snap("time", T))
    return r.select("seq", "tick", tick_index("tick", T).alias("tick_index"), tick_index("time", T).alias("time_index"))


@register(
    "event_time",
    f"{RBASE} SELECT seq, strftime(epoch_ms(time), '%Y-%m-%d %H:%M:%S.%g') AS event_time_text FROM readings",
)
def q_event_time(spark, sf):
    return _r(spark, sf).select(
        "seq", F.date_format(event_time("time"), "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time_text")
    )


@register(
    "cell_coords_node",
    f"{RBASE} SELECT seq, i, j, {Q(X('i'))} AS x_e6, {Q(Y('j'))} AS y_e6 FROM readings",
)
def q_coords_node(spark, sf):
    return _r(spark, sf).select(
        "seq", "i", "j", q6(coord_x("i", GRID)).alias("x_e6"), q6(coord_y("j", GRID)).alias("y_e6")
    )


@register(
    "cell_coords_center",
    f"{RBASE} SELECT seq, i, j, {Q(X('i', 'center'))} AS x_e6, {Q(Y('j', 'center'))} AS y_e6 FROM readings",
)
def q_coords_center(spark, sf):
    return _r(spark, sf).select(
        "seq",
        "i",
        "j",
        q6(coord_x("i", GRID, "center")).alias("x_e6"),
        q6(coord_y("j", GRID, "center")).alias("y_e6"),
    )


@register("interior_cells", f"{RBASE} SELECT seq, i, j FROM readings WHERE {INTERIOR('i', 'j')}")
def q_interior(spark, sf):
    return _r(spark, sf).where(is_interior("i", "j", GRID)).select("seq", "i", "j")


@register(
    "edge_flags",
    f"{RBASE} SELECT seq, i, j, (i = 0 OR i = {NX - 1} OR j = 0 OR j = {NY - 1}) AS is_edge FROM readings",
)
def q_edge_flags(spark, sf):
    return _r(spark, sf).select("seq", "i", "j", is_domain_edge("i", "j", GRID).alias("is_edge"))


@register("stripe_id", f"{RBASE} SELECT seq, i, CAST({STRIPE('i')} AS INTEGER) AS stripe FROM readings")
def q_stripe_id(spark, sf):
    return _r(spark, sf).select("seq", "i", stripe_of("i", NX, N_STRIPES).alias("stripe"))


@register(
    "stripe_edges",
    f"""{RBASE} SELECT seq, i,
      (i > 0 AND {STRIPE('i')} <> {STRIPE('i - 1')}) AS left_edge,
      (i < {NX - 1} AND {STRIPE('i')} <> {STRIPE('i + 1')}) AS right_edge
    FROM readings""",
)
def q_stripe_edges(spark, sf):
    return _r(spark, sf).select(
        "seq",
        "i",
        is_left_stripe_edge("i", NX, N_STRIPES).alias("left_edge"),
        is_right_stripe_edge("i", NX, N_STRIPES).alias("right_edge"),
    )


_W = -(-NX // N_STRIPES)


@register(
    "stripe_edges_nominal",
    f"""{RBASE} SELECT seq, i, (i <> 0 AND i % {_W} = 0) AS left_edge,
      (i <> {NX - 1} AND i % {_W} = {_W - 1}) AS right_edge FROM readings""",
)
def q_stripe_edges_nominal(spark, sf):
    return _r(spark, sf).select(
        "seq",
        "i",
        is_left_stripe_edge_nominal("i", NX, N_STRIPES).alias("left_edge"),
        is_right_stripe_edge_nominal("i", NX, N_STRIPES).alias("right_edge"),
    )


@register("cell_key_pack", f"{RBASE} SELECT seq, (CAST(i AS BIGINT) << 32) + j AS cell_key FROM readings")
def q_key_pack(spark, sf):
    return _r(spark, sf).select("seq", cell_key("i", "j").alias("cell_key"))


@register(
    "cell_key_unpack",
    f"""{RBASE}, k AS (SELECT seq, (CAST(i AS BIGINT) << 32) + j AS cell_key FROM readings)
    SELECT seq, CAST(cell_key >> 32 AS INTEGER) AS ki, CAST(cell_key & 4294967295 AS INTEGER) AS kj FROM k""",
)
def q_key_unpack(spark, sf):
    k = _r(spark, sf).select("seq", cell_key("i", "j").alias("cell_key"))
    return k.select("seq", cell_key_i("cell_key").alias("ki"), cell_key_j("cell_key").alias("kj"))


@register("cell_label", f"{RBASE} SELECT seq, printf('(%d,%d)', i, j) AS label FROM readings")
def q_cell_label(spark, sf):
    return _r(spark, sf).select("seq", cell_label("i", "j").alias("label"))


@register("value_label", f"{RBASE} SELECT seq, printf('Time: %d Temp: %d', time, CAST(floor(gen) AS BIGINT)) AS label FROM readings")
def q_value_label(spark, sf):
    return _r(spark, sf).select("seq", value_label("time", F.floor("gen")).alias("label"))


@register(
    "cell_rank_order",
    f"""{RBASE}, c AS (SELECT DISTINCT i, j FROM readings)
    SELECT i, j, i * {NY} + j AS cell_ord,
           CAST(row_number() OVER (PARTITION BY i ORDER BY j) AS INTEGER) AS rank_in_column FROM c""",
)
def q_cell_rank(spark, sf):
    # The per-column window holds at most ny rows; the global order is the
    # arithmetic position i*ny + j (no single-partition global window).
    c = _r(spark, sf).select("i", "j").distinct()
    w = Window.partitionBy("i").orderBy("j")
    return c.select(
        "i",
        "j",
        (F.col("i") * F.lit(NY) + F.col("j")).alias("cell_ord"),
        F.row_number().over(w).cast("int").alias("rank_in_column"),
    )


@register(
    "source_scaled",
    f"{BASE} SELECT tick, i, j, {Q(f'f * {D(SOURCE_SCALE)}')} AS f_e6 FROM avg_rows",
)
def q_source_scaled(spark, sf):
    a = _aligned(spark, sf, "avg")
    return a.select("tick", "i", "j", q6(F.col("f") * F.lit(SOURCE_SCALE)).alias("f_e6"))


@register("red_scale", f"{RBASE} SELECT seq, {RED(f'gen / {D(COLOUR_RANGE)}')} AS colour FROM readings")
def q_red_scale(spark, sf):
    return _r(spark, sf).select("seq", red_scale(F.col("gen") / F.lit(COLOUR_RANGE)).alias("colour"))


@register("palette_bucket", f"{RBASE} SELECT seq, {BUCKET(f'gen / {D(COLOUR_RANGE)}')} AS bucket FROM readings")
def q_palette_bucket(spark, sf):
    return _r(spark, sf).select("seq", palette_bucket(F.col("gen") / F.lit(COLOUR_RANGE)).alias("bucket"))


@register("json_readings", f"{RBASE} SELECT time, i, j, gen FROM readings")
def q_json_readings(spark, sf):
    path = scratch_path(spark, "json-readings")
    readings_to_json(_r(spark, sf)).write.mode("overwrite").text(path)
    return read_json_readings(spark, path).select("time", "i", "j", "gen")


# ---------------------------------------------- scaffold, densify, aggregates


@register(
    "grid_scaffold",
    f"""{BASE}, n AS (SELECT i, j, count(*) AS n FROM readings GROUP BY i, j)
    SELECT c.i, c.j, coalesce(n.n, 0) AS n_readings FROM cells c LEFT JOIN n ON c.i = n.i AND c.j = n.j""",
)
def q_grid_scaffold(spark, sf):
    n = _r(spark, sf).groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))
    return grid_scaffold(spark, GRID).join(n, ["i", "j"], "left").select(
        "i", "j", F.coalesce("n", F.lit(0)).cast("long").alias("n_readings")
    )


@register(
    "densified_ticks",
    f"""{BASE}, b AS (SELECT min(tick) AS t0, max(tick) AS t1 FROM avg_rows),
    t AS (SELECT unnest(generate_series(t0, t1, {T})) AS tick FROM b)
    SELECT t.tick, c.i, c.j, {Q(f'coalesce(a.f, {D(0.0)})')} AS f_e6
    FROM t, cells c LEFT JOIN avg_rows a ON a.tick = t.tick AND a.i = c.i AND a.j = c.j""",
)
def q_densified(spark, sf):
    r = _r(spark, sf)
    d = densify(spark, align(r, T, "avg"), GRID, T, reading_bounds(r, T))
    return d.select("tick", "i", "j", q6("f").alias("f_e6"))


@register(
    "latest_per_cell",
    f"""{RBASE} SELECT i, j, max(time) AS time, arg_max(gen, struct_pack(t := time, s := seq, v := gen)) AS gen
    FROM readings GROUP BY i, j""",
)
def q_latest_cell(spark, sf):
    return latest_per_cell(_r(spark, sf))


@register("latest_per_tick", f"{BASE} SELECT tick, i, j, f FROM last_rows")
def q_latest_tick(spark, sf):
    return _aligned(spark, sf, "last")


@register("sum_per_tick", f"{BASE} SELECT tick, i, j, {Q('sum(gen)')} AS f_e6 FROM ticked GROUP BY tick, i, j")
def q_sum_tick(spark, sf):
    return _aligned(spark, sf, "sum").select("tick", "i", "j", q6("f").alias("f_e6"))


@register("avg_per_tick", f"{BASE} SELECT tick, i, j, {Q('f')} AS f_e6 FROM avg_rows")
def q_avg_tick(spark, sf):
    return _aligned(spark, sf, "avg").select("tick", "i", "j", q6("f").alias("f_e6"))


def _window_sql(size: int, slide: int | None) -> str:
    if slide is None:
        starts = f"[(time // {size}) * {size}]"
    else:
        k = size // slide
        starts = "[" + ", ".join(f"(time // {slide}) * {slide} - {m * slide}" for m in range(k)) + "]"
    return f"""{RBASE}, ws AS (SELECT unnest({starts}) AS ws, i, j, gen FROM readings)
    SELECT CAST(ws + {size} AS BIGINT) AS time, i, j, {Q(f'{D(C)} * sum(gen) / count(*)')} AS f_e6,
           count(*) AS n_readings
    FROM ws GROUP BY ws, i, j"""


@register("avg_per_window", _window_sql(DAY, None))
def q_avg_window(spark, sf):
    w = window_mean(_r(spark, sf), DAY, None, C)
    return w.select("time", "i", "j", q6("f").alias("f_e6"), "n_readings")


@register("avg_hopping", _window_sql(2 * DAY, DAY))
def q_avg_hopping(spark, sf):
    w = window_mean(_r(spark, sf), 2 * DAY, DAY, C)
    return w.select("time", "i", "j", q6("f").alias("f_e6"), "n_readings")


@register("readings_per_tick", f"{BASE} SELECT tick, count(*) AS n_readings FROM ticked GROUP BY tick")
def q_readings_per_tick(spark, sf):
    return readings_per_tick(_r(spark, sf), T)


# ------------------------------------------------------------ neighbour step


@register(
    "contributions",
    f"""{BASE},
{WEIGHTS_SQL}
    SELECT a.tick, CAST(a.i + w.di AS INTEGER) AS i, CAST(a.j + w.dj AS INTEGER) AS j, {Q('a.f * w.w')} AS v_e6
    FROM avg_rows a, w WHERE {INDOMAIN('a.i + w.di', 'a.j + w.dj')}""",
)
def q_contributions(spark, sf):
    st = _aligned(spark, sf, "avg").withColumnRenamed("f", "u")
    c = contributions(st, GRID, FOLD_SPEC, keys=("tick",))
    return c.select("tick", "i", "j", q6("v").alias("v_e6"))


def _step_sql(edge: str) -> str:
    if edge == "zero":
        ok, wt, src_ok = INDOMAIN("d.i + w.di", "d.j + w.dj"), "w.w", "TRUE"
    else:
        ok = f"((w.di = 0 AND w.dj = 0) OR {INTERIOR('d.i + w.di', 'd.j + w.dj')})"
        wt = f"CASE WHEN w.di = 0 AND w.dj = 0 AND NOT {INTERIOR('d.i', 'd.j')} THEN {D(1.0)} ELSE w.w END"
        src_ok = INTERIOR("g.i", "g.j")
    return f"""{BASE},
{WEIGHTS_SQL},
b AS (SELECT min(tick) AS t0, max(tick) AS t1 FROM avg_rows),
t AS (SELECT unnest(generate_series(t0, t1, {T})) AS tick FROM b),
d AS (SELECT t.tick, c.i, c.j, coalesce(a.f, {D(0.0)}) AS u
      FROM t, cells c LEFT JOIN avg_rows a ON a.tick = t.tick AND a.i = c.i AND a.j = c.j),
g AS (SELECT d.tick + {T} AS tick, d.i + w.di AS i, d.j + w.dj AS j, sum(d.u * {wt}) AS v
      FROM d, w WHERE {ok} GROUP BY 1, 2, 3)
SELECT CAST(g.tick AS BIGINT) AS tick, CAST(g.i AS INTEGER) AS i, CAST(g.j AS INTEGER) AS j,
       {Q(f'g.v + CASE WHEN {src_ok} THEN coalesce(a.f, {D(0.0)}) ELSE {D(0.0)} END')} AS u_e6
FROM g LEFT JOIN avg_rows a ON a.tick = g.tick AND a.i = g.i AND a.j = g.j"""


def _step_inputs(spark, sf):
    """Dense per-tick state (u = that tick's mean reading, 0 if none) moved
    to the next tick, and the next tick's readings as the source."""
    bounds = reading_bounds(_r(spark, sf), T)
    a = _aligned(spark, sf, "avg")
    d = densify(spark, a, GRID, T, bounds)
    state = d.select((F.col("tick") + F.lit(T)).alias("tick"), "i", "j", F.col("f").alias("u"))
    src = a.where(F.col("tick") > F.lit(bounds[0]))
    return state, src


def _step_query(edge: str, lookup: bool = False):
    def fn(spark, sf):
        state, src = _step_inputs(spark, sf)
        spec = FOLD_SPEC.with_(edge=edge)
        op = step_by_lookup if lookup else neighbour_step
        return op(state, src, GRID, spec, keys=("tick",)).select("tick", "i", "j", q6("u").alias("u_e6"))

    return fn


register("step_zero_edge", _step_sql("zero"))(_step_query("zero"))
register("step_fixed_edge", _step_sql("fixed"))(_step_query("fixed"))
def _striped(n_stripes: int):
    def fn(spark, sf):
        state, src = _step_inputs(spark, sf)
        before = state.select((F.col("tick") - F.lit(T)).alias("tick"), "i", "j", "u")
        return striped_step(before, src, GRID, FOLD_SPEC, n_stripes, T).select("tick", "i", "j", q6("u").alias("u_e6"))

    return fn


register("step_striped", _step_sql("zero"))(_striped(N_STRIPES))
register("step_striped_3", _step_sql("zero"))(_striped(3))
register("step_striped_1", _step_sql("zero"))(_striped(1))
register("step_by_lookup", _step_sql("zero"))(_step_query("zero", lookup=True))
register("step_by_lookup_fixed", _step_sql("fixed"))(_step_query("fixed", lookup=True))


# ------------------------------------------------------------------ the fold


def _fold(spark, sf, method: str, edge: str = "zero", tile=None, steps=None, dup: str = "avg"):
    a = _aligned(spark, sf, dup)
    res = tick_fold(spark, a, GRID, FOLD_SPEC.with_(edge=edge), T, method=method, tile=tile, steps_per_round=steps)
    return res


def _hist_q(h: DataFrame) -> DataFrame:
    return h.select("tick", "i", "j", q6("u").alias("u_e6"))


HIST_SQL = f"{FOLD_BASE}{fold_sql('zero')}\nSELECT tick, i, j, {Q('u')} AS u_e6 FROM hist"
HIST_FIXED_SQL = f"{FOLD_BASE}{fold_sql('fixed')}\nSELECT tick, i, j, {Q('u')} AS u_e6 FROM hist"


@register("fold_history", HIST_SQL)
def q_fold_history(spark, sf):
    return _hist_q(_fold(spark, sf, "step").history(spark))


@register("fold_tiled", HIST_SQL)
def q_fold_tiled(spark, sf):
    return _hist_q(_fold(spark, sf, "tiled", tile=SMALL_TILE, steps=3).history(spark))


@register("fold_fixed_edge", HIST_FIXED_SQL)
def q_fold_fixed(spark, sf):
    return _hist_q(_fold(spark, sf, "tiled", edge="fixed", tile=SMALL_TILE, steps=4).history(spark))


@register(
    "fold_final",
    f"{FOLD_BASE}{fold_sql('zero')}\nSELECT tick, i, j, {Q('u')} AS u_e6 FROM hist WHERE tick = (SELECT max(tick) FROM hist)",
)
def q_fold_final(spark, sf):
    return _hist_q(_fold(spark, sf, "auto").final(spark))


WITH_STATE_SQL = f"""{FOLD_BASE}{fold_sql('zero')}
    SELECT l.tick, l.i, l.j, l.f, {Q(f'coalesce(h.u, {D(0.0)})')} AS u_prev_e6
    FROM last_rows l LEFT JOIN hist h ON h.tick = l.tick - {T} AND h.i = l.i AND h.j = l.j"""


@register("readings_with_state", WITH_STATE_SQL)
def q_readings_with_state(spark, sf):
    h = _fold(spark, sf, "auto").history(spark)
    prev = h.select((F.col("tick") + F.lit(T)).alias("tick"), "i", "j", F.col("u").alias("u_prev"))
    a = _aligned(spark, sf, "last")
    return a.join(prev, ["tick", "i", "j"], "left").select(
        "tick", "i", "j", "f", q6(F.coalesce("u_prev", F.lit(0.0))).alias("u_prev_e6")
    )


# ------------------------------------------------------ store, serve, replay


@register(
    "store_upsert",
    f"""{BASE} SELECT tick // {T} AS tick_index, {Q(X('i'))} AS x_e6, {Q(Y('j'))} AS y_e6, f AS temp FROM last_rows""",
)
def q_store_upsert(spark, sf):
    r = _r(spark, sf).withColumn("tick", tick_snap("time", T))
    rows = r.select(
        F.call_function("div", F.col("tick"), F.lit(T)).cast("long").alias("tick_index"),
        coord_x("i", GRID).alias("x"),
        coord_y("j", GRID).alias("y"),
        F.col("gen").alias("temp"),
        "time",
        "seq",
    )
    path = scratch_path(spark, "results")
    block = max(1, (1 << 16) // GRID.n_cells)
    upsert_results(spark, rows, path, version=("time", "seq"), block_ticks=block)
    upsert_results(spark, rows, path, version=("time", "seq"), block_ticks=block)  # replayed batch: no change
    res = read_results(spark, path)
    return res.select("tick_index", q6("x").alias("x_e6"), q6("y").alias("y_e6"), "temp")


def window_rows_sql(size: int, slide: int) -> str:
    """Windowed means as aligned rows: CTE ``win_rows(tick, i, j, f)``."""
    starts = "[" + ", ".join(f"(time // {slide}) * {slide} - {m * slide}" for m in range(size // slide)) + "]"
    return f""", win_rows AS (SELECT CAST(ws + {size} AS BIGINT) AS tick, i, j, {D(C)} * sum(gen) / count(*) AS f
    FROM (SELECT unnest({starts}) AS ws, i, j, gen FROM readings) GROUP BY ws, i, j)"""


@register(
    "fold_hopping",
    f"{FOLD_BASE}{window_rows_sql(2 * DAY, DAY)}{fold_sql('zero', 'win_rows')}\nSELECT tick, i, j, {Q('u')} AS u_e6 FROM hist",
)
def q_fold_hopping(spark, sf):
    """The fold fed by hopping means: two-day windows, one tick a day."""
    a = align_windows(_r(spark, sf), 2 * DAY, DAY, C)
    return _hist_q(tick_fold(spark, a, GRID, FOLD_SPEC, DAY, method="step").history(spark))


RESULT_TICK_SQL = f"(SELECT min(tick) // {T} + {SNAPSHOT_OFFSET_TICKS} FROM ticked)"


@register(
    "results_at_tick",
    f"""{BASE} SELECT tick // {T} AS tick_index, {Q(X('i'))} AS x_e6, {Q(Y('j'))} AS y_e6, f AS temp FROM last_rows
    WHERE tick // {T} = {RESULT_TICK_SQL}""",
)
def q_results_at(spark, sf):
    """Point read of the results table by tick index, as the viewers do."""
    a = _aligned(spark, sf, "last")
    rows = to_results(a.withColumnRenamed("f", "u"), GRID, T)
    path = scratch_path(spark, "results")
    upsert_results(spark, rows, path, ("temp",), block_ticks=4)
    first = read_results(spark, path).agg(F.min("tick_index")).first()[0]
    res = results_at(spark, path, first + SNAPSHOT_OFFSET_TICKS)
    return res.select("tick_index", q6("x").alias("x_e6"), q6("y").alias("y_e6"), "temp")


NARROW = GridSpec(9, 6)


@register(
    "rejected_readings",
    f"""{RBASE} SELECT seq, i, j, NOT (i < {NARROW.nx} AND j < {NARROW.ny}) AS rejected FROM readings""",
)
def q_rejected(spark, sf):
    """Readings of a larger grid than the fold's: kept and rejected rows."""
    kept, rest = split_by_grid(_r(spark, sf), NARROW)
    return kept.select("seq", "i", "j", F.lit(False).alias("rejected")).union(rest.select("seq", "i", "j", F.lit(True)))


@register(
    "fold_rejects",
    f"""{BASE} SELECT tick, i, j, {Q('f')} AS f_e6 FROM avg_rows WHERE NOT (i < {NARROW.nx} AND j < {NARROW.ny})""",
)
def q_fold_rejects(spark, sf):
    """The rows a fold of the smaller grid could not take."""
    rejects = scratch_path(spark, "rejects")
    tick_fold(spark, _aligned(spark, sf, "avg"), NARROW, FOLD_SPEC, T, rejects=rejects)
    return spark.read.parquet(rejects).select("tick", "i", "j", q6("f").alias("f_e6"))


@register(
    "step_scaled",
    f"{FOLD_BASE}, scaled AS (SELECT tick, i, j, f * {D(SOURCE_SCALE)} AS f FROM avg_rows){fold_sql('zero', 'scaled')}\nSELECT tick, i, j, {Q('u')} AS u_e6 FROM hist",
)
def q_step_scaled(spark, sf):
    spec = FOLD_SPEC.with_(source_scale=SOURCE_SCALE)
    return _hist_q(tick_fold(spark, _aligned(spark, sf, "avg"), GRID, spec, T, method="step").history(spark))


SNAP_TICK_SQL = f"(SELECT min(tick) FROM avg_rows) + {SNAPSHOT_OFFSET_TICKS * T}"


@register(
    "snapshot_at_tick",
    f"""{FOLD_BASE}{fold_sql('zero')}
    SELECT tick, {Q(X('i'))} AS x_e6, {Q(Y('j'))} AS y_e6, {Q('u')} AS temp_e6, {RED('u')} AS colour,
           {BUCKET('u')} AS bucket, {Q('u')} AS radius_e6
    FROM hist WHERE tick = {SNAP_TICK_SQL}""",
)
def q_snapshot(spark, sf):
    res = _fold(spark, sf, "auto")
    s = snapshot_table(spark, res.path, res.first_tick + SNAPSHOT_OFFSET_TICKS * T, GRID)
    return s.select(
        "tick",
        q6("x").alias("x_e6"),
        q6("y").alias("y_e6"),
        q6("temp").alias("temp_e6"),
        "colour",
        "bucket",
        q6("radius").alias("radius_e6"),
    )


@register(
    "replay_range",
    f"""{FOLD_BASE}{fold_sql('zero')}
    SELECT tick, i, j, {Q('u')} AS temp_e6, CAST((tick - (SELECT min(tick) FROM hist)) // {T} AS BIGINT) AS position
    FROM hist WHERE tick BETWEEN {SNAP_TICK_SQL} AND {SNAP_TICK_SQL} + {(REPLAY_TICKS - 1) * T}""",
)
def q_replay(spark, sf):
    res = _fold(spark, sf, "auto")
    a = res.first_tick + SNAPSHOT_OFFSET_TICKS * T
    r = replay_table(spark, res.path, a, a + (REPLAY_TICKS - 1) * T, GRID)
    first_stored = res.first_tick - T
    return r.select(
        "tick",
        "i",
        "j",
        q6("temp").alias("temp_e6"),
        F.call_function("div", F.col("tick") - F.lit(first_stored), F.lit(T)).cast("long").alias("position"),
    )


LOOP_FRAMES, LOOP_START = 5, -2


@register(
    "replay_loop",
    f"""{FOLD_BASE}{fold_sql('zero')},
    n AS (SELECT count(DISTINCT tick) AS n, min(tick) AS t FROM hist),
    fr AS (SELECT CAST(f AS BIGINT) AS frame,
                  n.t + ((((f + ({LOOP_START})) % n.n) + n.n) % n.n) * {T} AS tick FROM range({LOOP_FRAMES}) r(f), n)
    SELECT fr.frame, h.tick, h.i, h.j, {Q('h.u')} AS temp_e6 FROM hist h JOIN fr ON h.tick = fr.tick""",
)
def q_replay_loop(spark, sf):
    """A player that starts two ticks before the end and wraps to the start."""
    res = _fold(spark, sf, "auto")
    n_stored = (res.last_tick - res.first_tick) // T + 2  # with the initial state
    r = replay_loop(spark, res.path, res.first_tick - T, n_stored, T, LOOP_START, LOOP_FRAMES, GRID)
    return r.select("frame", "tick", "i", "j", q6("temp").alias("temp_e6"))


KEY_EVERY = 4


@register(
    "replay_changes",
    f"""{FOLD_BASE}{fold_sql('zero')}
    SELECT tick, i, j, {Q('u')} AS temp_e6
    FROM hist WHERE tick BETWEEN {SNAP_TICK_SQL} AND {SNAP_TICK_SQL} + {(REPLAY_TICKS - 1) * T}""",
)
def q_replay_changes(spark, sf):
    """The replay from a table of keyframes and changes."""
    res = _fold(spark, sf, "auto")
    path, origin = scratch_path(spark, "changes"), res.first_tick - T
    write_changes(res.history(spark), path, T, KEY_EVERY, origin)
    a = res.first_tick + SNAPSHOT_OFFSET_TICKS * T
    r = replay_changes(spark, path, a, min(a + (REPLAY_TICKS - 1) * T, res.last_tick), GRID, T, KEY_EVERY, origin)
    return r.select("tick", "i", "j", q6("temp").alias("temp_e6"))


RECTANGLE = ((3, 8), (2, 5))


@register(
    "history_of_rectangle",
    f"""{FOLD_BASE}{fold_sql('zero')}
    SELECT tick, i, j, {Q('u')} AS u_e6 FROM hist
    WHERE i BETWEEN {RECTANGLE[0][0]} AND {RECTANGLE[0][1]} AND j BETWEEN {RECTANGLE[1][0]} AND {RECTANGLE[1][1]}""",
)
def q_history_of_rectangle(spark, sf):
    """All ticks of a rectangle of cells from the copy laid out by cells."""
    path = scratch_path(spark, "cells")
    write_cells(_fold(spark, sf, "auto").history(spark), path, T, side=4, span_ticks=16)
    return _hist_q(history_of_rectangle(spark, path, *RECTANGLE, T, side=4, span_ticks=16))


# ------------------------------------------------------------- halo, merge


def _halo_sql_rows(src: str = "last_rows") -> str:
    return f"""
    SELECT CAST(tick + {T} AS BIGINT) AS tick, CAST(i - 1 AS INTEGER) AS i, j, f AS val FROM {src}
      WHERE i > 0 AND {STRIPE('i')} <> {STRIPE('i - 1')}
    UNION ALL
    SELECT CAST(tick + {T} AS BIGINT) AS tick, CAST(i + 1 AS INTEGER) AS i, j, f AS val FROM {src}
      WHERE i < {NX - 1} AND {STRIPE('i')} <> {STRIPE('i + 1')}"""


@register(
    "halo_branch",
    f"""{BASE} SELECT tick, i, j, f, CASE WHEN i > 0 AND {STRIPE('i')} <> {STRIPE('i - 1')} THEN 0
      WHEN i < {NX - 1} AND {STRIPE('i')} <> {STRIPE('i + 1')} THEN 1 END AS branch
    FROM last_rows WHERE (i > 0 AND {STRIPE('i')} <> {STRIPE('i - 1')})
       OR (i < {NX - 1} AND {STRIPE('i')} <> {STRIPE('i + 1')})""",
)
def q_halo_branch(spark, sf):
    return halo_branch(_aligned(spark, sf, "last"), NX, N_STRIPES).select("tick", "i", "j", "f", "branch")


@register("halo_rows", f"{BASE} {_halo_sql_rows()}")
def q_halo_rows(spark, sf):
    return halo_rows(_aligned(spark, sf, "last"), NX, N_STRIPES, T)


HALO_MERGE_SQL = f"""{BASE}, h0 AS ({_halo_sql_rows()}),
    h AS (SELECT tick, i, j, sum(val) AS val FROM h0 GROUP BY tick, i, j)
    SELECT coalesce(l.tick, h.tick) AS tick, coalesce(l.i, h.i) AS i, coalesce(l.j, h.j) AS j,
           {Q(f'coalesce(l.f, {D(0.0)}) + {D(C)} * coalesce(h.val, {D(0.0)})')} AS f_e6
    FROM last_rows l FULL OUTER JOIN h ON l.tick = h.tick AND l.i = h.i AND l.j = h.j"""


@register("halo_merge", HALO_MERGE_SQL)
def q_halo_merge(spark, sf):
    a = _aligned(spark, sf, "last")
    m = merge_halo(a, halo_rows(a, NX, N_STRIPES, T), C)
    return m.select("tick", "i", "j", q6("f").alias("f_e6"))


@register(
    "halo_of_state",
    f"""{FOLD_BASE}{fold_sql('zero')}
    SELECT tick, i, j, {Q('val')} AS val_e6 FROM ({_halo_sql_rows('(SELECT tick, i, j, u AS f FROM hist)')})""",
)
def q_halo_of_state(spark, sf):
    """Halo rows of the folded states: what a stripe sends its neighbour."""
    h = _fold(spark, sf, "step").history(spark)
    return halo_rows(h, NX, N_STRIPES, T, "u").select("tick", "i", "j", q6("val").alias("val_e6"))


@register("range_partitioned", f"{BASE} SELECT tick, i, j, f FROM last_rows")
def q_range_partitioned(spark, sf):
    return range_partition(_aligned(spark, sf, "last"), int(spark.conf.get("spark.sql.shuffle.partitions")))


# --------------------------------------- range joins, panes, co-partitioning


def _range_sql(closed: bool) -> str:
    """Readings and halo rows within the time range; ``closed`` keeps only
    the unmatched rows that the watermark has passed."""
    before, after = sq.RANGE_BEFORE, sq.RANGE_AFTER
    inside = f"l.i = h.i AND l.j = h.j AND h.h_time BETWEEN l.time - {before} AND l.time + {after}"
    mark = f"(SELECT least((SELECT max(time) FROM l), (SELECT max(h_time) FROM h)) - {sq.DELAY})"
    old_l = f" AND l.time + {after} <= {mark}" if closed else ""
    old_h = f" AND h.h_time + {before} <= {mark}" if closed else ""
    return f"""{RBASE}, l AS (SELECT i, j, time, gen FROM readings),
    h AS (SELECT tick AS h_time, i, j, val FROM ({_halo_sql_rows('(SELECT time AS tick, i, j, gen AS f FROM readings)')}))
    SELECT l.i, l.j, l.time, l.gen, h.h_time, h.val FROM l JOIN h ON {inside}
    UNION ALL
    SELECT l.i, l.j, l.time, l.gen, NULL, NULL FROM l WHERE NOT EXISTS (SELECT 1 FROM h WHERE {inside}){old_l}
    UNION ALL
    SELECT h.i, h.j, NULL, NULL, h.h_time, h.val FROM h WHERE NOT EXISTS (SELECT 1 FROM l WHERE {inside}){old_h}"""


@register("range_join", _range_sql(False))
def q_range_join(spark, sf):
    """Readings with the halo rows of their cell from three hours before to
    one hour after them, unmatched rows of both sides included."""
    left, right = sq.range_sides(_r(spark, sf))
    j = range_join(left, right, ("i", "j"), "time", "h_time", sq.RANGE_BEFORE, sq.RANGE_AFTER, "full")
    return j.select("i", "j", "time", "gen", "h_time", "val")


HOUR = 3_600_000


def _panes_sql(size: int, slide: int) -> str:
    return f"""{RBASE}, ws AS (
      SELECT (time // {slide}) * {slide} - unnest(range({size // slide})) * {slide} AS ws, i, j, gen FROM readings)
    SELECT CAST(ws + {size} AS BIGINT) AS time, i, j, {Q(f'{D(C)} * sum(gen) / count(*)')} AS f_e6, count(*) AS n_readings
    FROM ws GROUP BY ws, i, j"""


def _panes_query(size: int, slide: int):
    def fn(spark, sf):
        return hopping_mean(_r(spark, sf), size, slide, C).select("time", "i", "j", q6("f").alias("f_e6"), "n_readings")

    return fn


# 30-day windows each hour, and the windows of avg_hopping
register("avg_panes_monthly", _panes_sql(30 * DAY, HOUR))(_panes_query(30 * DAY, HOUR))
register("avg_panes", _window_sql(2 * DAY, DAY))(_panes_query(2 * DAY, DAY))


@register("halo_merge_bucketed", HALO_MERGE_SQL)
def q_halo_merge_bucketed(spark, sf):
    """Sources and halo rows as co-partitioned tables, joined without a shuffle."""
    a = _aligned(spark, sf, "last")
    sent = halo_rows(a, NX, N_STRIPES, T).groupBy("tick", "i", "j").agg(F.sum("val").alias("val"))
    key = ("tick", "i", "j")
    return merge_halo_bucketed(bucketed(a, key), bucketed(sent, key), C).select("tick", "i", "j", q6("f").alias("f_e6"))


@register("readings_with_state_bucketed", WITH_STATE_SQL)
def q_with_state_bucketed(spark, sf):
    """Readings and the states before them as co-partitioned tables."""
    h = _fold(spark, sf, "step").history(spark)
    prev = h.select((F.col("tick") + F.lit(T)).alias("tick"), "i", "j", F.col("u").alias("u_prev"))
    key = ("tick", "i", "j")
    j = with_state(bucketed(_aligned(spark, sf, "last"), key), bucketed(prev, key))
    return j.select("tick", "i", "j", "f", q6("u_prev").alias("u_prev_e6"))


# ---------------------------------------------------------------- streaming

for _name, (_fn, _sql) in sq.stream_queries(
    base=BASE,
    fold_base=FOLD_BASE,
    fold_sql=fold_sql,
    window_sql=_window_sql,
    halo_sql=_halo_sql_rows,
    q=Q,
    x=X,
    stripe=STRIPE,
    y=Y,
    window_rows_sql=window_rows_sql,
    range_sql=_range_sql,
    merge_sql=HALO_MERGE_SQL,
).items():
    register(_name, _sql)(_fn)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: fn for k, (fn, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql is not None}
