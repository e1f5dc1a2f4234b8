"""One neighbour-weighted step of the per-cell state.

New value of a cell = (1 - 4C) * own + C * (sum of the four neighbours)
+ source.  Expressed the Spark way: every cell emits weighted
contributions keyed by the *target* cell (``explode``), the source rows
are unioned in, and one grouped sum produces the next state.  Partial
aggregation runs before the single shuffle of the step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.config import FoldSpec, GridSpec
from gridcast.functions.grid import is_interior, missing_as_zero

# (di, dj) offsets of the four neighbours, self excluded.
NEIGHBOURS = ((-1, 0), (1, 0), (0, -1), (0, 1))


def _sql_interior(i: str, j: str, grid: GridSpec) -> str:
    return f"({i} > 0 AND {i} < {grid.nx - 1} AND {j} > 0 AND {j} < {grid.ny - 1})"


def _sql_in_domain(i: str, j: str, grid: GridSpec) -> str:
    return f"({i} >= 0 AND {i} < {grid.nx} AND {j} >= 0 AND {j} < {grid.ny})"


def _d(v: float) -> str:
    return f"{float(v)!r}D"


def contributions(state: DataFrame, grid: GridSpec, spec: FoldSpec, keys: tuple[str, ...] = (), n_stripes: int = 1) -> DataFrame:
    """Weighted rows ``(keys.., i, j, v)`` that each cell sends to itself and
    its neighbours, edge-filtered by the rule of ``spec``.  Extra ``keys``
    (e.g. ``tick``) are carried through, so many grids step at once.

    * ``zero``: self keeps ``1-4C``; neighbours outside the grid are dropped.
    * ``fixed``: a border cell keeps all of its value; neighbour rows only go
      to interior targets.

    With ``n_stripes`` over 1 no row crosses the edge of a stripe of columns.

    The five rows come from one ``inline`` of computed structs and one
    filter; the expression is written as SQL text so that building a step
    costs one parse instead of dozens of driver round trips.
    """
    c = float(spec.coeff)
    self_w = _d(1.0 - 4.0 * c)
    if spec.edge == "fixed":
        self_w = f"CASE WHEN {_sql_interior('i', 'j', grid)} THEN {self_w} ELSE 1.0D END"
    parts = [f"named_struct('i', i, 'j', j, 'v', u * {self_w}, 'ok', true)"]
    for di, dj in NEIGHBOURS:
        ti, tj = f"(i + ({di}))", f"(j + ({dj}))"
        ok = _sql_interior(ti, tj, grid) if spec.edge == "fixed" else _sql_in_domain(ti, tj, grid)
        if n_stripes > 1 and di:
            ok += f" AND i * {n_stripes} div {grid.nx} = {ti} * {n_stripes} div {grid.nx}"
        parts.append(f"named_struct('i', {ti}, 'j', {tj}, 'v', u * {_d(c)}, 'ok', {ok})")
    ex = state.select(*keys, F.expr(f"inline(array({', '.join(parts)}))"))
    return ex.where(F.col("ok")).select(*keys, F.col("i").cast("int"), F.col("j").cast("int"), "v")


def source_terms(source: DataFrame, grid: GridSpec, spec: FoldSpec, keys: tuple[str, ...] = ()) -> DataFrame:
    """Scaled source rows ``(keys.., i, j, v)``; under ``fixed`` only interior cells."""
    ok = _sql_interior("i", "j", grid) if spec.edge == "fixed" else _sql_in_domain("i", "j", grid)
    return source.where(F.expr(ok)).select(
        *keys, "i", "j", F.expr(f"f * {_d(spec.source_scale)}").alias("v")
    )


def neighbour_step(
    state: DataFrame,
    source: DataFrame | None,
    grid: GridSpec,
    spec: FoldSpec,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Dense state ``(keys.., i, j, u)`` + sparse source ``(keys.., i, j, f)``
    -> next ``(keys.., i, j, u)``.

    One exchange (hash on ``keys, i, j``) after partial aggregation.
    """
    parts = contributions(state, grid, spec, keys)
    if source is not None:
        parts = parts.unionByName(source_terms(source, grid, spec, keys))
    return parts.groupBy(*keys, "i", "j").agg(F.sum("v").alias("u"))


def chained_steps(state: DataFrame, sources: DataFrame, first: int, k: int, tick_ms: int, grid: GridSpec, spec: FoldSpec) -> DataFrame:
    """``k`` steps in one plan: the states ``(tick, i, j, u)`` of ticks
    ``first .. first + (k - 1) * tick_ms`` from a dense ``(i, j, u)`` state
    before them and the aligned rows of those ticks.

    A cell's row carries its sources ``f0..`` of the steps to come and its
    values ``h0..`` of the steps done, so that a step is one aggregate (one
    exchange) and the chain is written in one job.
    """
    step = F.call_function("div", F.col("tick") - F.lit(first), F.lit(tick_ms))
    source = source_terms(sources, grid, spec, ("tick",)).groupBy("i", "j").agg(
        *[F.sum(F.when(step == m, F.col("v"))).alias(f"f{m}") for m in range(k)]
    )
    cur = state.select("i", "j", "u").join(source, ["i", "j"], "left")
    c, own = float(spec.coeff), _d(1.0 - 4.0 * float(spec.coeff))
    if spec.edge == "fixed":
        own = f"CASE WHEN {_sql_interior('i', 'j', grid)} THEN {own} ELSE 1.0D END"
    for m in range(k):
        carry = [f"f{n}" for n in range(m + 1, k)] + [f"h{n}" for n in range(m)]
        kept = "".join(f", '{x}', {x}" for x in carry)
        none = "".join(f", '{x}', CAST(NULL AS DOUBLE)" for x in carry)
        parts = [f"named_struct('i', i, 'j', j, 'v', u * {own} + coalesce(f{m}, 0.0D), 'ok', true{kept})"]
        for di, dj in NEIGHBOURS:
            ti, tj = f"(i + ({di}))", f"(j + ({dj}))"
            ok = _sql_interior(ti, tj, grid) if spec.edge == "fixed" else _sql_in_domain(ti, tj, grid)
            parts.append(f"named_struct('i', {ti}, 'j', {tj}, 'v', u * {_d(c)}, 'ok', {ok}{none})")
        rows = cur.select(F.expr(f"inline(array({', '.join(parts)}))")).where("ok")
        rows = rows.groupBy("i", "j").agg(F.sum("v").alias("u"), *[F.max(x).alias(x) for x in carry])
        cur = rows.withColumn(f"h{m}", F.col("u"))
    done = ", ".join(f"{first + m * tick_ms}L, h{m}" for m in range(k))
    return cur.select("i", "j", F.expr(f"stack({k}, {done}) AS (tick, u)")).select("tick", F.col("i").cast("int"), F.col("j").cast("int"), "u")


def striped_step(
    state: DataFrame,
    source: DataFrame,
    grid: GridSpec,
    spec: FoldSpec,
    n_stripes: int,
    tick_ms: int,
) -> DataFrame:
    """The step as stripes of columns make it: ``state`` ``(tick, i, j, u)``
    of one tick each, ``source`` ``(tick, i, j, f)`` of the next ones.

    A cell sends nothing across a stripe edge; the edge columns' states
    travel as halo rows, are merged into the next tick's source and supply
    the missing terms.  Equal to :func:`neighbour_step` for any stripes.
    """
    from gridcast.operators.halo import halo_rows, merge_halo

    moved = state.select((F.col("tick") + F.lit(tick_ms)).alias("tick"), "i", "j", "u")
    near = contributions(moved, grid, spec, ("tick",), n_stripes)
    scaled = source.select("tick", "i", "j", (F.col("f") * F.lit(float(spec.source_scale))).alias("f"))
    fed = merge_halo(scaled, halo_rows(state, grid.nx, n_stripes, tick_ms, "u"), spec.coeff)
    terms = source_terms(fed, grid, spec.with_(source_scale=1.0), ("tick",))
    return near.unionByName(terms).groupBy("tick", "i", "j").agg(F.sum("v").alias("u"))


def step_by_lookup(
    state: DataFrame,
    source: DataFrame | None,
    grid: GridSpec,
    spec: FoldSpec,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """The same step as four left self-joins on shifted keys (cross-check form).

    Slower (four exchanges) but independent of :func:`neighbour_step`; the
    tests and the SQL oracle compare the two.
    """
    c = float(spec.coeff)
    on = [*keys, "i", "j"]
    out = state.select(*keys, "i", "j", "u")
    for k, (di, dj) in enumerate(NEIGHBOURS):
        nb = state.select(
            *keys,
            (F.col("i") - F.lit(di)).cast("int").alias("i"),
            (F.col("j") - F.lit(dj)).cast("int").alias("j"),
            F.col("u").alias(f"n{k}"),
        )
        out = out.join(nb, on, "left")
    nsum = sum((missing_as_zero(f"n{k}") for k in range(4)), F.lit(0.0))
    if source is not None:
        out = out.join(source.select(*keys, "i", "j", "f"), on, "left")
        f = missing_as_zero("f") * F.lit(float(spec.source_scale))
    else:
        f = F.lit(0.0)
    updated = (F.lit(1.0 - 4.0 * c) * F.col("u")) + F.lit(c) * nsum + f
    if spec.edge == "fixed":
        updated = F.when(is_interior("i", "j", grid), updated).otherwise(F.col("u"))
    return out.select(*keys, "i", "j", updated.alias("u"))
