"""Displacement errors, speed, acceleration and control series of trajectories.

Two layouts: long, one row per step, for trajectories of any length; and one
array of points per row, for short ones, where every operator is a projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import named
from tagwright.operators.skew import _SLICE, HOT_ROWS, Ordered, bounded_lists, spread_join

# Seconds per step, and the accelerations that mean full throttle and full brake.
STEP_SECONDS = 0.1
FULL_THROTTLE = 3.0
FULL_BRAKE = 5.0

NAN = float("nan")
LIST_ROWS = 100_000


def _length(parts: Sequence[str]) -> str:
    return f"sqrt({' + '.join(f'({p}) * ({p})' for p in parts)})"


def throttle(a: str) -> str:
    """Share of full throttle, 0 unless accelerating. Spark orders NaN above 0, so it is kept out."""
    return (
        f"CASE WHEN {a} > 0 AND NOT isnan({a}) THEN least({a} / {FULL_THROTTLE}D, 1D) "
        f"WHEN {a} IS NOT NULL THEN 0D END"
    )


def brake(a: str) -> str:
    """Share of full brake: 0 while accelerating, NaN for NaN."""
    return (
        f"CASE WHEN isnan({a}) THEN {a} WHEN {a} > 0 THEN 0D "
        f"WHEN {a} IS NOT NULL THEN least(abs({a}) / {FULL_BRAKE}D, 1D) END"
    )


def rotated(x: Column, y: Column) -> tuple[Column, Column]:
    """A quarter turn counter-clockwise: (x, y) → (-y, x)."""
    return -y, x


def rotate(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    new_x, new_y = rotated(F.col(x), F.col(y))
    return df.select(*[{x: new_x.alias(x), y: new_y.alias(y)}.get(c, F.col(c)) for c in df.columns])


# ---- long layout ------------------------------------------------------------


def ade(
    pred: DataFrame, truth: DataFrame, keys: Sequence[str], sample: str, step: str = "step"
) -> DataFrame:
    """Mean distance in the XY plane per (key, sample); NULL unless its steps are those of the truth.

    The join key contains the step, so one key with many samples is spread over
    as many tasks as it has steps, and hot ones can be split; the mean is pre-aggregated before its shuffle. Both
    sides have each step once.
    """
    true_points = truth.selectExpr(*map(named, [*keys, step]), "x AS __tx", "y AS __ty")
    steps = truth.groupBy(*keys).agg(F.count(F.lit(1)).alias("__steps"))
    mean = f"avg({_length(['x - __tx', 'y - __ty'])})"
    means = (
        spread_join(pred, true_points, [*keys, step], "left")
        .groupBy(*keys, sample)
        .agg(F.expr("count(__tx) AS __met"), F.expr("count(*) AS __all"), F.expr(f"{mean} AS __mean"))
    )
    return spread_join(means, steps, keys, "left").selectExpr(
        *map(named, [*keys, sample]), "CASE WHEN __met = __all AND __all = __steps THEN __mean END AS ade"
    )


def min_ade(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Smallest ``ade`` per key; one NaN makes the result NaN."""
    return errors.groupBy(*keys).agg(
        F.expr("CASE WHEN bool_or(isnan(ade)) THEN double('NaN') ELSE min(ade) END AS min_ade")
    )


def _kinematics(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    axes: Sequence[str],
    dt: float,
    hot_rows: int | None,
) -> tuple[DataFrame, Ordered]:
    order = [order] if isinstance(order, str) else list(order)
    steps = Ordered(
        df.select(*dict.fromkeys([*keys, *order, *axes])), keys, order, context=2, hot_rows=hot_rows
    )
    lags = [
        f"lag({named(a)}, {i}) {steps.over} AS {named(f'__{a}_{i}')}" for a in axes for i in (1, 2)
    ]
    lagged = steps.rows.selectExpr("*", f"{steps.position} AS position", *lags)
    now = [f"{named(a)} - {named(f'__{a}_1')}" for a in axes]
    before = [f"{named(f'__{a}_1')} - {named(f'__{a}_2')}" for a in axes]
    kept = [named(c) for c in dict.fromkeys([*steps.group, *order])]
    series = (
        steps.own_rows(lagged)
        .filter("position > 0")
        .selectExpr(
            *kept,
            "position",
            *[f"{step} AS {named('d' + a)}" for a, step in zip(axes, now)],
            f"{_length(now[:2])} AS distance",
            f"{_length(before[:2])} / {dt}D AS __earlier",
        )
        .selectExpr("*", f"distance / {dt}D AS speed")
        .selectExpr("*", f"(speed - __earlier) / {dt}D AS acceleration")
        .drop("__earlier")
    )
    return (
        series.selectExpr(
            "*", f"{throttle('acceleration')} AS throttle", f"{brake('acceleration')} AS brake"
        ),
        steps,
    )


def kinematics(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str] = "step",
    axes: Sequence[str] = ("x", "y", "z"),
    dt: float = STEP_SECONDS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Step, distance, speed, acceleration, throttle and brake per step after the first.

    Distance uses the first two axes. Acceleration, throttle and brake are NULL
    on the second step of a trajectory, which has no earlier speed. One shuffle
    and one sort of the steps; trajectories over ``hot_rows`` steps are cut.
    """
    return _kinematics(df, keys, order, axes, dt, hot_rows)[0].drop(_SLICE)


def control_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str] = "step",
    axes: Sequence[str] = ("x", "y", "z"),
    dt: float = STEP_SECONDS,
    hot_rows: int | None = HOT_ROWS,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """``(keys, start, speed_control, brake_control)``, rounded to two decimals.

    Each row has ``list_rows`` values, the last of a trajectory up to that many; ``start`` is the
    0-based index of its first value, 0, ``list_rows``, and so on.
    """
    series, steps = _kinematics(df, keys, order, axes, dt, hot_rows)
    controls = series.filter("position > 1").selectExpr(
        *map(named, steps.group), "position - 2 AS at", "throttle", "brake"
    )
    lists = {"speed_control": "bround(throttle, 2)", "brake_control": "bround(brake, 2)"}
    return bounded_lists(controls, steps.list_group, "at", list_rows, lists)


# ---- array layout -----------------------------------------------------------


def _pairs(values: str, result: str) -> str:
    """``result`` of each ``later`` and ``earlier`` neighbour: n values give n - 1."""
    n = f"greatest(size({values}) - 1, 0)"
    return f"zip_with(slice({values}, 2, {n}), slice({values}, 1, {n}), (later, earlier) -> {result})"


def add_series(df: DataFrame, points: str = "points", dt: float = STEP_SECONDS) -> DataFrame:
    """Add ``speeds``, ``accelerations``, ``speed_control`` and ``brake_control`` arrays.

    ``points`` is ``ARRAY<STRUCT<x, y, ...>>`` in step order. No shuffle.
    """
    moved = _length(["later.x - earlier.x", "later.y - earlier.y"])
    return (
        df.selectExpr("*", f"{_pairs(named(points), f'{moved} / {dt}D')} AS speeds")
        .selectExpr("*", f"{_pairs('speeds', f'(later - earlier) / {dt}D')} AS accelerations")
        .selectExpr(
            "*",
            f"transform(accelerations, a -> bround({throttle('a')}, 2)) AS speed_control",
            f"transform(accelerations, a -> bround({brake('a')}, 2)) AS brake_control",
        )
    )


def points_ade(pred: str, truth: str) -> str:
    """Mean XY distance of two point arrays; NULL if their lengths differ."""
    off = f"zip_with({pred}, {truth}, (p, t) -> {_length(['p.x - t.x', 'p.y - t.y'])})"
    return f"try_divide(aggregate({off}, 0D, (total, d) -> total + d), size({pred}))"


def ade_arrays(
    pred: DataFrame, truth: DataFrame, keys: Sequence[str], points: str = "points"
) -> DataFrame:
    """Add ``ade`` to each predicted trajectory. ``truth`` has one row per key.

    Scoring is a projection of the joined rows, so a key with very many samples
    is scored by many tasks.
    """
    target = truth.select(*keys, F.col(points).alias("__truth"))
    joined = spread_join(pred, target, keys, "left")
    return joined.selectExpr("*", f"{points_ade(named(points), '__truth')} AS ade").drop("__truth")


def to_steps(df: DataFrame, points: str = "points", step: str = "step") -> DataFrame:
    """Array layout → long layout; ``step`` counts from 0."""
    rest = [c for c in df.columns if c != points]
    exploded = df.select(*rest, F.posexplode(points).alias(step, "__point"))
    return exploded.select(*rest, step, "__point.*")
