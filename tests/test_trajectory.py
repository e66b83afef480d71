import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwright.operators import trajectory as tr
from tagwright.operators.skew import Ordered


def controls(acc):
    """Plain statement of the control rule for one acceleration."""
    if acc > 0:
        return min(acc / 3.0, 1.0), 0.0
    return 0.0, min(abs(acc) / 5.0, 1.0)


def make_points(n, seed):
    rng = np.random.default_rng(seed)
    return np.cumsum(rng.normal(0, 0.05, (n, 3)), axis=0)


@pytest.fixture(scope="module")
def clips():
    # Lengths around every edge: none of speed, one speed, one acceleration, long.
    return {f"c{n}": make_points(n, n) for n in (1, 2, 3, 4, 5, 7, 64, 301)}


@pytest.fixture(scope="module")
def steps(spark, clips):
    rows = [
        (clip, step, *map(float, p)) for clip, pts in clips.items() for step, p in enumerate(pts)
    ]
    return spark.createDataFrame(rows, "clip_id string, step int, x double, y double, z double")


@pytest.mark.parametrize("hot_rows", [10**6, 40, 3, 1])
def test_kinematics_equals_numpy_with_and_without_cuts(steps, clips, hot_rows):
    got = {}
    for r in tr.kinematics(steps, ["clip_id"], hot_rows=hot_rows).collect():
        got.setdefault(r.clip_id, {})[r.position] = r
    assert set(got) == {c for c, p in clips.items() if len(p) > 1}
    for clip, rows in got.items():
        d = np.diff(clips[clip], axis=0)
        speed = np.linalg.norm(d[:, :2], axis=1) / 0.1
        acc = np.diff(speed) / 0.1
        assert sorted(rows) == list(range(1, len(d) + 1))
        for i in rows:
            r = rows[i]
            assert r.step == i
            assert [r.dx, r.dy, r.dz] == pytest.approx(d[i - 1])
            assert r.speed == pytest.approx(speed[i - 1])
            if i == 1:
                assert r.acceleration is None and r.throttle is None and r.brake is None
            else:
                assert r.acceleration == pytest.approx(acc[i - 2])
                assert (r.throttle, r.brake) == pytest.approx(controls(acc[i - 2]))


def test_uneven_and_tied_order_values_are_cut_correctly(spark):
    # Slices of very different size, some empty, one of a single row, NULL first.
    at = [None, 0.0, 0.1, 0.2, 50.0, 90.0, 90.0, 90.0, 99.0, 100.0]
    rows = [("k", t, i, float(i * i)) for i, t in enumerate(at)]
    df = spark.createDataFrame(rows, "k string, t double, tie int, x double")
    expect = {i: (i * i - (i - 1) ** 2) / 0.1 for i in range(1, 10)}
    for hot_rows in (100, 4, 2, 1):
        out = tr.kinematics(df, ["k"], ["t", "tie"], axes=["x"], hot_rows=hot_rows).collect()
        assert {r.position: r.speed for r in out} == pytest.approx(expect), hot_rows
        assert all(r.tie == r.position for r in out)


def test_hot_null_key_is_cut_like_any_other(spark):
    df = spark.createDataFrame(
        [(None, i, float(i)) for i in range(20)], "k string, step int, x double"
    )
    out = tr.kinematics(df, ["k"], axes=["x"], hot_rows=3).collect()
    assert sorted(r.position for r in out) == list(range(1, 20))
    assert {round(r.speed, 9) for r in out} == {10.0}


def test_a_hot_key_with_few_order_values_is_cut_evenly(spark):
    # A broken key that collects the steps of many trajectories, and whole copies of rows.
    for row in ("'k' k, id % 4 step, cast(id as double) x", "'k' k, 1 step, 1D x"):
        df = spark.range(0, 4000, 1, 8).selectExpr(*row.split(", "))
        cut = Ordered(df, ["k"], ["step"], context=2, hot_rows=500)
        sizes = [r.n for r in cut.rows.groupBy(*cut.group).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > 4 and max(sizes) < 1500
        lags = [f"lag(x, {i}) {cut.over} AS x{i}" for i in (1, 2)]
        own = cut.own_rows(cut.rows.selectExpr("*", f"{cut.position} AS position", *lags))
        places = own.orderBy("position").collect()
        assert [r.position for r in places] == list(range(4000))
        assert [r.step for r in places] == sorted(r.step for r in places)
        assert sorted(r.x for r in places) == sorted(r.x for r in df.collect())
        for i in (1, 2):
            assert [r[f"x{i}"] for r in places] == [None] * i + [r.x for r in places[:-i]]
        assert tr.kinematics(df, ["k"], axes=["x"], hot_rows=500).count() == 3999


def test_order_by_timestamps_without_zone(spark):
    df = spark.sql(
        "select 'k' k, timestamp_ntz'2024-03-31 00:00:00' + make_dt_interval(0, 0, 10 * id) ts, "
        "cast(id as double) x from range(40)"
    )
    out = tr.kinematics(df, ["k"], "ts", axes=["x"], hot_rows=4).collect()
    assert sorted(r.position for r in out) == list(range(1, 40))
    assert {round(r.speed, 9) for r in out} == {10.0}


@pytest.mark.parametrize("hot_rows,list_rows", [(10**6, 10**6), (30, 50), (10**6, 7), (5, 1)])
def test_control_lists_are_whole(steps, clips, hot_rows, list_rows):
    pieces = {}
    out = tr.control_lists(steps, ["clip_id"], hot_rows=hot_rows, list_rows=list_rows)
    for r in out.orderBy("clip_id", "start").collect():
        assert 0 < len(r.speed_control) == len(r.brake_control) <= list_rows
        speeds, brakes = pieces.setdefault(r.clip_id, ([], []))
        assert r.start == len(speeds)
        speeds += r.speed_control
        brakes += r.brake_control
    assert set(pieces) == {c for c, p in clips.items() if len(p) > 2}
    for clip, (speeds, brakes) in pieces.items():
        d = np.diff(clips[clip], axis=0)
        acc = np.diff(np.linalg.norm(d[:, :2], axis=1) / 0.1) / 0.1
        want = [controls(a) for a in acc]
        assert speeds == pytest.approx([round(float(t), 2) for t, _ in want])
        assert brakes == pytest.approx([round(float(b), 2) for _, b in want])


def test_array_layout_equals_long_layout(spark, steps):
    arrays = steps.groupBy("clip_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("step", "x", "y", "z"))),
            lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z")),
        ).alias("points")
    )
    lists = {r.clip_id: r for r in tr.control_lists(steps, ["clip_id"]).collect()}
    for r in tr.add_series(arrays).collect():
        n = len(r.points)
        assert len(r.speeds) == max(n - 1, 0) and len(r.accelerations) == max(n - 2, 0)
        if n > 2:
            assert r.speed_control == lists[r.clip_id].speed_control
            assert r.brake_control == lists[r.clip_id].brake_control
    back = tr.to_steps(arrays).select(steps.columns)
    assert back.exceptAll(steps).isEmpty() and steps.exceptAll(back).isEmpty()


def test_ade_and_min_ade(spark):
    rng = np.random.default_rng(7)
    truth = {c: rng.normal(size=(16, 2)) for c in "ab"}
    pred = {(c, s): rng.normal(size=(16, 2)) for c in "ab" for s in range(3)}
    schema = "x double, y double"
    t = spark.createDataFrame(
        [(c, i, *map(float, p)) for c, pts in truth.items() for i, p in enumerate(pts)],
        f"clip_id string, step int, {schema}",
    )
    p = spark.createDataFrame(
        [(c, s, i, *map(float, q)) for (c, s), pts in pred.items() for i, q in enumerate(pts)],
        f"clip_id string, sample_id int, step int, {schema}",
    )
    want = {
        (c, s): np.linalg.norm(pts - truth[c], axis=1).mean() for (c, s), pts in pred.items()
    }
    errors = tr.ade(p, t, ["clip_id"], "sample_id")
    assert {(r.clip_id, r.sample_id): r.ade for r in errors.collect()} == pytest.approx(want)
    best = {r.clip_id: r.min_ade for r in tr.min_ade(errors, ["clip_id"]).collect()}
    assert best == pytest.approx({c: min(want[c, s] for s in range(3)) for c in "ab"})

    def packed(df, *keys):
        return df.groupBy(*keys).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("step", "x", "y"))),
                lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")),
            ).alias("points")
        )

    arrays = tr.ade_arrays(packed(p, "clip_id", "sample_id"), packed(t, "clip_id"), ["clip_id"])
    assert {(r.clip_id, r.sample_id): r.ade for r in arrays.collect()} == pytest.approx(want)


def test_missing_true_points_give_no_error_value(spark):
    pred = spark.createDataFrame(
        [("a", 0, 0, 0.0, 0.0), ("a", 0, 1, 1.0, 0.0)],
        "clip_id string, sample_id int, step int, x double, y double",
    )
    truth = pred.filter("step = 0").drop("sample_id")
    assert tr.ade(pred, truth, ["clip_id"], "sample_id").collect()[0].ade is None


@pytest.mark.parametrize("steps,want", [([0], None), ([0, 1], 1.0), ([0, 1, 2], None), ([0, 2], None), ([], None)])
def test_uneven_predictions_have_no_error_value(spark, steps, want):
    schema = "clip_id string, step int, x double, y double"
    truth = spark.createDataFrame([("a", 0, 0.0, 0.0), ("a", 1, 0.0, 0.0)], schema)
    pred = spark.createDataFrame([("a", i, 1.0, 0.0) for i in steps], schema).withColumn("sample_id", F.lit(0))
    assert [r.ade for r in tr.ade(pred, truth, ["clip_id"], "sample_id").collect()] == [want] * bool(steps)


def test_lists_do_not_depend_on_what_counts_as_hot(steps):
    found = [
        sorted(tuple(map(str, r)) for r in tr.control_lists(steps, ["clip_id"], hot_rows=hot, list_rows=7).collect())
        for hot in (None, 10**6, 30, 5)
    ]
    assert all(f == found[0] for f in found)


def test_nan_wins_the_minimum_and_the_controls(spark):
    errors = spark.createDataFrame([("a", 1.0), ("a", tr.NAN), ("b", 2.0)], "k string, ade double")
    best = {r.k: r.min_ade for r in tr.min_ade(errors, ["k"]).collect()}
    assert math.isnan(best["a"]) and best["b"] == 2.0
    acc = spark.createDataFrame([(tr.NAN,), (0.0,), (6.0,), (-50.0,), (None,)], "a double")
    got = acc.selectExpr(f"{tr.throttle('a')} AS t", f"{tr.brake('a')} AS b").collect()
    assert got[0].t == 0.0 and math.isnan(got[0].b)
    assert [(r.t, r.b) for r in got[1:4]] == [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]
    assert got[4].t is None and got[4].b is None


def test_rotation_is_a_quarter_turn_counter_clockwise(spark):
    df = spark.createDataFrame([("a", 3.0, 4.0)], "k string, x double, y double")
    assert tr.rotate(df).collect() == [("a", -4.0, 3.0)]


def test_series_plan_has_one_shuffle_of_the_steps_and_no_python(steps):
    plan = tr.kinematics(steps, ["clip_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
