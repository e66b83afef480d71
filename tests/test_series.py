"""Series that grow batch by batch have the kinematics of the whole series."""

import random

import pytest

from tagwright.operators.trajectory import kinematics
from tagwright.streaming import series as se

STEPS = "key string, step long, x double, y double"


def rounded(df):
    columns = sorted(df.columns)
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_batches_equal_the_whole(spark, tmp_path, hot_rows):
    rng = random.Random(2)
    rows = [(k, i, rng.random(), rng.random()) for k, n in (("a", 60), ("b", 9), ("c", 1), ("d", 2), (None, 5)) for i in range(n)]
    whole = spark.createDataFrame(rows, STEPS)
    cuts = {"a": (1, 3, 40), "b": (0, 5, 5), "c": (0, 0, 0), "d": (1, 1, 2), None: (2, 3, 4)}
    for batch in range(4):
        some = [r for r in rows if sum(r[1] >= c for c in cuts[r[0]]) == batch]
        new = spark.createDataFrame(some, STEPS).repartition(3)
        for _ in range(2 if batch == 2 else 1):  # a batch that runs again replaces itself
            se.add_batch(new, batch, str(tmp_path), ["key"], ["step"], ["x", "y"], hot_rows=hot_rows)
    known = [r for r in rows if r[0] is not None]
    expected = kinematics(spark.createDataFrame(known, STEPS), ["key"], "step", ["x", "y"])
    assert rounded(se.series(spark, str(tmp_path)).filter("key IS NOT NULL")) == rounded(expected)
    assert spark.read.parquet(f"{tmp_path}/late").count() == 0
    assert spark.read.parquet(f"{tmp_path}/state/__batch=3").filter("key IS NOT NULL").count() <= 8


def test_late_steps_are_kept_aside(spark, tmp_path):
    first = spark.createDataFrame([("a", i, float(i), 0.0) for i in (1, 2, 5)], STEPS)
    second = spark.createDataFrame([("a", 3, 9.0, 9.0), ("a", 5, 5.0, 0.0), ("a", 6, 7.0, 0.0), ("b", 1, 0.0, 0.0)], STEPS)
    for batch, df in enumerate((first, second)):
        se.add_batch(df, batch, str(tmp_path), ["key"], ["step"], ["x", "y"])
    late = spark.read.parquet(f"{tmp_path}/late").select("step").collect()
    assert sorted(r.step for r in late) == [3, 5]
    got = se.series(spark, str(tmp_path)).filter("key = 'a'").orderBy("step").collect()
    assert [(r.step, r.position, r.distance) for r in got] == [(2, 1, 1.0), (5, 2, 3.0), (6, 3, 2.0)]
