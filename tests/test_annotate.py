import itertools
import json
import os
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from tagwright.operators import annotate as an
from tagwright.vocabulary import FAILED, VOCABULARY

VOCAB = {"a": ["x", "none"]}


def test_retries_pause_after_errors_but_not_after_the_last_or_after_empty_answers():
    pauses = []

    def calls(*results):
        left = list(results)

        def call():
            result = left.pop(0)
            if isinstance(result, Exception):
                raise result
            return result

        return call

    boom = ValueError("boom")
    assert an.with_retries(calls(boom, boom, [1]), 3, pauses.append) == ([1], 3, None)
    assert pauses == [2, 4]
    pauses.clear()
    assert an.with_retries(calls(boom, boom, boom), 3, pauses.append) == ([], 3, "boom")
    assert pauses == [2, 4]
    pauses.clear()
    assert an.with_retries(calls([], [], [2]), 3, pauses.append) == ([2], 3, None)
    assert an.with_retries(calls([], [], []), 3, pauses.append) == ([], 3, "no rows")
    assert an.with_retries(calls([3]), 3, pauses.append) == ([3], 1, None)
    assert pauses == []


def test_answers_are_checked_like_failed_calls():
    assert an.answered_rows('{"rows": [{"a": "x"}]}', VOCAB) == [{"a": "x"}]
    assert an.answered_rows({"rows": None}, VOCAB) == []
    assert an.answered_rows({"rows": [{"a": None}, {}]}, VOCAB) == [{"a": None}, {}]
    twice = '{"rows": [{"a": "x", "a": "x"}]}'
    for bad in ('{"rows": [', "[1]", '{"rows": "abc"}', '{"rows": [1]}', '{"rows": [null]}', '{"rows": [{"a": 1}]}', twice):
        with pytest.raises(Exception):
            an.answered_rows(bad, VOCAB)


@pytest.mark.parametrize("partitions", [None, 3])
def test_annotate(spark, partitions):
    def answer(row):
        if row["id"] is None:
            return {"rows": [{"a": "null key"}]}
        if row["id"] == 2:
            raise ConnectionError("down")
        if row["id"] == 3:
            return {"rows": []}
        rows = [{"a": row["text"], "confidence": "high", "confidence_notes": ""}, {"confidence": 0.5}]
        return json.dumps({"rows": rows[: row["id"]]}) if row["id"] == 1 else {"rows": rows}

    df = spark.createDataFrame(
        [(1, "é"), (2, "b"), (3, "c"), (4, None), (None, "d")], "id bigint, text string"
    )
    out = an.annotate(df, ["id"], answer, VOCAB, 2, partitions, sleep=lambda s: None)
    got = {}
    for r in out.collect():
        got.setdefault(r.id, []).append(r)
    assert out.columns == ["id", "a", "confidence", "confidence_notes", "attempts", "status", "error"]
    assert [tuple(r) for r in got[1]] == [(1, "é", "high", "", 1, "ok", None)]
    for key, error in (2, "down"), (3, "no rows"):
        note = "Failed after 2 attempts"
        assert [tuple(r) for r in got[key]] == [(key, FAILED, "low", note, 2, "failed", error)]
    assert [(r.a, r.confidence) for r in got[4]] == [(None, "high"), (None, "0.5")]
    assert got[None][0].a == "null key"


def test_calls_overlap_and_each_task_makes_one_client(spark, tmp_path):
    def client():
        (tmp_path / f"client-{os.urandom(8).hex()}").touch()
        lock, open_calls = threading.Lock(), []

        def answer(row):
            with lock:
                open_calls.append(row["id"])
                now = len(open_calls)
            time.sleep(0.02 * (row["id"] % 3))
            with lock:
                open_calls.remove(row["id"])
            if row["id"] % 10 == 9:
                raise ConnectionError("down")
            return {"rows": [{"a": str(now), "confidence_notes": str(row["id"])}]}

        return answer

    df = spark.range(600).repartition(2)
    ids = [[r.id for r in p] for p in df.rdd.glom().collect()]
    out = an.annotate(df, ["id"], vocab=VOCAB, attempts=1, concurrency=5, client=client, sleep=lambda s: None)
    rows = out.withColumn("task", F.spark_partition_id()).collect()
    for task in range(2):
        assert [r.id for r in rows if r.task == task] == ids[task]
    fine = [r for r in rows if r.status == "ok"]
    assert len(fine) == 540 and all(r.confidence_notes == str(r.id) for r in fine)
    assert 2 <= max(int(r.a) for r in fine) <= 5
    assert len(list(tmp_path.iterdir())) == 2
    with pytest.raises(ValueError, match="either"):
        an.annotate(df, ["id"], vocab=VOCAB)


def test_predict_never_fails_the_batch(spark):
    def predictor(row):
        if row["id"] == 1:
            raise ValueError("bad clip")
        if row["id"] == 2:
            return {"trace": "t", "min_ade": "no number"}
        return {"trace": "t", "min_ade": float("nan") if row["id"] == 3 else 0.5}

    df = spark.range(5).select("id")
    out = {r.id: r for r in an.predict(df, ["id"], predictor, "trace string, min_ade double").collect()}
    assert tuple(out[0]) == (0, "t", 0.5, "Success")
    assert tuple(out[1]) == (1, None, None, "Error: bad clip")
    assert out[2].status.startswith("Error: ") and out[2].trace is None
    assert out[3].min_ade != out[3].min_ade and out[3].status == "Success"


def test_rules(spark):
    df = spark.createDataFrame(
        [
            ("Keep distance to the lead vehicle because it is slowing for the red light.",),
            ("Nudge left over the line to increase clearance from the cyclists.",),
            ("Slow down for the stop sign at night in the rain.",),
            ("Drive on.",),
            (None,),
        ],
        "t string",
    )
    got = an.label_by_rules(df, "t", an.DRIVING_RULES, lower=True).collect()
    assert "lead_obstacle_following" in got[0].maneuver_long
    assert got[0].traffic_light == ["red"]
    assert got[1].maneuver_lat == ["out_of_lane_nudge"]
    assert got[2].maneuver_long == ["stop_for_static_constraints"]
    assert got[2].traffic_control == ["stop_sign"] and got[2].odd_condition == ["rain", "night"]
    for row in got[3:]:
        assert all(row[f] == ["none"] for f in {r[0] for r in an.DRIVING_RULES})
    assert all(value in VOCABULARY[field] for field, _, value, _ in an.DRIVING_RULES)


@pytest.mark.parametrize(
    "text,field,value",
    [
        ("Slow for a lead vehicle", "maneuver_long", "lead_obstacle_following"),
        ("Slow for a red light", "maneuver_long", "stop_for_static_constraints"),
        ("Slow for a pedestrian crossing", "maneuver_long", "yield"),
        ("Slow for a curve", "maneuver_long", "speed_adaptation"),
        ("Slow to create a gap for lane change", "maneuver_long", "gap_searching"),
        ("Nudge within lane", "maneuver_lat", "in_lane_nudge"),
        ("Nudge over the line", "maneuver_lat", "out_of_lane_nudge"),
        ("Change lane to the left", "maneuver_lat", "lane_change_left"),
        ("Change lanes to the right", "maneuver_lat", "lane_change_right"),
        ("Merge onto highway", "maneuver_lat", "merge_split"),
        ("A red light", "traffic_light", "red"),
        ("A green light", "traffic_light", "green"),
        ("A yellow light", "traffic_light", "yellow"),
        ("A stop sign", "traffic_control", "stop_sign"),
        ("A yield sign", "traffic_control", "yield_sign"),
        ("Crosswalk markings", "traffic_control", "pedestrian_crossing"),
        ("Construction warning sign", "traffic_control", "construction_sign"),
        ("Rain", "odd_condition", "rain"),
        ("fog", "odd_condition", "fog"),
        ("At night", "odd_condition", "night"),
        ("Construction zone ahead", "odd_condition", "construction"),
        ("Road curves", "road_geometry", "curve"),
        ("bumps", "road_geometry", "speed_bump"),
        ("hills", "road_geometry", "grade"),
        ("Lane ending", "lane_config", "lane_end"),
        ("the lane merging", "lane_config", "lane_merge"),
        ("lane splitting", "lane_config", "lane_split"),
        ("Need to turn left ahead", "routing_intent", "turn_left"),
        ("Need to turn right ahead", "routing_intent", "turn_right"),
    ],
)
def test_every_stated_phrase_is_labelled(spark, text, field, value):
    row = an.label_by_rules(spark.createDataFrame([(text,)], "t string"), "t", an.DRIVING_RULES, lower=True).collect()[0]
    assert value in row[field]


def test_words_of_rules_never_hide_a_hit():
    """A rule's words are in what its own pattern matches: dropping them changes nothing on the phrases."""
    texts = [" ".join(p).lower() for p in itertools.permutations(["slow for the red traffic light", "nudge over the line", "lane change left"])]
    for _, pattern, _, words in an.DRIVING_RULES:
        for t in texts:
            assert not re.search(pattern, t) or any(w in t for w in words)


def test_values_of_several_patterns_are_not_repeated(spark):
    df = spark.createDataFrame([("ab",)], "t string")
    rules = [("f", "a", "one"), ("f", "b", "one"), ("f", "ab", "two")]
    assert an.label_by_rules(df, "t", rules).collect()[0].f == ["one", "two"]


def test_rules_run_without_python(spark):
    df = spark.createDataFrame([("ab",)], "t string").withColumn("t", F.col("t"))
    plan = an.label_by_rules(df, "t", an.DRIVING_RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
