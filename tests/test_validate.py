import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagwright.functions.text import WHITESPACE
from tagwright.operators import validate as va
from tagwright.vocabulary import FAILED, VOCABULARY, response_fields


def check_cell(field, cell, values):
    """Plain statement of the contract: cleaned text and warnings of one cell."""
    out, warnings = [], []
    for part in (cell or "none").split(","):
        token = part.strip().lower().replace(" ", "_").replace("-", "_")
        if token in values:
            out.append(token)
            continue
        if token == "":
            hit = "none" if "none" in values else values[0]
        else:
            hit = next((v for v in values if token in v or v in token), None)
        out.append(token if hit is None else hit)
        warnings.append(
            f"{field}: '{token}' NOT in vocabulary"
            if hit is None
            else f"{field}: '{token}' → fuzzy matched to '{hit}'"
        )
    return ",".join(out), warnings


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@pytest.mark.parametrize(
    "cell,want",
    [
        ("Truck, bus", "truck,bus"),
        ("police car", "car"),
        ("red,,", "red,none,none"),
        ("pickup", "pickup"),
        ("motor-cycle", "motor_cycle"),
        ("vehicle_bus", "bus"),
        (None, "none"),
        ("", "none"),
        (" \t ", "none"),
        ("　CAR\xa0", "car"),
        ("bus,bus,none", "bus,bus,none"),
    ],
)
def test_agent_type_examples(spark, cell, want):
    df = spark.createDataFrame([(cell,)], "agent_type string")
    values = VOCABULARY["agent_type"] + (["red"] if cell == "red,," else [])
    row = va.clean_column(df, "agent_type", values, "clean").collect()[0]
    assert row.clean == want == check_cell("agent_type", cell, values)[0]
    assert len(row.clean_outcomes) == want.count(",") + 1


def test_random_rows_follow_the_contract(spark):
    rng = random.Random(3)
    parts = ["", " ", "\t", "none", "car", "Turn Left", "u-turn", "lane change", "no", "xyz", "é", "_"]
    parts += [v for values in VOCABULARY.values() for v in values]

    def cell():
        if rng.random() < 0.1:
            return None
        return ",".join(rng.choice(parts) + rng.choice(["", "", " ", "x"]) for _ in range(rng.choice([1, 1, 1, 2, 3])))

    rows = [
        (i, *[cell() for _ in VOCABULARY], rng.choice(["high", "medium", "low", None]), rng.choice(["", None, "said"]))
        for i in range(300)
    ]
    schema = "id int, " + ", ".join(f"{f} string" for f in response_fields())
    df = spark.createDataFrame(rows, schema)
    got = {r.id: r for r in va.validate_rows(df).collect()}
    for row in rows:
        level, notes = row[-2] or "low", row[-1] or ""
        warnings = []
        for f, c in zip(VOCABULARY, row[1:-2]):
            clean, more = check_cell(f, c, VOCABULARY[f])
            assert got[row[0]][f] == clean
            warnings += more
        if warnings:
            text = "VALIDATION: " + "; ".join(warnings)
            notes = f"{notes}; {text}" if notes else text
            level = "medium" if level == "high" else level
        assert (got[row[0]].confidence, got[row[0]].confidence_notes) == (level, notes)
        assert len(got[row[0]].warnings) == len(warnings)

    again = {r.id: r for r in va.validate_rows(va.validate_rows(df).drop("warnings")).collect()}
    for i, r in got.items():
        assert all(again[i][f] == r[f] for f in VOCABULARY) and again[i].confidence == r.confidence


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="abcn oe,_-\t'\\é", max_size=12), min_size=1, max_size=30))
def test_any_text_follows_the_contract(spark, cells):
    values = ["ab", "b_c", "can't", "none", "a\\b"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    for r in va.clean_column(df, "c", values, "clean").collect():
        assert r.clean == check_cell("c", cells[r.i], values)[0]


def test_absent_fields_count_as_not_mentioned_and_others_pass(spark):
    df = spark.createDataFrame([("k", "Car", "x, Y")], "clip_id string, agent_type string, other string")
    r = va.validate_rows(df).collect()[0]
    assert r.agent_type == "car" and r.other == "x, Y" and r.clip_id == "k"
    assert r.maneuver_lat == "none" and r.confidence == "low" and r.confidence_notes == ""
    assert r.warnings == []


def test_vocabulary_values_that_are_not_in_normal_form_are_matched_like_any(spark):
    values = ["Big Dog", "cat"]
    df = spark.createDataFrame([("Big Dog",), ("cat",)], "c string")
    got = {r.c: r.clean for r in va.clean_column(df, "c", values, "clean").collect()}
    assert got == {c: check_cell("c", c, values)[0] for c in ("Big Dog", "cat")}


def test_failed_rows_are_set_aside(spark):
    df = spark.createDataFrame([(FAILED,), ("none",), (None,)], "maneuver_lat string")
    assert va.without_failed(df).count() == 2


def test_outcomes_long_view_and_lookup(spark):
    df = spark.createDataFrame(
        [(1, "lane_change_right,merge_split", "pickup"), (2, "none", "Bus, carx")],
        "id int, maneuver_lat string, agent_type string",
    )
    counts = {(r.field, r.outcome): r.n for r in va.outcome_counts(df).collect()}
    assert counts == {
        ("maneuver_lat", "exact"): 3,
        ("agent_type", "oov"): 1,
        ("agent_type", "exact"): 1,
        ("agent_type", "fuzzy"): 1,
    }
    long = va.long_view(df, ["id"], ["maneuver_lat"]).collect()
    assert sorted(map(tuple, long)) == [
        (1, "maneuver_lat", "lane_change_right"),
        (1, "maneuver_lat", "merge_split"),
        (2, "maneuver_lat", "none"),
    ]
    values = spark.createDataFrame(
        [("agent_type", "bus"), ("agent_type", "bus"), ("x", "carx")], "field string, value string"
    )
    found = va.lookup_values(df, "agent_type", values, "agent_type").select("id", "token", "known")
    assert sorted(map(tuple, found.collect())) == [(1, "pickup", False), (2, "bus", True), (2, "carx", False)]


def test_validation_is_projections_only(spark):
    df = spark.range(3).select(*[F.lit("none").alias(f) for f in response_fields()])
    plan = va.validate_rows(df)._jdf.queryExecution().executedPlan().toString()
    for node in ("Exchange", "Python", "Join", "Generate"):
        assert node not in plan
