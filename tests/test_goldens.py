"""The published run's figures, on tables of its shape: counts, one warning, repair of the failed rows."""

import pytest
from pyspark.sql import functions as F

from tagwright.functions.text import unwrapped
from tagwright.operators import quality as qa
from tagwright.operators import recover as rc
from tagwright.operators import validate as va
from tagwright.vocabulary import FAILED, VOCABULARY, response_fields

# How often each value stands among the 139 rows that did not fail; one row has two values.
LATERAL = {
    "none": 74, "lane_keeping": 35, "out_of_lane_nudge": 18, "merge_split": 4, "lane_change_right": 3,
    "turn_left": 2, "turn_right": 2, "lane_change_left": 1, "in_lane_nudge": 1,
}
FAILED_PLACES = [123, 124, 125, 126, 129, 138, 140, 146]


@pytest.fixture(scope="module")
def published(spark):
    """147 rows of 146 clips: 138 high, one medium, 8 failed."""
    singles = [v for v, n in LATERAL.items() for _ in range(n)]
    two = f"{singles.pop(singles.index('turn_left'))},{singles.pop(singles.index('lane_change_left'))}"
    lateral, rows, detail = [*singles[:76], two, *singles[76:]], [], 0
    for i in range(147):
        clip = f"clip{i - 1 if i == 76 else i:03d}"
        row = dict.fromkeys(VOCABULARY, "none") | {"maneuver_long": "set_speed_tracking"}
        if i in FAILED_PLACES:
            row = dict.fromkeys(VOCABULARY, FAILED) | {"confidence": "low", "confidence_notes": "Failed after 3 attempts"}
        else:
            at = i - sum(p < i for p in FAILED_PLACES)
            row |= {"maneuver_lat": lateral[at], "confidence": "high", "confidence_notes": None}
            if at == 118:
                # The one value outside the vocabulary.
                row |= {"agent_type": "pickup", "confidence": "medium",
                        "confidence_notes": "VALIDATION: agent_type: 'pickup' NOT in vocabulary"}
            elif at >= 40 and detail < 31:
                row["lane_relation"] = VOCABULARY["lane_relation"][0]
                detail += 1
        rows.append((clip, *[row[f] for f in response_fields()]))
    return spark.createDataFrame(rows, "clip_id string, " + ", ".join(f"{f} string" for f in response_fields()))


@pytest.fixture(scope="module")
def traces(spark):
    rows = [(f"clip{i:03d}", f"[['Trace {i}, with a comma']]") for i in range(147)]
    return spark.createDataFrame(rows, "clip_id string, reasoning_trace string")


def test_failed_rows_find_their_traces(published, traces):
    failed = rc.failed_rows(published)
    found = rc.recover(failed, traces, "clip_id", ["reasoning_trace"])
    assert sorted(r.clip_id for r in found.collect()) == [f"clip{i:03d}" for i in FAILED_PLACES]
    assert found.filter("reasoning_trace IS NULL").isEmpty()


def test_summary_of_the_run(published):
    counts = qa.summary(published).collect()[0]
    assert (counts.rows, counts.high, counts.medium, counts.low, counts.errors) == (147, 138, 1, 8, 8)
    assert published.select("clip_id").distinct().count() == 146


def test_validating_again_changes_no_value_and_warns_once(published):
    fine = va.without_failed(published)
    after = va.validate_rows(fine)
    assert fine.count() == 139
    before = {tuple(r[f] for f in VOCABULARY) for r in fine.collect()}
    assert {tuple(r[f] for f in VOCABULARY) for r in after.collect()} == before
    warned = after.filter(F.size("warnings") > 0).collect()
    assert len(warned) == 1 and warned[0].confidence_notes.endswith("agent_type: 'pickup' NOT in vocabulary")


def test_values_of_the_lateral_maneuver(published):
    view = va.long_view(va.without_failed(published), ["clip_id"], ["maneuver_lat"])
    assert {r.value: r.n for r in qa.counts(view, "value").collect()} == LATERAL


def test_rule_counts(published):
    found = qa.counts(qa.check_rules(va.without_failed(published), "clip_id"), "rule").collect()
    counts = {r.rule: r.n for r in found}
    assert counts.get(qa.NO_MANEUVER, 0) == 0
    assert counts[qa.DIFFERING_CONTEXT] == 1
    assert counts[qa.AGENT_DETAILS] == 31
    assert counts.get(qa.HIGH_WITH_NOTES, 0) == 0
    assert counts[qa.OUT_OF_VOCABULARY] == 1


def test_traces_are_unwrapped(traces):
    got = traces.select(unwrapped("reasoning_trace").alias("t")).collect()
    assert [r.t for r in got] == [f"Trace {i}, with a comma" for i in range(147)]
