import json

import pytest
from pyspark.sql import functions as F

from tagwright import vocabulary as vo
from tagwright.operators import responses as rs
from tagwright.operators.annotate import answered_rows

VOCAB = {"a": ["x", "none"], "b": ["y", "none"]}
ROW = {"a": "x", "b": "y", "confidence": "high", "confidence_notes": ""}


def rows(*some, **top):
    return json.dumps({"rows": list(some), **top})


CASES = [
    (rows(ROW), "ok", "ok", 1),
    (rows(ROW, ROW | {"a": "none"}), "ok", "ok", 2),
    (rows(), "no_rows", "no_rows", 0),
    ("{}", "no_rows", "no_rows", 0),
    ('{"rows": null}', "no_rows", "no_rows", 0),
    ('{"rows": "abc"}', "no_rows", "no_rows", 0),
    (rows({k: v for k, v in ROW.items() if k != "b"}), "ok", "missing", 1),
    (rows(ROW | {"c": "z"}), "ok", "extra", 1),
    (rows(ROW, note="z"), "ok", "extra", 1),
    (rows(ROW | {"b": 1}), "bad_type", "bad_type", 0),
    (rows(ROW, None), "bad_type", "bad_type", 0),
    (rows(None), "bad_type", "bad_type", 0),
    (rows(ROW).replace('"a"', '"a": "x", "a"'), "bad_json", "bad_json", 0),
    (rows(ROW | {"b": None}), "ok", "bad_type", 1),
    (rows(ROW | {"b": ["y"]}), "bad_type", "bad_type", 0),
    (rows(ROW, 5), "bad_type", "bad_type", 0),
    (rows(ROW | {"confidence": "sure"}), "ok", "bad_confidence", 1),
    (rows(ROW)[:-4], "bad_json", "bad_json", 0),
    (rows(ROW) + " Done.", "bad_json", "bad_json", 0),
    (rows(ROW) + "," + rows(ROW), "bad_json", "bad_json", 0),
    (rows(ROW).replace('"', "'"), "bad_json", "bad_json", 0),
    ("[1]", "bad_json", "bad_json", 0),
    ("null", "bad_json", "bad_json", 0),
    ("", "bad_json", "bad_json", 0),
    (None, "bad_json", "bad_json", 0),
]


@pytest.fixture(scope="module")
def answers(spark):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, js string")


def test_decoding_keeps_every_answer(answers):
    got = {}
    for r in rs.decode_responses(answers, ["id"], "js", VOCAB).collect():
        got.setdefault(r.id, []).append(r)
    for i, (text, decoded, _, n) in enumerate(CASES):
        assert {r.status for r in got[i]} == {decoded}, text
        assert len(got[i]) == max(n, 1)
        if n:
            assert got[i][0].a == "x" and got[i][0].confidence_notes == ""
        else:
            assert all(got[i][0][f] is None for f in vo.response_fields(VOCAB))


def test_conformance(answers):
    got = {r.id: r.status for r in rs.check_responses(answers, ["id"], "js", VOCAB).collect()}
    assert got == {i: c[2] for i, c in enumerate(CASES)}


def test_failed_answers_become_dead_letters(answers):
    decoded = rs.decode_responses(answers, ["id"], "js", VOCAB)
    out = rs.mark_failed(decoded, F.col("status") != rs.OK, 3, VOCAB).filter("status <> 'ok'")
    for r in out.collect():
        assert (r.a, r.b, r.confidence) == (vo.FAILED, vo.FAILED, "low")
        assert r.confidence_notes == "Failed after 3 attempts"


def test_the_function_and_the_table_path_refuse_the_same_answers(answers):
    decoded = {r.id: r.status for r in rs.decode_responses(answers, ["id"], "js", VOCAB).collect()}
    for i, (text, *_) in enumerate(CASES):
        try:
            found = bool(text) and bool(answered_rows(text, VOCAB))
        except Exception:
            found = False
        assert found == (decoded[i] == "ok"), text


def test_answers_inside_responses(spark):
    chat = {"choices": [{"message": {"content": "{}"}}]}
    call = {"type": "tool_use", "name": vo.TOOL_NAME, "input": {"rows": [ROW]}}
    said, other = {"type": "text", "text": "x"}, {"type": "tool_use", "name": "other", "input": {"rows": 1}}
    cases = [
        ("json_schema", chat, {}), ("json_schema", {"choices": []}, None), ("json_schema", {"error": 1}, None),
        ("tool", {"content": [said, other, call]}, {"rows": [ROW]}), ("tool", {"content": [said, other]}, None),
        ("tool", {"content": "x"}, None),
    ]
    for style, body, want in cases:
        df = spark.createDataFrame([(json.dumps(body),)], "b string")
        got = df.select(rs.answer_text(F.col("b"), style).alias("a")).collect()[0].a
        assert (json.loads(got) if got else None) == want
    with pytest.raises(ValueError, match="style"):
        rs.answer_text(F.lit(""), "x")


def test_parse_json(spark):
    twice = spark.createDataFrame([('{"k": 1, "k": 2}',)], "p string")
    assert not rs.parse_json(twice, "p", "k int", "f").collect()[0].f_ok
    df = spark.createDataFrame([('{"k": 69}',), ('{"k": 69',), ("[]",), (None,)], "p string")
    got = [(r.f.k if r.f else None, r.f_ok) for r in rs.parse_json(df, "p", "k int", "f").collect()]
    assert got == [(69, True), (None, False), (None, False), (None, False)]


def test_schemas_follow_the_vocabulary(spark):
    schema = json.loads(vo.response_json_schema())
    row = schema["properties"]["rows"]["items"]
    assert schema["required"] == ["rows"] and schema["properties"]["rows"]["minItems"] == 1
    assert row["required"] == list(row["properties"]) == vo.response_fields()
    assert row["additionalProperties"] is False and schema["additionalProperties"] is False
    assert row["properties"]["confidence"]["enum"] == ["high", "medium", "low"]
    assert row["properties"]["traffic_light"]["description"] == (
        "Comma-separated values from: green, yellow, red, flashing, arrow_green, arrow_red, none. "
        "Use 'none' if not applicable."
    )
    assert vo.response_type()["rows"].dataType.elementType.names == vo.response_fields()


def test_vocabulary_table(spark):
    table = vo.vocabulary_table(spark).collect()
    assert len(table) == 109 and len({r.field for r in table}) == 12
    assert {r.group for r in table} == {"maneuver", "environment", "agent"}
    assert all("none" in values for values in vo.VOCABULARY.values())
    sizes = [12, 8, 7, 12, 9, 7, 8, 7, 10, 8, 7, 14]
    assert [len(v) for v in vo.VOCABULARY.values()] == sizes
    assert sum(r.definition is not None for r in table) == 18 and len(vo.FIELD_DEFINITIONS) == 10
