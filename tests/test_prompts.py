import json

import pytest
from pyspark.sql import functions as F

from tagwright.operators import prompts as pr
from tagwright.vocabulary import FIELD_DEFINITIONS, VOCABULARY, field_table, vocabulary_table


def test_prompt_text(spark):
    df = spark.createDataFrame([("001", 'Keep "distance" {text}.')], "id string, t string")
    got = pr.add_prompt(df, "id", "t", closing=pr.CLOSING_TOOL, what="driving trace").collect()[0].prompt
    assert got == (
        "Parse the following driving trace into the ontology.\n\nClip ID: 001\n"
        'Reasoning Trace: "Keep "distance" {text}."\n\n'
        "Call the submit_ontology_parse tool with the parsed result."
    )


def test_vocabulary_and_definition_blocks(spark):
    table = vocabulary_table(spark)
    lines = {r.field: r.line for r in pr.vocabulary_lines(table).collect()}
    assert lines == {f: f"  {f}: [{', '.join(v)}]" for f, v in VOCABULARY.items()}
    blocks = {r.field: r.block for r in pr.definition_blocks(table).collect()}
    assert set(blocks) == {"maneuver_lat", "maneuver_long"}
    assert blocks["maneuver_lat"].split("\n")[9] == (
        "  - **u_turn**: Planned path reversing the direction of travel."
    )
    assert len(blocks["maneuver_long"].split("\n")) == 7
    fields = {r.group: r.block for r in pr.definition_blocks(field_table(spark), "group", value="field").collect()}
    lines = [f"  - **{f}**: {d}" for f, d in FIELD_DEFINITIONS.items()]
    assert fields == {"environment": "\n".join(lines[:6]), "agent": "\n".join(lines[6:])}


@pytest.mark.parametrize("hot_rows", [None, 4])
def test_blocks_of_any_size_come_in_pieces(spark, hot_rows):
    table = vocabulary_table(spark)
    whole = {(r.field, 0): r.line for r in pr.vocabulary_lines(table).collect()}
    assert {(r.field, r.start): r.line for r in pr.vocabulary_pieces(table, hot_rows=hot_rows).collect()} == whole
    blocks = {(r.field, 0): r.block for r in pr.definition_blocks(table).collect()}
    assert {(r.field, r.start): r.block for r in pr.definition_pieces(table, hot_rows=hot_rows).collect()} == blocks
    many = spark.range(pr.MAX_LINES + 7).selectExpr("'f' AS field", "id AS position", "concat('v', id) AS value")
    lines = {r.start: r.line for r in pr.vocabulary_pieces(many, hot_rows=hot_rows and 3000).collect()}
    assert list(sorted(lines)) == [0, pr.MAX_LINES]
    assert lines[pr.MAX_LINES] == f"  f: [{', '.join(f'v{pr.MAX_LINES + i}' for i in range(7))}]"
    for size in (1, 3, 5):
        got = {}
        for r in pr.vocabulary_pieces(table, size, hot_rows).collect():
            got.setdefault(r.field, {})[r.start] = r.line.removeprefix(f"  {r.field}: [").removesuffix("]").split(", ")
        for field, values in VOCABULARY.items():
            assert got[field] == {i: values[i : i + size] for i in range(0, len(values), size)}


@pytest.mark.parametrize("hot_rows,max_turns", [(10**6, 10**6), (10**6, 3), (4, 10**6), (2, 2)])
def test_turns_become_whole_ordered_chats(spark, hot_rows, max_turns):
    rows = [(c, t, "user" if t % 2 else "bot", f"{c}{t}") for c, n in (("a", 1), ("b", 11), ("d", 4)) for t in range(n)]
    df = spark.createDataFrame(rows[::-1], "conv string, turn int, role string, text string")
    got = {}
    out = pr.messages_from_turns(df, ["conv"], max_turns=max_turns, hot_rows=hot_rows)
    for r in out.orderBy("conv", "start").collect():
        assert r.start == len(got.setdefault(r.conv, [])) and 0 < len(r.messages) <= max_turns
        got[r.conv] += [(m.role, m.content) for m in r.messages]
    want = {}
    for c, _, role, text in rows:
        want.setdefault(c, []).append((role, text))
    assert got == want


def test_copies_of_one_turn_do_not_make_an_oversized_cell(spark):
    df = spark.createDataFrame([("a", 0, "user", "same")] * 25, "conv string, turn int, role string, text string")
    for hot_rows in (100, 5):
        out = pr.messages_from_turns(df, ["conv"], max_turns=10, hot_rows=hot_rows).collect()
        found = sorted((r.start, len(r.messages)) for r in out)
        assert found == [(0, 10), (10, 10), (20, 5)]


def test_first_text_is_replaced(spark):
    df = spark.createDataFrame([("hi",)], "t string").select(pr.chat(F.col("t"), "rules").alias("m"))
    got = df.select(pr.with_first_text(F.col("m"), F.lit("new")).alias("m")).collect()[0].m
    assert [(m.role, m.content) for m in got] == [("system", "new"), ("user", "hi")]


@pytest.mark.parametrize("style", ["json_schema", "tool"])
def test_request_bodies_are_whole_json(spark, style):
    df = spark.createDataFrame([('say "é"\n\\',)], "t string")
    text = df.select(pr.request_body(F.col("t"), 'system "x"', "m", style).alias("b")).collect()[0].b
    body = json.loads(text)
    assert "\n" not in text
    assert (body["model"], body["max_tokens"], body["temperature"]) == ("m", 4096, 0.0)
    assert body["messages"][-1] == {"role": "user", "content": 'say "é"\n\\'}
    if style == "tool":
        assert body["system"] == 'system "x"' and len(body["messages"]) == 1
        assert body["tool_choice"] == {"type": "tool", "name": body["tools"][0]["name"]}
        schema = body["tools"][0]["input_schema"]
    else:
        assert body["messages"][0] == {"role": "system", "content": 'system "x"'}
        assert body["response_format"]["json_schema"]["strict"] is True
        schema = body["response_format"]["json_schema"]["schema"]
    assert list(schema["properties"]["rows"]["items"]["properties"])[:12] == list(VOCABULARY)
    with pytest.raises(ValueError):
        pr.request_body(F.col("t"), "s", "m", "other")
