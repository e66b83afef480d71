"""Prompt texts, chat messages and request bodies as columns."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import named
from tagwright.operators.skew import HOT_ROWS, Ordered, bounded_lists
from tagwright.vocabulary import TOOL_NAME, VOCABULARY, response_json_schema

# The per-row prompt, its two closing lines, and the names and texts in request bodies.
PROMPT = (
    "Parse the following {what} into the ontology.\n\n"
    "Clip ID: {key}\n"
    'Reasoning Trace: "{text}"\n\n'
    "{closing}"
)
CLOSING_TOOL = "Call the submit_ontology_parse tool with the parsed result."
CLOSING_JSON = "Return the parsed JSON."
FORMAT_NAME = "ontology_parse"
SUBJECT = "CoC reasoning trace"
TOOL_TEXT = (
    "Submit the parsed ontology for a CoC reasoning trace. "
    "Call this tool exactly once with the parsed result."
)
MAX_TOKENS = 4096
TEMPERATURE = 0.0

MAX_TURNS = 100_000
MAX_LINES = 10_000


def _joined(order: str, line: Column, joiner: str) -> Column:
    """Aggregate: the lines of a group in order; an error beyond ``MAX_LINES``."""
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), line.alias("line")))),
        lambda e: e["line"],
    )
    return F.when(
        F.count(F.lit(1)) > MAX_LINES, F.raise_error(F.lit(f"a group has more than {MAX_LINES} lines"))
    ).otherwise(F.array_join(lines, joiner))


def _small_groups(df: DataFrame, group: str, order: str) -> DataFrame:
    """All rows of groups up to the bound, and just enough of larger ones to raise the error.

    The rank is cut by each task before the shuffle, so no task gathers an unbounded group.
    """
    rank = f"row_number() OVER (PARTITION BY {named(group)} ORDER BY {named(order)})"
    return df.selectExpr("*", f"{rank} AS __rank").filter(f"__rank <= {MAX_LINES + 1}").drop("__rank")


def vocabulary_lines(vocabulary: DataFrame) -> DataFrame:
    """``(field, line)`` with ``  field: [a, b]``, from ``(field, position, value)``.

    A vocabulary has to fit in a prompt: a field of more than ``MAX_LINES`` values is an error; see ``vocabulary_pieces``.
    """
    values = _joined("position", F.col("value"), ", ")
    return _small_groups(vocabulary, "field", "position").groupBy("field").agg(values.alias("values")).select(
        "field", F.concat(F.lit("  "), "field", F.lit(": ["), "values", F.lit("]")).alias("line")
    )


def definition_blocks(
    definitions: DataFrame,
    group: str = "field",
    position: str = "position",
    value: str = "value",
    definition: str = "definition",
) -> DataFrame:
    """``(group, block)``: the lines ``  - **value**: text``; values without a text are left out."""
    line = F.concat(F.lit("  - **"), F.col(value), F.lit("**: "), F.col(definition))
    defined = definitions.filter(F.col(definition).isNotNull())
    return _small_groups(defined, group, position).groupBy(group).agg(_joined(position, line, "\n").alias("block"))


def _in_pieces(df: DataFrame, group: str, order: str, line: Column, lines: int, hot_rows: int | None) -> DataFrame:
    """``(group, start, lines)``: the lines of each group in order, at most ``lines`` in a row."""
    entries = Ordered(df.select(group, F.col(order).alias("__order"), line.alias("__line")), [group], ["__order", "__line"], 1, hot_rows)
    placed = entries.own_rows(entries.rows.selectExpr("*", f"{entries.position} AS position"))
    return bounded_lists(placed, entries.list_group, "position", lines, {"lines": "__line"})


def vocabulary_pieces(vocabulary: DataFrame, lines: int = MAX_LINES, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``(field, start, line)``: ``vocabulary_lines`` of any size, a line for every ``lines`` values.

    ``start`` is the 0-based index of the line's first value, 0, ``lines``, and so on. A field of up to ``lines`` values has the
    one line of ``vocabulary_lines``. A larger one is given to several prompts, or looked up by its pieces.
    """
    pieces = _in_pieces(vocabulary, "field", "position", F.col("value"), lines, hot_rows)
    joined = F.array_join("lines", ", ")
    return pieces.select("field", "start", F.concat(F.lit("  "), "field", F.lit(": ["), joined, F.lit("]")).alias("line"))


def definition_pieces(
    definitions: DataFrame,
    group: str = "field",
    position: str = "position",
    value: str = "value",
    definition: str = "definition",
    lines: int = MAX_LINES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``(group, start, block)``: ``definition_blocks`` of any size, in blocks of at most ``lines`` lines.

    Values without a text are left out and not counted.
    """
    line = F.concat(F.lit("  - **"), F.col(value), F.lit("**: "), F.col(definition))
    pieces = _in_pieces(definitions.filter(F.col(definition).isNotNull()), group, position, line, lines, hot_rows)
    return pieces.select(group, "start", F.array_join("lines", "\n").alias("block"))


def prompt(
    key: Column,
    text: Column,
    closing: str = CLOSING_JSON,
    what: str = SUBJECT,
    template: str = PROMPT,
) -> Column:
    """The user prompt of a row. ``template`` has the slots what, key, text and closing, each once."""
    filled = template.replace("{what}", what).replace("{closing}", closing)
    before, rest = filled.split("{key}")
    between, after = rest.split("{text}")
    return F.concat(F.lit(before), key.cast("string"), F.lit(between), text, F.lit(after))


def add_prompt(df: DataFrame, key: str, text: str, out: str = "prompt", **how) -> DataFrame:
    return df.withColumn(out, prompt(F.col(key), F.col(text), **how))


def message(role: str | Column, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def chat(user: Column, system: str | None = None) -> Column:
    """The message array of one request."""
    said = [message("user", user)]
    return F.array(*([message("system", F.lit(system))] if system is not None else []), *said)


def messages_from_turns(
    df: DataFrame,
    keys: Sequence[str],
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    max_turns: int = MAX_TURNS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``(keys, start, messages)`` with the turns of each conversation in order.

    Each row has ``max_turns`` messages, the last of a conversation up to that many; ``start`` is the
    0-based index of its first message, 0, ``max_turns``, and so on.
    """
    turns = Ordered(df.select(*keys, turn, role, text), keys, [turn, role, text], 1, hot_rows)
    placed = turns.own_rows(turns.rows.selectExpr("*", f"{turns.position} AS position"))
    said = f"named_struct('role', {named(role)}, 'content', {named(text)})"
    return bounded_lists(placed, turns.list_group, "position", max_turns, {"messages": said})


def with_first_text(messages: Column, text: Column, start: Column | None = None) -> Column:
    """The message array with the content of the conversation's first message replaced.

    ``start`` is that of ``messages_from_turns``: a later piece of a conversation has no first message.
    """
    begin = F.lit(0) if start is None else start
    return F.transform(
        messages, lambda m, i: F.when(i + begin == 0, m.withField("content", text)).otherwise(m)
    )


def request_body(
    user: Column,
    system: str,
    model: str,
    style: str = "json_schema",
    vocab: dict[str, list[str]] = VOCABULARY,
    max_tokens: int = MAX_TOKENS,
    temperature: float = TEMPERATURE,
    tool_description: str = TOOL_TEXT,
) -> Column:
    """One JSON request per row, for a service's offline batch input.

    ``style`` is ``json_schema`` (system message and response format) or ``tool``
    (system text and one forced tool). All but the messages is the same for every
    row and is written once, as literal text around them.
    """
    schema = json.loads(response_json_schema(vocab))
    head = {"model": model, "max_tokens": max_tokens}
    if style == "json_schema":
        messages = chat(user, system)
        shape = {"name": FORMAT_NAME, "strict": True, "schema": schema}
        tail = {"response_format": {"type": "json_schema", "json_schema": shape}}
    elif style == "tool":
        messages = chat(user)
        head["system"] = system
        tool = {"name": TOOL_NAME, "description": tool_description, "input_schema": schema}
        tail = {"tools": [tool], "tool_choice": {"type": "tool", "name": TOOL_NAME}}
    else:
        raise ValueError(f"unknown style {style!r}")
    tail["temperature"] = temperature
    before = json.dumps(head, ensure_ascii=False)[:-1] + ', "messages": '
    after = ", " + json.dumps(tail, ensure_ascii=False)[1:]
    return F.concat(F.lit(before), F.to_json(messages), F.lit(after))


def request_line(key: Column, body: Column) -> Column:
    """A line of a batch file: the row's key as ``custom_id``, by which the answer is found again, and the body."""
    named_key = F.to_json(F.struct(key.cast("string").alias("custom_id")))
    return F.concat(F.substring(named_key, F.lit(1), F.length(named_key) - 1), F.lit(', "body": '), body, F.lit("}"))
