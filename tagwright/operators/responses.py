"""Decoding and checking of structured JSON answers: ``{"rows": [{field: text, …}]}``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwright.vocabulary import (
    CONFIDENCE,
    CONFIDENCE_LEVELS,
    FAILED,
    NOTES,
    TOOL_NAME,
    VOCABULARY,
    response_fields,
)

OK, BAD_JSON, NO_ROWS, NO_ANSWER = "ok", "bad_json", "no_rows", "no_answer"
MISSING, EXTRA, BAD_TYPE, BAD_LEVEL = "missing", "extra", "bad_type", "bad_confidence"


def _strict(json_col: str) -> Column:
    """The text inside an array: text after the JSON value then makes it invalid too."""
    return F.concat(F.lit("["), F.col(json_col), F.lit("]"))


def parse_json(df: DataFrame, json_col: str, schema: str, out: str) -> DataFrame:
    """Add ``out`` with the object in ``json_col``, and ``<out>_ok``: it is one JSON object, no key twice."""
    kind = T.ArrayType(T.StructType.fromDDL(schema))
    found = df.withColumns(
        {
            "__found": F.from_json(_strict(json_col), kind, {"allowSingleQuotes": "false"}),
            "__sound": F.try_parse_json(_strict(json_col)).isNotNull(),
        }
    )
    single = F.try_element_at("__found", F.lit(1))
    valid = F.coalesce(F.col("__sound") & (F.size("__found") == 1) & single.isNotNull(), F.lit(False))
    return found.withColumns({out: F.when(valid, single), f"{out}_ok": valid}).drop("__found", "__sound")


def _split_answers(df: DataFrame, keys: Sequence[str], json_col: str) -> DataFrame:
    """``(keys, __top, __rows)``: the answer's object, NULL unless it is one, and its rows as objects.

    A key that is there twice makes the answer unreadable, here as in ``annotate``.
    """
    parsed = df.select(*keys, F.try_parse_json(_strict(json_col)).alias("__parsed"))
    objects = F.try_variant_get("__parsed", "$", "array<map<string,variant>>")
    return (
        parsed.select(*keys, objects.alias("__objects"))
        .select(*keys, F.when(F.size("__objects") == 1, F.try_element_at("__objects", F.lit(1))).alias("__top"))
        .withColumn(
            "__rows",
            F.transform(
                F.try_variant_get(F.try_element_at("__top", F.lit("rows")), "$", "array<variant>"),
                lambda r: F.try_variant_get(r, "$", "map<string,variant>"),
            ),
        )
    )


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def decode_responses(
    df: DataFrame,
    keys: Sequence[str],
    json_col: str,
    vocab: dict[str, list[str]] = VOCABULARY,
) -> DataFrame:
    """One row per answered row, with the keys: ``(keys, status, fields…)``.

    An answer fails as a whole, with one row of NULL fields and that status, if it is no JSON object, has
    no rows, or has a row that is no object or a vocabulary field that is neither text nor null. Fields that are missing are
    NULL and unknown ones are dropped; ``check_responses`` reports both. ``annotate`` has the same rules.
    """
    fields = response_fields(vocab)
    split = _split_answers(df, keys, json_col)

    def other_type(row: Column) -> Column:
        kinds = [F.schema_of_variant(F.try_element_at(row, F.lit(f))) for f in vocab]
        return reduce(or_, [F.coalesce(~k.isin("STRING", "VOID"), F.lit(False)) for k in kinds])

    status = (
        F.when(F.col("__top").isNull(), BAD_JSON)
        .when(F.coalesce(F.size("__rows"), F.lit(0)) < 1, NO_ROWS)
        .when(F.exists("__rows", lambda r: r.isNull() | other_type(r)), BAD_TYPE)
        .otherwise(OK)
    )
    values = F.transform(
        "__rows",
        lambda r: F.struct(*[_text(F.try_element_at(r, F.lit(f))).alias(f) for f in fields]),
    )
    judged = split.select(*keys, status.alias("status"), "__rows")
    return judged.select(*keys, "status", F.inline_outer(F.when(F.col("status") == OK, values)))


def answer_text(response: Column, style: str = "json_schema") -> Column:
    """The answer inside a service's response body, NULL if it holds none.

    ``json_schema``: the content of the first choice's message. ``tool``: the input of the block that calls the tool of
    that name; text blocks and other tools are no answer.
    """
    body = F.try_parse_json(response)
    if style == "json_schema":
        return F.try_variant_get(body, "$.choices[0].message.content", "string")
    if style != "tool":
        raise ValueError(f"unknown style {style!r}")
    blocks = F.try_variant_get(body, "$.content", "array<variant>")
    calls = F.filter(
        blocks,
        lambda b: (F.try_variant_get(b, "$.type", "string") == "tool_use")
        & (F.try_variant_get(b, "$.name", "string") == TOOL_NAME),
    )
    return F.to_json(F.try_variant_get(F.try_element_at(calls, F.lit(1)), "$.input", "variant"))


def mark_failed(
    df: DataFrame,
    failed: Column,
    attempts: int = 3,
    vocab: dict[str, list[str]] = VOCABULARY,
) -> DataFrame:
    """Turn failed rows into dead-letter rows: marker in every field, low confidence, a note."""
    values = {f: F.lit(FAILED) for f in vocab}
    # Fixed value: the note of a failed row.
    values |= {CONFIDENCE: F.lit("low"), NOTES: F.lit(f"Failed after {attempts} attempts")}
    return df.withColumns(
        {f: F.when(failed, value).otherwise(F.col(f)) for f, value in values.items()}
    )


def check_responses(
    df: DataFrame,
    keys: Sequence[str],
    json_col: str,
    vocab: dict[str, list[str]] = VOCABULARY,
) -> DataFrame:
    """``(keys, status)`` with the first fault of each answer against the response schema.

    In this order: bad_json, extra (beside ``rows``), no_rows, bad_type (a row
    that is no object), missing, extra, bad_type (a value that is no string; null
    counts), bad_confidence.
    """
    wanted = F.array(*[F.lit(f) for f in response_fields(vocab)])
    split = _split_answers(df, keys, json_col)

    def any_row(test) -> Column:
        return F.exists("__rows", test)

    def other_type(row: Column) -> Column:
        return F.exists(F.map_values(row), lambda v: F.schema_of_variant(v) != "STRING")

    def other_level(row: Column) -> Column:
        level = F.try_variant_get(F.try_element_at(row, F.lit(CONFIDENCE)), "$", "string")
        return ~level.isin(CONFIDENCE_LEVELS)

    status = (
        F.when(F.col("__top").isNull(), BAD_JSON)
        .when(F.exists(F.map_keys("__top"), lambda k: k != "rows"), EXTRA)
        .when(F.coalesce(F.size("__rows"), F.lit(0)) < 1, NO_ROWS)
        .when(any_row(lambda r: r.isNull()), BAD_TYPE)
        .when(any_row(lambda r: F.size(F.array_except(wanted, F.map_keys(r))) > 0), MISSING)
        .when(any_row(lambda r: F.size(F.array_except(F.map_keys(r), wanted)) > 0), EXTRA)
        .when(any_row(other_type), BAD_TYPE)
        .when(any_row(other_level), BAD_LEVEL)
        .otherwise(OK)
    )
    return split.select(*keys, status.alias("status"))
