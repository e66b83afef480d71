"""Closed-vocabulary validation. Everything is a projection: no shuffle, no Python worker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import (
    EXACT,
    NO_OUTCOMES,
    filled,
    judged,
    judged_tokens,
    named,
    nearest,
    normal_form_of,
    quoted,
    tokens,
    warning_text,
)
from tagwright.operators.skew import spread_join
from tagwright.vocabulary import CONFIDENCE, FAILED, NOT_MENTIONED, NOTES, VOCABULARY

Vocabulary = dict[str, list[str]]


class Judged:
    """A table whose vocabulary cells have been compared with their vocabularies.

    Most cells hold one token. Those are matched by plain CASE expressions, which
    Spark compiles; only a cell with a comma goes through array functions. Each
    step is a projection of its own, so that later ones reuse its columns
    instead of repeating the work. The methods give SQL text over ``rows``.
    """

    def __init__(self, df: DataFrame, vocab: Vocabulary, columns: dict[str, str] | None = None):
        """``columns`` names the column of each field where it is not the field itself."""
        self.vocab = vocab
        source = {f: (columns or {}).get(f, f) for f in vocab}
        cells = {
            f: filled(named(c)) if c in df.columns else quoted(NOT_MENTIONED)
            for f, c in source.items()
        }
        self.rows = df.selectExpr(
            "*", *[f"{normal_form_of(cells[f], v)} AS {self._token(f)}" for f, v in vocab.items()]
        ).selectExpr(
            "*",
            *[
                f"CASE WHEN NOT {self._many(f)} THEN {nearest(self._token(f), v)} END AS {self._hit(f)}"
                for f, v in vocab.items()
            ],
            *[
                f"CASE WHEN {self._many(f)} THEN {judged_tokens(cells[f], f, v)} END AS {self._all(f)}"
                for f, v in vocab.items()
            ],
        )

    @staticmethod
    def _token(field: str) -> str:
        return named(f"__token_{field}")

    @staticmethod
    def _hit(field: str) -> str:
        return named(f"__hit_{field}")

    @staticmethod
    def _all(field: str) -> str:
        return named(f"__all_{field}")

    def _many(self, field: str) -> str:
        return f"contains({self._token(field)}, ',')"

    def _one(self, field: str) -> str:
        return f"array({judged(field, self._token(field), self._hit(field))})"

    def value(self, field: str) -> str:
        """The cleaned cell: its tokens joined again, repeats and order kept."""
        joined = f"array_join(transform({self._all(field)}, o -> o.value), ',')"
        single = f"coalesce({self._hit(field)}, {self._token(field)})"
        return f"CASE WHEN {self._many(field)} THEN {joined} ELSE {single} END"

    def outcomes(self) -> str:
        """``ARRAY<STRUCT<field, token, outcome, value>>``, one element per token of each field."""
        each = [
            f"CASE WHEN {self._many(f)} THEN {self._all(f)} ELSE {self._one(f)} END" for f in self.vocab
        ]
        return f"concat({', '.join(each)})"

    def warnings(self) -> str:
        """The outcomes that are not exact, in vocabulary order."""
        exact = {f: f"{self._hit(f)} = {self._token(f)}" for f in self.vocab}
        each = [
            f"CASE WHEN {exact[f]} THEN {NO_OUTCOMES} WHEN {self._many(f)} "
            f"THEN filter({self._all(f)}, o -> o.outcome <> '{EXACT}') ELSE {self._one(f)} END"
            for f in self.vocab
        ]
        return (
            f"CASE WHEN {' AND '.join(exact.values())} THEN {NO_OUTCOMES} "
            f"ELSE concat({', '.join(each)}) END"
        )


def clean_column(
    df: DataFrame, col: str, values: list[str], out: str, field: str | None = None
) -> DataFrame:
    """Add the cleaned text as ``out`` and the per-token record as ``<out>_outcomes``."""
    name, record = field or col, f"{out}_outcomes"
    found = Judged(df, {name: values}, {name: col})
    return found.rows.selectExpr(
        *[named(c) for c in df.columns if c not in (out, record)],
        f"{found.value(name)} AS {named(out)}",
        f"{found.outcomes()} AS {named(record)}",
    )


def validate_rows(
    df: DataFrame,
    vocab: Vocabulary = VOCABULARY,
    confidence: str = CONFIDENCE,
    notes: str = NOTES,
) -> DataFrame:
    """Clean every vocabulary field and record what was changed.

    Fields the table lacks count as not mentioned; columns outside the
    vocabulary pass through. ``warnings`` holds all tokens that were not exact.
    A row with warnings gets them appended to its notes, and ``high`` confidence
    becomes ``medium``. Rows that failed annotation must not be passed in: see
    ``without_failed``.
    """

    def given(column: str, default: str) -> str:
        there = column in df.columns
        return f"coalesce({named(column)}, {quoted(default)})" if there else quoted(default)

    found = Judged(df, vocab)
    order = list(dict.fromkeys([*df.columns, *vocab, confidence, notes]))
    cleaned = {f: found.value(f) for f in vocab}
    cleaned |= {confidence: given(confidence, "low"), notes: given(notes, "")}
    values = found.rows.selectExpr(
        *[f"{cleaned.get(c, named(c))} AS {named(c)}" for c in order],
        f"{found.warnings()} AS warnings",
    )
    texts = f"array_join(transform(warnings, w -> {warning_text('w')}), '; ')"
    report = f"concat_ws('; ', nullif({named(notes)}, ''), concat('VALIDATION: ', {texts}))"
    level = named(confidence)
    after = {
        confidence: f"CASE WHEN size(warnings) > 0 AND {level} = 'high' THEN 'medium' ELSE {level} END",
        notes: f"CASE WHEN size(warnings) > 0 THEN {report} ELSE {named(notes)} END",
    }
    return values.selectExpr(
        *[f"{after.get(c, named(c))} AS {named(c)}" for c in [*order, "warnings"]]
    )


def without_failed(df: DataFrame, marker: str = "maneuver_lat") -> DataFrame:
    """Rows that are not failure rows, judged by one field."""
    return df.filter(~F.col(marker).eqNullSafe(FAILED))


def token_outcomes(df: DataFrame, vocab: Vocabulary = VOCABULARY) -> DataFrame:
    """One row per token of every vocabulary field: ``(field, token, outcome, value)``."""
    found = Judged(df, {f: v for f, v in vocab.items() if f in df.columns})
    return found.rows.selectExpr(f"inline({found.outcomes()})")


def outcome_counts(df: DataFrame, vocab: Vocabulary = VOCABULARY) -> DataFrame:
    """``(field, outcome, n)``: how many tokens were exact, matched or unknown."""
    return token_outcomes(df, vocab).groupBy("field", "outcome").agg(F.count("*").alias("n"))


def long_view(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per (key, field, value); a cell with several values gives several rows."""
    entries = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).alias("cell")) for f in fields]
    )
    cells = df.select(*keys, F.inline(entries))
    return cells.select(*keys, "field", F.explode(F.split("cell", ",", -1)).alias("value"))


def lookup_values(df: DataFrame, col: str, vocabulary: DataFrame, field: str) -> DataFrame:
    """Exact membership as a join, for vocabularies too large for a literal.

    Explodes the cell into tokens and adds ``token`` and ``known``. The
    vocabulary is reduced to distinct values first, so rows never multiply, and
    a token that makes up much of the table can be split over several tasks.
    """
    values = (
        vocabulary.filter(F.col("field") == field)
        .select(F.col("value").alias("token"))
        .distinct()
        .withColumn("known", F.lit(True))
    )
    exploded = df.selectExpr("*", f"explode({tokens(filled(named(col)))}) AS token")
    return spread_join(exploded, values, "token", "left").withColumn(
        "known", F.coalesce("known", F.lit(False))
    )

