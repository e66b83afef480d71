"""Table-level checks and counts over annotated rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import UNKNOWN, blank_sql, named
from tagwright.operators.validate import Judged
from tagwright.vocabulary import (
    CONFIDENCE,
    CONFIDENCE_LEVELS,
    FAILED,
    GROUPS,
    NOT_MENTIONED,
    NOTES,
    VOCABULARY,
)

NO_MANEUVER = "no_maneuver"
DIFFERING_CONTEXT = "differing_context"
AGENT_DETAILS = "details_without_agent"
HIGH_WITH_NOTES = "high_with_notes"
BAD_LEVEL = "unknown_confidence"
OUT_OF_VOCABULARY = "out_of_vocabulary"


def check_rows(
    df: DataFrame,
    key: str,
    vocab: dict[str, list[str]] = VOCABULARY,
    groups: dict[str, list[str]] = GROUPS,
) -> DataFrame:
    """Rules on single rows, as ``(rule, key, detail)``: one row per violation, no shuffle.

    No agent but agent details; high confidence with notes; a confidence outside
    its levels; a value outside the vocabulary.
    """
    judged = Judged(df, vocab)
    agent, *details = groups["agent"]
    shown = ", ".join(f"CASE WHEN {d} <> '{NOT_MENTIONED}' THEN '{d}=' || {d} END" for d in details)
    levels = ", ".join(f"'{level}'" for level in CONFIDENCE_LEVELS)
    rules = {
        AGENT_DETAILS: (
            f"{agent} = '{NOT_MENTIONED}' AND coalesce({shown}) IS NOT NULL",
            f"concat_ws(',', {shown})",
        ),
        HIGH_WITH_NOTES: (
            f"{CONFIDENCE} = 'high' AND NOT {blank_sql(NOTES)}",
            NOTES,
        ),
        BAD_LEVEL: (f"NOT coalesce({CONFIDENCE} IN ({levels}), false)", CONFIDENCE),
    }
    unknown = f"filter(__warnings, w -> w.outcome = '{UNKNOWN}')"
    found = ", ".join(
        f"CASE WHEN {broken} THEN named_struct('rule', '{rule}', 'detail', {detail}) END"
        for rule, (broken, detail) in rules.items()
    )
    strange = (
        f"transform({unknown}, w -> named_struct('rule', '{OUT_OF_VOCABULARY}', "
        "'detail', w.field || '=' || w.token))"
    )
    any_broken = " OR ".join(f"({broken})" for broken, _ in rules.values())
    # No filter on clean rows: Spark would move it below the matching and match twice.
    violations = (
        f"CASE WHEN size(__warnings) > 0 OR {any_broken} "
        f"THEN array_compact(concat(array({found}), {strange})) END"
    )
    return (
        judged.rows.selectExpr("*", f"{judged.warnings()} AS __warnings")
        .selectExpr(f"{named(key)} AS key", f"inline({violations})")
        .select("rule", "key", "detail")
    )


def check_keys(
    df: DataFrame, key: str, groups: dict[str, list[str]] = GROUPS
) -> DataFrame:
    """Rules on all rows of a key, as ``(rule, key, detail)``, in one pre-aggregated shuffle.

    No row of the key has a maneuver; rows of the key differ in maneuver or
    environment. Least and greatest of two hashes of the context instead of a distinct count: hash aggregation, and a hot key
    costs four numbers per task. Contexts that differ have a hash that differs, but for one chance in 2^128.
    """
    context = [x for f in [*groups["maneuver"], *groups["environment"]] for x in (F.coalesce(f, F.lit("")), F.col(f).isNull())]
    acts = reduce(or_, [F.col(f) != NOT_MENTIONED for f in groups["maneuver"]])
    hashed = df.select(
        F.col(key).alias("key"), acts.alias("acts"), F.xxhash64(*context).alias("a"), F.xxhash64(F.lit(1), *context).alias("b")
    )
    per_key = hashed.groupBy("key").agg(
        F.coalesce(F.bool_or("acts"), F.lit(False)).alias("acts"),
        ((F.min("a") != F.max("a")) | (F.min("b") != F.max("b"))).alias("differs"),
    )
    rules = F.array_compact(
        F.array(
            F.when(~F.col("acts"), F.lit(NO_MANEUVER)),
            F.when(F.col("differs"), F.lit(DIFFERING_CONTEXT)),
        )
    )
    return per_key.select(F.explode(rules).alias("rule"), "key", F.lit(None).cast("string").alias("detail"))


def check_rules(
    df: DataFrame,
    key: str,
    vocab: dict[str, list[str]] = VOCABULARY,
    groups: dict[str, list[str]] = GROUPS,
) -> DataFrame:
    """All rules, as ``(rule, key, detail)``. Leave failed rows out: see ``without_failed``."""
    return check_rows(df, key, vocab, groups).unionByName(check_keys(df, key, groups))


def summary_columns(marker: str = "maneuver_lat") -> list[Column]:
    """Counts of a result: rows, the confidence levels, any other level, failed rows."""
    level = F.col(CONFIDENCE)
    known = F.coalesce(level.isin(CONFIDENCE_LEVELS), F.lit(False))
    return [
        F.count("*").alias("rows"),
        *[F.count_if(level == name).alias(name) for name in CONFIDENCE_LEVELS],
        F.count_if(~known).alias("other"),
        F.count_if(F.col(marker) == FAILED).alias("errors"),
    ]


def summary(df: DataFrame, marker: str = "maneuver_lat") -> DataFrame:
    """One row of counts; every level is there even if no row has it."""
    return df.agg(*summary_columns(marker))


def observed(df: DataFrame, name: str, marker: str = "maneuver_lat") -> DataFrame:
    """The same rows, with ``summary`` counted along the way instead of in a second pass."""
    return df.observe(name, *summary_columns(marker))


def counts(df: DataFrame, by: str | Sequence[str] = "status") -> DataFrame:
    by = [by] if isinstance(by, str) else by
    return df.groupBy(*by).agg(F.count("*").alias("n"))
