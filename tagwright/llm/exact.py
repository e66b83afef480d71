"""Exact dedup by skew-safe combining: locally, in salted digest groups, then over the salts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import lower_ascii, n_bytes, text_or_empty
from tagwright.operators.skew import spread_join

SALTS = 16

_ID = ["text_sha256", "__xx", "__n"]


def _identified(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, the normalised text, and what tells texts apart without carrying them."""
    text = docs.select("doc_id", *more, lower_ascii(text_or_empty()).alias("__text"))
    return text.select(
        "doc_id",
        *more,
        "__text",
        F.sha2("__text", 256).alias("text_sha256"),
        F.xxhash64("__text").alias("__xx"),
        n_bytes(F.col("__text")).alias("__n"),
    )


def text_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: its identity, ``keep_id`` and ``group_size``.

    The text is part of every grouping key, so contents are compared in full, not only
    digests. Spark combines the rows of a task before each shuffle: first equal texts of a
    task, then those of a (digest, salt) group, then the winners of the salts. The salt is
    the input partition, so a text that is a third of the table reaches the salted
    stage once per task and the last stage once per salt.
    """
    rows = _identified(docs).withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = rows.groupBy(*_ID, "__salt", "__text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return (
        salted.groupBy(*_ID, "__text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .drop("__text")
    )


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """Per row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if the same after lower-casing A-Z; null is the empty text. The largest
    doc_id of a group stays. Rows without a doc_id never win against one with it; a group with
    no doc_id at all has no ``keep_id``, and its rows count as kept. Repeated rows of the winning
    doc_id all count as kept here; ``deduplicated`` returns one of them. Other columns are ignored.
    An empty table gives no rows.
    """
    rows = _identified(docs).drop("__text")
    joined = spread_join(rows, text_groups(docs, salts), _ID, "inner")
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.expr("doc_id <=> keep_id").alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows that stay, one per distinct text, with all their columns.

    Rows are shuffled once by doc_id and text identity, repeated ones combined in each task before; the winners meet
    them there. A group without any doc_id keeps one of its rows.
    """
    own = [F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(docs.columns)]
    key = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")).alias("__key")
    rows = docs.select(key, F.struct(*own).alias("__row"), lower_ascii(text_or_empty()).alias("__text")).select(
        "__key",
        "__row",
        F.sha2("__text", 256).alias("text_sha256"),
        F.xxhash64("__text").alias("__xx"),
        n_bytes(F.col("__text")).alias("__n"),
    )
    one = rows.groupBy("__key", *_ID).agg(F.first("__row").alias("__row"))
    winners = text_groups(docs, salts).withColumnRenamed("keep_id", "doc_id").select(key, *_ID)
    kept = one.join(winners, ["__key", *_ID])
    return kept.select(*[F.col(f"__row.__c{i}").alias(c) for i, c in enumerate(docs.columns)])
