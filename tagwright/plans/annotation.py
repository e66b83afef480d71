"""End to end: traces → annotated, validated table; then repair of what failed."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import unwrapped
from tagwright.operators.annotate import annotate
from tagwright.operators.prompts import prompt
from tagwright.operators.quality import summary
from tagwright.operators.recover import failed_rows, merge_repaired, recover, rows_of
from tagwright.operators.rows import non_blank
from tagwright.operators.validate import validate_rows
from tagwright.vocabulary import VOCABULARY, response_fields


@dataclass(frozen=True)
class Annotation:
    """How traces are annotated. Tables are written below ``folder``, which executors share."""

    folder: str
    answer: Callable[[dict], Mapping | str]
    key: str = "clip_id"
    text: str = "reasoning_trace"
    vocab: dict[str, list[str]] = field(default_factory=lambda: VOCABULARY)
    attempts: int = 3
    partitions: int | None = None
    sleep: Callable[[float], None] = time.sleep

    @property
    def columns(self) -> Sequence[str]:
        return [self.key, *response_fields(self.vocab)]

    def run(self, traces: DataFrame, name: str) -> DataFrame:
        """Annotate all non-blank traces and return the written table ``name``.

        The answers are written before anything else uses them, so that each
        trace is sent to the service once and a later failure costs no calls.
        A name that was used before is refused rather than overwritten.
        """
        spark = traces.sparkSession
        answers = f"{self.folder}/{name}_answers"
        asked = non_blank(traces, self.text).withColumn(self.text, unwrapped(self.text))
        asked = asked.withColumn("prompt", prompt(F.col(self.key), F.col(self.text)))
        annotate(
            asked.select(self.key, self.text, "prompt"),
            [self.key],
            self.answer,
            self.vocab,
            self.attempts,
            self.partitions,
            self.sleep,
        ).write.parquet(answers)

        answered = spark.read.parquet(answers)
        failed = F.col("status") == "failed"
        valid = validate_rows(answered.filter(~failed), self.vocab).select(*self.columns)
        table = f"{self.folder}/{name}"
        valid.unionByName(answered.filter(failed).select(*self.columns)).write.parquet(table)
        return spark.read.parquet(table)

    def failed_traces(self, table: DataFrame, traces: DataFrame) -> DataFrame:
        """Every failed row with its trace, for inspection or another tool."""
        return recover(failed_rows(table), traces, self.key, [self.text])

    def repair(self, table: DataFrame, traces: DataFrame, name: str) -> DataFrame:
        """Annotate all traces of the failed keys again, as ``name``, and return the merged table.

        Each such trace is asked once, however many failed rows its key has.
        """
        again = rows_of(traces, failed_rows(table), self.key)
        return merge_repaired(table, self.run(again, name), self.key)

    def summary(self, table: DataFrame) -> DataFrame:
        return summary(table, marker=next(iter(self.vocab)))
