"""The annotation run without calls: request files out, answer files in, tables between."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.functions.text import unwrapped
from tagwright.operators.prompts import CLOSING_JSON, CLOSING_TOOL, prompt, request_body, request_line
from tagwright.operators.quality import summary
from tagwright.operators.recover import failed_rows, merge_repaired, missing, rows_of
from tagwright.operators.responses import NO_ANSWER, OK, answer_text, decode_responses, mark_failed
from tagwright.operators.rows import non_blank
from tagwright.operators.validate import validate_rows
from tagwright.sources.files import write_lines
from tagwright.vocabulary import VOCABULARY, response_fields

# Where a line of an answer file holds the service's response.
BODY = {"json_schema": "$.response.body", "tool": "$.result.message"}


@dataclass(frozen=True)
class OfflineAnnotation:
    """How traces become request lines, and answer lines a validated table, below ``folder``.

    ``style`` is that of ``request_body``. Keys are matched as text.
    """

    folder: str
    system: str
    model: str
    style: str = "json_schema"
    key: str = "clip_id"
    text: str = "reasoning_trace"
    vocab: dict[str, list[str]] = field(default_factory=lambda: VOCABULARY)
    attempts: int = 1

    def requests(self, traces: DataFrame, name: str) -> str:
        """Write one request line per non-blank trace; returns the folder of lines."""
        asked = non_blank(traces, self.text).withColumn(self.text, unwrapped(self.text))
        closing = CLOSING_TOOL if self.style == "tool" else CLOSING_JSON
        body = request_body(
            prompt(F.col(self.key), F.col(self.text), closing), self.system, self.model, self.style, self.vocab
        )
        path = f"{self.folder}/{name}_requests"
        write_lines(asked.select(request_line(F.col(self.key), body).alias("line")), "line", path, "error")
        return path

    def answers(self, spark: SparkSession, path: str) -> DataFrame:
        """``(custom_id, answer)`` of answer lines; ``answer`` is NULL where the service gave none."""
        line = F.try_parse_json("value")
        body = F.to_json(F.try_variant_get(line, BODY[self.style], "variant"))
        told = spark.read.text(path).select(
            F.try_variant_get(line, "$.custom_id", "string").alias("custom_id"), body.alias("body")
        )
        return told.select("custom_id", answer_text(F.col("body"), self.style).alias("answer"))

    def table(self, traces: DataFrame, answers: DataFrame, name: str) -> DataFrame:
        """Decode, mark what failed, validate the rest, and return the written table ``name``.

        Every non-blank trace has rows: one without an answer, or with one that ``decode_responses`` refuses, becomes a
        dead-letter row. Answers to other keys are left out. ``status`` says what happened.
        """
        spark, id_ = traces.sparkSession, self.key
        asked = non_blank(traces, self.text).select(id_).distinct()
        keyed = asked.withColumn("custom_id", F.col(id_).cast("string"))
        known = keyed.join(answers, "custom_id")
        decoded = decode_responses(known.select(id_, "answer"), [id_], "answer", self.vocab)
        none = known.filter("answer IS NULL").select(id_)
        lost = missing(asked, known, id_).union(none).distinct()
        fields = response_fields(self.vocab)
        silent = lost.select(id_, F.lit(NO_ANSWER).alias("status"), *[F.lit(None).cast("string").alias(f) for f in fields])
        every = missing(decoded, none, id_).unionByName(silent)
        path = f"{self.folder}/{name}"
        mark_failed(every, F.col("status") != OK, self.attempts, self.vocab).write.parquet(f"{path}_decoded")

        judged = spark.read.parquet(f"{path}_decoded")
        columns = [id_, "status", *fields]
        valid = validate_rows(judged.filter(F.col("status") == OK), self.vocab).select(*columns)
        valid.unionByName(judged.filter(F.col("status") != OK).select(*columns)).write.parquet(path)
        return spark.read.parquet(path)

    def failed_traces(self, table: DataFrame, traces: DataFrame) -> DataFrame:
        """The traces of the failed keys, once each, for another round of requests."""
        return rows_of(traces, failed_rows(table), self.key)

    def merge(self, table: DataFrame, repaired: DataFrame) -> DataFrame:
        return merge_repaired(table, repaired, self.key)

    def summary(self, table: DataFrame) -> DataFrame:
        return summary(table, marker=next(iter(self.vocab)))
