"""Counts of a growing folder, one partial row set per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwright.functions.text import named

BATCH = "__batch"


def write_partial(df: DataFrame, batch: int, target: str, by: Sequence[str], columns: Sequence[Column]) -> None:
    """The counts of one batch, in a folder of its own: writing the batch again replaces it."""
    grouped = df.groupBy(*by) if by else df.groupBy()
    grouped.agg(*columns).write.mode("overwrite").parquet(f"{target}/{BATCH}={batch}")


def count_new_files(
    spark: SparkSession,
    source: str,
    schema: str | T.StructType,
    target: str,
    checkpoint: str,
    columns: Sequence[Column],
    by: Sequence[str] = (),
    max_files: int | None = None,
    timeout: float | None = None,
) -> bool:
    """Count every file of ``source`` not yet counted and keep the partial counts in ``target``.

    ``columns`` are named aggregates whose totals are sums: counts, ``count_if``, sums. Old files are not read again. A batch that
    runs twice, after a failure, has the same number and the same files, so it replaces its own counts.
    Returns False if ``timeout`` seconds passed first.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def one(df: DataFrame, batch: int) -> None:
        write_partial(df, batch, target, by, columns)

    query = (
        reader.parquet(source).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    try:
        return query.awaitTermination(timeout) is not False
    finally:
        query.stop()


def totals(spark: SparkSession, target: str, by: Sequence[str] = ()) -> DataFrame:
    """The counts of all batches so far: one row per ``by``, or one row."""
    partial = spark.read.parquet(target).drop(BATCH)
    sums = [F.sum(F.col(named(c))).alias(c) for c in partial.columns if c not in by]
    return partial.groupBy(*by).agg(*sums)
