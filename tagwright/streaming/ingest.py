"""Incremental processing of a growing input folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def process_new_files(
    spark: SparkSession,
    source: str,
    schema: str | T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files: int | None = None,
    timeout: float | None = None,
) -> bool:
    """Process every input file not yet processed, append the result to ``target``, and stop.

    ``source`` is a Parquet folder or glob. Progress is kept in ``checkpoint``,
    so a run that was cut off resumes where it stopped, and a run without new
    files adds nothing. ``max_files`` sets how many files make one committed step.
    ``transform`` must be row-wise. Returns False if ``timeout`` seconds passed first.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        transform(reader.parquet(source))
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        return query.awaitTermination(timeout) is not False
    finally:
        query.stop()
