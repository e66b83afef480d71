"""Inputs without an output, while outputs still arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing_stream(inputs: DataFrame, outputs: DataFrame, key: str, time: str, within: str, late: str = "0 seconds") -> DataFrame:
    """Input rows that have had no output within ``within`` of their ``time``, each once.

    Both are streams with ``key`` and an event time. A row is told as missing as soon as the watermarks of both streams, which run
    ``late`` behind the greatest times seen, have passed the end of its interval; then it leaves the state. State holds the rows of
    one interval, whatever the streams' length. Inputs without a key are always missing.
    """
    told = outputs.select(F.col(key).alias("__key"), F.col(time).alias("__time")).withWatermark("__time", late)
    same = (
        F.col(key).eqNullSafe(F.col("__key")) & F.col("__key").isNotNull()
        & (F.col("__time") >= F.col(time)) & (F.col("__time") <= F.col(time) + F.expr(f"INTERVAL {within}"))
    )
    return inputs.withWatermark(time, late).join(told, same, "leftOuter").filter("__key IS NULL").drop("__key", "__time")


def missing_new_files(
    spark: SparkSession,
    inputs: str,
    inputs_schema: str | T.StructType,
    outputs: str,
    outputs_schema: str | T.StructType,
    target: str,
    checkpoint: str,
    key: str,
    time: str,
    within: str,
    late: str = "0 seconds",
    max_files: int | None = None,
    timeout: float | None = None,
) -> bool:
    """Read the new files of both folders and append to ``target`` the inputs now known to be missing. False after ``timeout``.

    Rows that wait for a later time stay in ``checkpoint`` until a run reads one; rows with a key that nobody uses can carry it.
    """

    def read(path: str, schema) -> DataFrame:
        reader = spark.readStream.schema(schema)
        return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).parquet(path)

    found = missing_stream(read(inputs, inputs_schema), read(outputs, outputs_schema), key, time, within, late)
    query = (
        found.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    try:
        return query.awaitTermination(timeout) is not False
    finally:
        query.stop()
