"""Tables in parts of their key, of which a merge reads and rewrites only those that change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.functions.text import named
from tagwright.operators.matching import written
from tagwright.operators.recover import merge_repaired

PART = "__part"
PARTS = 1024


def _placed(df: DataFrame, key: str, parts: int) -> DataFrame:
    return df.withColumn(PART, F.expr(f"CAST(pmod(xxhash64({named(key)}), {parts}) AS INT)"))


def _write(df: DataFrame, path: str) -> None:
    # Rebalancing splits the part of a hot key over several tasks and files, and joins small ones.
    df.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def write_parts(df: DataFrame, path: str, key: str, parts: int = PARTS) -> None:
    """Write a table in at most ``parts`` folders by hash of the key, to be read with ``read_parts``."""
    _write(_placed(df, key, parts), path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def merge_parts(spark: SparkSession, path: str, fixed: DataFrame, key: str, parts: int = PARTS) -> int:
    """Replace all rows of the repaired keys by the rows of ``fixed``, as ``merge_repaired`` does; returns the parts rewritten.

    Only parts that hold a repaired key are read at all; the others' files stay as they are. ``parts`` must be that of
    ``write_parts``. The merged parts are written aside before they replace the old ones, and merging the same rows again changes
    nothing, so a merge that was cut off is simply repeated. The driver gets at most ``parts`` numbers.
    """
    table = spark.read.parquet(path)
    # Written once: the parts are found from it, and it is not computed again while its table changes.
    placed = _placed(written(fixed.select(*[named(c) for c in table.columns if c != PART]), "fixed"), key, parts)
    touched = sorted(r[0] for r in placed.select(PART).distinct().collect())
    if not touched:
        return 0
    old = table.filter(F.col(PART).isin(touched))
    merged = merge_repaired(old, placed.select(*[named(c) for c in old.columns]), key)
    _write(written(merged, "merged"), path)
    return len(touched)
