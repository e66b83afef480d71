"""Finding failed or missing rows, fetching their inputs again, and merging repairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.operators.rows import any_contains
from tagwright.operators.skew import spread_join
from tagwright.vocabulary import FAILED


def failed_rows(df: DataFrame, pattern: str = FAILED, regex: bool = True) -> DataFrame:
    """Rows in which any column contains the pattern."""
    return df.filter(any_contains(df, pattern, regex))


def rows_of(source: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Source rows whose key occurs in ``ids``."""
    return spread_join(source, ids.select(key).distinct(), key, "left_semi")


def recover(
    failed: DataFrame, source: DataFrame, key: str, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """``(key, columns…)``: every failed row with its source columns, NULL where there are none.

    Repeated keys on either side multiply, as in any left join. Both sides come
    straight from a shuffle, so Spark splits a hot key by itself. ``null_safe``
    lets a NULL key match a NULL key.
    """
    wanted = failed.select(key)
    found = source.select(F.col(key).alias("__source_key"), *columns)
    ours, theirs = F.col(key), F.col("__source_key")
    same = ours.eqNullSafe(theirs) if null_safe else ours == theirs
    return wanted.join(found, same, "left").select(key, *columns)


def missing(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Input rows whose key has no output row."""
    return spread_join(inputs, outputs.select(key).distinct(), key, "left_anti")


def merge_repaired(base: DataFrame, fixed: DataFrame, key: str) -> DataFrame:
    """``base`` with all rows of the repaired keys replaced by the rows of ``fixed``."""
    return missing(base, fixed, key).unionByName(fixed)
