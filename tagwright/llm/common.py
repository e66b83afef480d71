"""What the operators share: written tables, texts as bytes, words."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.sources.shared import shared_folder

#: A word is a longest run of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write below the shared folder and read back: later steps and retries see the same rows."""
    folder = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def n_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column in UTF-8, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def per_batch(
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that turns each batch into one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield work(batch)

    return run
