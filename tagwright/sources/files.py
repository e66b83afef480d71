"""CSV, Parquet and request files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwright.functions.text import named
from tagwright.vocabulary import NOT_MENTIONED

# Quotes inside quotes are doubled, as most CSV writers do; Spark's own default is a backslash.
_CSV = {
    "header": True,
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


# Cells that count as missing by default in data frame libraries.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same table, or a ``ValueError`` that lists what is available. Starts no job."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns {absent} not found; available: {df.columns}")
    return df


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    required: Sequence[str] = (),
    multi_line: bool = False,
    null_tokens: Sequence[str] = (),
) -> DataFrame:
    """CSV with a header. Without a schema all columns are text; types are never guessed.

    Headers of all files must agree with the schema. Empty cells are NULL.
    ``multi_line`` allows line breaks inside quotes, at the price of reading each
    file in one task. Text cells that are one of ``null_tokens`` are NULL too, whatever their
    column's type; ``NULL_TOKENS`` are those that data frame libraries take for missing.
    """
    reader = spark.read.options(**_CSV, enforceSchema=False, multiLine=multi_line)
    if not null_tokens:
        return require_columns((reader.schema(schema) if schema else reader).csv(path), required)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if wanted:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in wanted]))
    text = require_columns(reader.csv(path), required)
    kinds = {f.name: f.dataType for f in wanted or text.schema}
    known = F.array(*[F.lit(t) for t in null_tokens])
    return text.select(
        *[
            F.when(~F.array_contains(known, F.col(named(c))), F.col(named(c))).try_cast(kinds[c]).alias(c)
            for c in text.columns
        ]
    )


def read_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One Parquet column; the scan reads nothing else."""
    return spark.read.parquet(path).select(column)


def with_columns_in_order(
    df: DataFrame, columns: Sequence[str], default: str = NOT_MENTIONED
) -> DataFrame:
    """Exactly these columns; one the table lacks is filled with ``default``, NULLs stay."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(default).alias(c) for c in columns]
    )


def write_csv(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite"
) -> None:
    """A folder of CSV files with a header each, one per task."""
    out = df if columns is None else with_columns_in_order(df, columns)
    out.write.mode(mode).options(**_CSV, emptyValue="").csv(path)


def write_lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    """One text line per row, e.g. request bodies as JSON lines."""
    df.select(column).write.mode(mode).text(path)
