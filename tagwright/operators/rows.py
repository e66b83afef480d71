"""Row selection: blank filter, first rows, one row by position, text search."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import blank_sql, named
from tagwright.sources.shared import shared_folder

FEW_ROWS = 10_000


def non_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text is neither NULL nor only whitespace."""
    return df.filter(f"NOT {blank_sql(named(col))}")


def _numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows in ranges of the order, written, and per range where it begins: ``(rows, ranges)``.

    ``__row`` numbers the rows of a range (``__range``). There is one row of ``ranges`` per task.
    """
    columns = [named(c) for c in df.columns]
    folder = shared_folder(df.sparkSession, "numbered")
    df.repartitionByRange(*order).sortWithinPartitions(*order).selectExpr(
        *columns,
        "spark_partition_id() AS __range",
        "monotonically_increasing_id() & 8589934591L AS __row",
    ).write.parquet(folder)
    rows = df.sparkSession.read.parquet(folder)
    ranges = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).selectExpr(
        "__range", "sum(__n) OVER (ORDER BY __range) - __n AS __begin"
    )
    return rows, ranges


def _slice(df: DataFrame, order: str | list[str], begin: int, n: int) -> DataFrame:
    rows, ranges = _numbered(df, [order] if isinstance(order, str) else list(order))
    placed = rows.join(ranges, "__range").filter(f"__begin + __row >= {begin} AND __begin + __row < {begin + n}")
    return placed.select(*[F.col(named(c)) for c in df.columns])


def first_rows(
    df: DataFrame, order: str | list[str], n: int | None, few: int = FEW_ROWS
) -> DataFrame:
    """The first ``n`` rows by ``order``; ``None`` keeps all rows.

    Up to ``few`` rows are kept by each task and merged by one. More are cut from a table written in
    ranges of the order, so no task has more than its range. Both give the same rows if the order has no ties.
    """
    if n is None:
        return df
    return df.orderBy(order).limit(n) if n <= few else _slice(df, order, 0, n)


def row_at(df: DataFrame, order: str | list[str], k: int, few: int = FEW_ROWS) -> DataFrame:
    """The row at 0-based position ``k`` by ``order``; beyond ``few``, from the range that holds it."""
    return df.orderBy(order).offset(k).limit(1) if k < few else _slice(df, order, k, 1)


def any_contains(df: DataFrame, pattern: str, regex: bool = True) -> Column:
    """Predicate: some column, as text, contains the pattern (case-sensitive).

    With ``regex=False`` the pattern is plain text, which is cheaper to search.
    """
    texts = [F.coalesce(F.col(named(c)).cast("string"), F.lit("")) for c in df.columns]
    return reduce(
        or_, [t.rlike(pattern) if regex else F.contains(t, F.lit(pattern)) for t in texts]
    )
