"""Joins and ordered groups that survive one key holding much of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import named
from tagwright.sources.shared import shared_folder

HOT_ROWS = 5_000_000

_MARK, _SLICE, _CONTEXT, _AT, _ROW = "__mark", "__slice", "__context", "__at", "__row"


def spread_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str
) -> DataFrame:
    """Equi-join with one row per key on the right, in which hot left keys can be split.

    Adaptive execution splits a hot partition only if both sides of the join come
    straight from a shuffle. A side that was just made distinct does not: Spark
    sees that it is partitioned by the key already and leaves the shuffle out.
    Joining on the key and its hash makes Spark shuffle the distinct keys once
    more, which is cheap, and the left side once, as it would have to anyway. A
    small right side is broadcast as usual.
    """
    keys = [on] if isinstance(on, str) else list(on)
    mark = f"xxhash64({_list(keys)}) AS {_MARK}"
    joined = left.selectExpr("*", mark).join(right.selectExpr("*", mark), [*keys, _MARK], how)
    return joined.drop(_MARK)


def _same(keys: Sequence[str], prefix: str) -> str:
    return " AND ".join(f"{named(k)} <=> {named(prefix + k)}" for k in keys)


def _list(columns: Sequence[str], suffix: str = "") -> str:
    return ", ".join(named(c) + suffix for c in columns)


def _cut(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, folder: str
) -> DataFrame:
    """Write the rows in ``n`` ranges of (keys, order) and return them with ``__slice`` and ``__row``.

    ``__row`` numbers all rows in that order. Rows equal in all those columns are
    told apart by the input partition they come from, so that even copies are
    spread. Range bounds are sampled; once written, the cut is fixed for every
    later use and retry.
    """
    columns = [named(c) for c in df.columns]
    ranged = df.selectExpr("*", "spark_partition_id() AS __tie").repartitionByRange(
        n, *keys, *order, "__tie"
    )
    ranged.sortWithinPartitions(*keys, *order).selectExpr(
        *columns, f"monotonically_increasing_id() AS {_ROW}", f"spark_partition_id() + 1 AS {_SLICE}"
    ).write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _edge_rows(hot: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows before each slice, labelled with that slice and with their position."""
    backwards = f"OVER (PARTITION BY {_list(keys)}, {_SLICE} ORDER BY {_ROW} DESC)"
    last = hot.selectExpr("*", f"row_number() {backwards} AS __back").filter(f"__back <= {n}")
    upto = (
        hot.groupBy(*keys, _SLICE)
        .agg(F.expr("count(*) AS __rows"))
        .selectExpr(
            *[f"{named(k)} AS {named('__end_' + k)}" for k in keys],
            f"{_SLICE} AS __end",
            f"sum(__rows) OVER (PARTITION BY {_list(keys)} ORDER BY {_SLICE}) AS __upto",
        )
    )
    placed = last.join(upto, F.expr(f"{_same(keys, '__end_')} AND {_SLICE} = __end"))
    columns = [c for c in hot.columns if c != _SLICE]
    row = f"struct({_list(columns)}, __upto - __back AS {_AT})"
    along = f"OVER (PARTITION BY {_list(keys)} ORDER BY {_ROW})"
    earlier = ", ".join(f"lag({row}, {i}) {along}" for i in range(1, n + 1))
    return (
        placed.selectExpr(
            _SLICE,
            f"lag({_SLICE}) {along} AS __before",
            f"array_compact(array({earlier})) AS __rows",
        )
        .filter(f"__before <> {_SLICE}")
        .selectExpr(_SLICE, "inline(__rows)")
    )


class Ordered:
    """Rows of each key in order, cut so that no task has to take a whole hot key.

    A key with more than ``hot_rows`` rows is hot. One pre-aggregated count,
    which runs at once, tells whether there are any; mostly there are none, and
    the rows stay as they are. Who knows that none is hot passes ``None``, and nothing is counted. The rows of hot keys are written in ranges of
    about ``hot_rows`` rows, and each range becomes a slice of its own.

    ``over`` is the SQL window of one slice. Every slice but the first of a key
    starts with the last ``context`` rows before it, so ``lag`` up to that
    distance and ``position`` are the same as over the whole key. Finish with
    ``own_rows``. ``df`` is read more than once: pass a table, or what is cheap
    to compute from one.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        context: int = 1,
        hot_rows: int | None = HOT_ROWS,
    ):
        self.group = [*keys, _SLICE]
        # Without hot keys there is one slice, so lists may be grouped as the rows already lie.
        self.list_group = self.group
        folder = shared_folder(df.sparkSession, "ordered")
        total = hot_rows and self._count(df, keys, hot_rows, f"{folder}/keys")
        if not total:
            self.rows = df.selectExpr("*", f"0 AS {_SLICE}", f"false AS {_CONTEXT}")
            self.over = f"OVER (PARTITION BY {_list(self.group)} ORDER BY {_list(order)})"
            self.position = f"CAST(row_number() {self.over} AS BIGINT) - 1"
            return

        self.list_group = list(keys)
        # At most rows / hot_rows keys; Spark broadcasts them if they are small.
        hot_keys = df.sparkSession.read.parquet(f"{folder}/keys").drop("__n")
        is_hot = F.expr(_same(keys, "__hot_"))
        cold = df.join(hot_keys, is_hot, "left_anti")
        pieces = -(-total // hot_rows)
        hot = _cut(df.join(hot_keys, is_hot, "left_semi"), keys, order, pieces, f"{folder}/rows")
        unplaced = f"CAST(NULL AS BIGINT) AS {_AT}"
        columns = [named(c) for c in df.columns]
        parts = [
            cold.selectExpr(
                *columns, f"CAST(NULL AS BIGINT) AS {_ROW}", f"0 AS {_SLICE}", unplaced, f"false AS {_CONTEXT}"
            ),
            hot.selectExpr(*columns, _ROW, _SLICE, unplaced, f"false AS {_CONTEXT}"),
            _edge_rows(hot, keys, context).selectExpr(*columns, _ROW, _SLICE, _AT, f"true AS {_CONTEXT}"),
        ]
        self.rows = parts[0].union(parts[1]).union(parts[2])
        within = f"PARTITION BY {_list(self.group)} ORDER BY {_ROW}, {_list(order)}"
        self.over = f"OVER ({within})"
        start = f"first({_AT}) OVER ({within} ROWS UNBOUNDED PRECEDING)"
        self.position = f"coalesce({start}, 0) + row_number() {self.over} - 1"

    @staticmethod
    def _count(df: DataFrame, keys: Sequence[str], hot_rows: int, path: str) -> int:
        """Write the hot keys as ``__hot_…`` with their counts, and return the sum of these."""
        df.groupBy(*keys).agg(F.expr("count(*) AS __n")).filter(f"__n > {hot_rows}").selectExpr(
            *[f"{named(k)} AS {named('__hot_' + k)}" for k in keys], "__n"
        ).write.parquet(path)
        return df.sparkSession.read.parquet(path).agg(F.sum("__n")).first()[0] or 0

    @staticmethod
    def own_rows(df: DataFrame) -> DataFrame:
        return df.filter(f"NOT {_CONTEXT}").drop(_CONTEXT, _AT, _ROW)


def bounded_lists(
    df: DataFrame, group: Sequence[str], position: str, size: int, lists: dict[str, str]
) -> DataFrame:
    """Lists of SQL expressions in position order, at most ``size`` elements each.

    ``group`` is the ``list_group`` of an ``Ordered``. Element ``i`` of a key is in its piece
    ``i / size``, whether the key is hot or not: ``start``, the position of the first element, is a
    multiple of ``size``. Grouping needs a further shuffle only where there are hot keys.
    """
    elements = ", ".join(f"{e} AS {named(n)}" for n, e in lists.items())
    collected = f"array_sort(collect_list(struct({named(position)} AS at, {elements})))"
    return (
        df.selectExpr("*", f"floor({named(position)} / {size}) AS __piece")
        .groupBy(*group, "__piece")
        .agg(F.expr(f"min({named(position)}) AS start"), F.expr(f"{collected} AS __elements"))
        .selectExpr(
            *[named(g) for g in group if g != _SLICE],
            "start",
            *[f"__elements.{named(n)} AS {named(n)}" for n in lists],
        )
    )
