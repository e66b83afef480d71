"""Filter interaction audit: what each of several filters removes, in every order and on its own account.

A document's failures are a set of filters. For every coalition of filters Spark tabulates the documents that at
least one of them removes; with five filters these are 32 counts a part of the table. A filter's Shapley
value, its removals averaged over all orders, is the solution of least squares over the coalitions, weighted by
the Shapley kernel and constrained to add up to all removals. The normal equations do not depend
on the data: they are solved once in rationals, and the solution is applied to the counts in integers. What
a step of an order keeps and removes is the difference of two coalitions.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations, permutations
from math import comb, factorial, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import stored, text_or_empty
from tagwright.operators.skew import spread_join

#: Letter → SQL that says when a ``text`` with its array of ``words`` fails.
CONDITIONS = {
    "A": "size(words) < 100",
    "B": "100 * size(array_distinct(words)) < 80 * size(words)",
    "C": "100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(text)",
    "D": "text RLIKE '[#$%&*|]'",
}
DUPLICATES = "E"


def _solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """Rows of X with matrix · X = right, by Gauss-Jordan elimination in rationals."""
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    n = len(rows)
    for i in range(n):
        pivot = next(k for k in range(i, n) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [r[n:] for r in rows]


def shapley_weights(n: int) -> list[list[Fraction]]:
    """For each of ``n`` filters the weight of every coalition's removals (by bit mask) in its Shapley value.

    Minimises the sum over proper coalitions S of kernel(S) · (removed(S) - sum of the values in S)², subject to all
    values adding up to removed(all): the normal equations with one multiplier, solved for every
    coalition as right-hand side.
    """
    everything = (1 << n) - 1
    kernel = [Fraction(0)] * (everything + 1)
    for k in range(1, n):
        for members in combinations(range(n), k):
            kernel[sum(1 << i for i in members)] = Fraction(n - 1, comb(n, k) * k * (n - k))
    both = [
        [sum((w for s, w in enumerate(kernel) if s >> i & s >> j & 1), Fraction(0)) for j in range(n)] for i in range(n)
    ]
    matrix = [[*row, Fraction(1)] for row in both] + [[Fraction(1)] * n + [Fraction(0)]]
    right = [[w if s >> i & 1 else Fraction(0) for s, w in enumerate(kernel)] for i in range(n)]
    right.append([Fraction(int(s == everything)) for s in range(everything + 1)])
    return _solve(matrix, right)[:n]


def failures(
    docs: DataFrame, labels: DataFrame, conditions: dict[str, str] = CONDITIONS, duplicates: str = DUPLICATES
) -> DataFrame:
    """Per row: ``doc_id``, ``part``, ``mask``, ``good``, ``toxic``; bit k of the mask is the k-th filter.

    Filters are those of ``conditions`` and then ``duplicates``: whether a smaller doc_id has the same text, told by
    SHA-256 and length. Whole texts are read once and not shuffled. A row without doc_id fails by no copy and
    makes none fail.
    """
    words = F.expr(r"array_remove(split(text, '[\\x20\\x09-\\x0D]+'), '')")
    bits = " + ".join(f"IF({sql}, {1 << k}, 0)" for k, sql in enumerate(conditions.values()))
    narrow = stored(
        docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text_or_empty().alias("text"))
        .withColumn("words", words)
        .selectExpr("doc_id", "part", "unhex(sha2(text, 256)) AS digest", "octet_length(text) AS n_bytes", f"{bits} AS mask"),
        "failures",
    )
    copies = (
        narrow.filter("doc_id IS NOT NULL")
        .groupBy("digest", "n_bytes")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most")
    )
    known = labels.groupBy("doc_id").agg(
        F.max(F.expr("IF(quality = 1, 1, 0)")).alias("good"), F.max(F.expr("IF(toxic = 1, 1, 0)")).alias("toxic")
    )
    own = 1 << len(conditions)
    flagged = spread_join(narrow, copies, ["digest", "n_bytes"], "left").selectExpr(
        "doc_id", "part", f"mask + IF(doc_id > least, {own}, 0) AS mask"
    )
    return spread_join(flagged, known, "doc_id", "left").selectExpr(
        "doc_id", "part", "mask", "coalesce(good, 0) AS good", "coalesce(toxic, 0) AS toxic"
    )


def coalitions(failed: DataFrame, n: int) -> DataFrame:
    """Per ``part``: ``total`` and, by coalition, ``removed``, ``good`` and ``toxic`` documents as arrays of 2ⁿ.

    Rows are counted by part and mask first, within tasks and then over them, so no part is gathered.
    """
    masks = failed.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    each = masks.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
    hit = "IF(mask & coalition <> 0, {}, 0)"
    sums = each.groupBy("part", "coalition").agg(
        F.sum("n").alias("total"), *[F.sum(F.expr(hit.format(c))).alias(to) for c, to in (("n", "removed"), ("good", "good"), ("toxic", "toxic"))]
    )
    listed = F.sort_array(F.collect_list(F.struct("coalition", "removed", "good", "toxic")))
    return (
        sums.groupBy("part")
        .agg(F.max("total").alias("total"), listed.alias("s"))
        .selectExpr("part", "total", "s.removed AS removed", "s.good AS good", "s.toxic AS toxic")
    )


def audit(
    docs: DataFrame, labels: DataFrame, conditions: dict[str, str] = CONDITIONS, duplicates: str = DUPLICATES
) -> DataFrame:
    """One row per part, order of the filters and step; counts are of documents within the part.

    Columns: ``part`` (lang; null: empty), ``filter_order``, ``step`` from 1, ``kept`` after it, ``removed`` by it,
    ``redundant`` (failing its filter, removed before), ``unique_fails`` (failing its filter only), ``good_lost``,
    ``toxic_lost`` and ``shapley``: what the step's filter removes, summed over all orders. Null texts are empty.
    Repeated rows count each; rows of one doc_id are no copies of each other. A doc_id with several labels is good
    (toxic) if one of them says so. Other columns are ignored; an empty table gives no rows.
    """
    letters = [*conditions, duplicates]
    n, everything = len(letters), (1 << len(letters)) - 1
    weights = [[factorial(n) * w for w in row] for row in shapley_weights(n)]
    unit = lcm(*(w.denominator for row in weights for w in row))
    summed = ", ".join(
        "(" + " + ".join(f"{int(w * unit)}L * removed[{s}]" for s, w in enumerate(row) if w) + f") div {unit}"
        for row in weights
    )
    orders = ",".join(map("".join, permutations(letters)))
    before, after = (
        " + ".join(f"IF(instr(filter_order, '{x}') {sign} step, {1 << k}, 0)" for k, x in enumerate(letters))
        for sign in ("<", "<=")
    )
    steps = (
        coalitions(failures(docs, labels, conditions, duplicates), n)
        .selectExpr("*", f"array({summed}) AS values")
        .selectExpr("*", f"explode(split('{orders}', ',')) AS filter_order")
        .selectExpr("*", f"explode(sequence(1, {n})) AS step")
        .selectExpr(
            "*", f"{before} AS b", f"{after} AS a", f"instr('{''.join(letters)}', substr(filter_order, step, 1)) - 1 AS f"
        )
    )
    return steps.selectExpr(
        "part",
        "filter_order",
        "step",
        "total - removed[a] AS kept",
        "removed[a] - removed[b] AS removed",
        "removed[a - b] - (removed[a] - removed[b]) AS redundant",
        f"removed[{everything}] - removed[{everything} - (a - b)] AS unique_fails",
        "good[a] - good[b] AS good_lost",
        "toxic[a] - toxic[b] AS toxic_lost",
        "values[f] AS shapley",
    )
