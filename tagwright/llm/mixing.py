"""Mixing sources to target weights by entropy balancing.

Of all document rates between 0 and ``most`` copies, those nearest to an even choice in relative
entropy that give every source its target number of words are ``most`` times the logistic of (lambda x
size): the exponentially tilted ones. Each source's lambda solves a convex dual in one unknown, by Newton steps over
the histogram of sizes, which Spark aggregates; the rates are then rounded into copies.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import WORD, stored
from tagwright.operators.skew import spread_join

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
STEPS = 60
TOLERANCE = 1e-6
BUCKET_ROWS = 1000


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words (null: 0), and a hash that orders equal sizes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64("doc_id", text).alias("h"),
    )


def targets(
    histogram: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Per source: ``source_size`` and ``target``.

    Sources in code-point order, null last, get the weights in turn. They share ``share`` of all words by
    weight; a target stops at ``most`` times its source, and the rest is shared by the others until
    none is above. One row per source; only three sums of them reach the driver in each round.
    """
    kinds = ", ".join(f"{w}D" for w in weights)
    ranked = stored(
        histogram.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
        .selectExpr("*", "row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place")
        .selectExpr(
            "source", "source_size", "n", f"element_at(array({kinds}), int(place % {len(weights)}) + 1) AS weight"
        ),
        "sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        # Above the level that all would share, a source is full.
        full = f"source_size * {most} <= weight * {level!r}D"
        fixed, open_weight = ranked.agg(
            F.expr(f"coalesce(sum(IF({full}, source_size * {most}, 0)), 0)"),
            F.expr(f"coalesce(sum(IF({full}, 0D, weight)), 0D)"),
        ).first()
        if not open_weight:
            break
        after = max(0.0, share * total - fixed) / open_weight
        if after <= level * (1 + 1e-12):
            break
        level = after
    return ranked.select(
        "source",
        "source_size",
        "n",
        F.expr(f"least(source_size * {float(most)}D, weight * {level!r}D)").alias("target"),
    )


def tilts(histogram: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """Per source: the multiplier ``tilt`` of its size over the mean size.

    The dual of a source is convex and its slope, the words taken less the target, rises with the
    tilt. Newton steps from zero are kept inside the bracket that the slopes seen so far leave, and halve it where they
    would leave it. Sources still open after ``STEPS`` steps are reported by a warning; their last tilt holds. Targets at the upper end have tilt infinity: every document in full.
    """
    at_end = f"target >= source_size * {float(most)}D * (1 - 1e-12)"
    state = stored(
        goals.selectExpr(
            "source",
            "target",
            "source_size",
            "greatest(source_size / n, 1D) AS scale",
            f"CASE WHEN {at_end} THEN double('inf') ELSE 0D END AS tilt",
            "CAST(NULL AS double) AS low",
            "CAST(NULL AS double) AS high",
            f"{at_end} AS done",
        ),
        "tilts",
    )
    cells = histogram.filter("size > 0").withColumnRenamed("source", "__source")
    for _ in range(STEPS):
        if not state.filter("NOT done").limit(1).count():
            break
        open_state = state.filter("NOT done").select("source", "tilt", "scale")
        slope = (
            cells.join(open_state, F.expr("__source <=> source"))
            .withColumn("r", F.expr("1 / (1 + exp(-tilt * size / scale))"))
            .groupBy("source")
            .agg(
                F.expr(f"sum({most} * r * size * n)").alias("taken"),
                F.expr(f"sum({most} * r * (1 - r) * size * n * size / scale)").alias("curve"),
            )
            .withColumnRenamed("source", "__source")
        )
        after = (
            state.join(slope, F.expr("__source <=> source"), "left")
            .withColumn("err", F.expr("taken - target"))
            .withColumn("ok", F.expr(f"done OR err IS NULL OR abs(err) <= {TOLERANCE} * greatest(target, 1D)"))
            .withColumn("low", F.expr("IF(err < 0, tilt, low)"))
            .withColumn("high", F.expr("IF(err > 0, tilt, high)"))
            .withColumn("step", F.expr("IF(curve > 0, tilt - err / curve, NULL)"))
            .withColumn("lo", F.expr("coalesce(low, least(2 * coalesce(high, 0D), -1D) * 8)"))
            .withColumn("hi", F.expr("coalesce(high, greatest(2 * coalesce(low, 0D), 1D) * 8)"))
            .selectExpr(
                "source",
                "target",
                "source_size",
                "scale",
                "CASE WHEN ok THEN tilt WHEN step > lo AND step < hi THEN step ELSE (lo + hi) / 2 END AS tilt",
                "low",
                "high",
                "ok AS done",
            )
        )
        state = stored(after, "tilts")
    else:
        still = state.filter("NOT done").count()
        if still:
            warnings.warn(f"{still} sources are not within {TOLERANCE} of their targets after {STEPS} steps", stacklevel=2)
    return state


def _nearer(sizes: np.ndarray, copies: np.ndarray, full: np.ndarray, due: float) -> np.ndarray:
    """Move single copies between sizes while that brings the words taken nearer to what is due.

    Each step adds a copy of one size, drops one of another, or both, whichever leaves least due. Sizes descend.
    """
    for _ in range(50):
        up, down = np.flatnonzero(copies < full), np.flatnonzero(copies > 0)
        options = []
        rising = sizes[up][::-1]
        for drop in [None, *down[np.argsort(-sizes[down], kind="stable")]]:
            have = due + (0 if drop is None else sizes[drop])
            if drop is not None:
                options.append((abs(have), None, drop))
            at = np.searchsorted(rising, have)
            for k in (at - 1, at):
                if 0 <= k < len(rising):
                    add = up[len(up) - 1 - k]
                    if add != drop:
                        options.append((abs(have - sizes[add]), add, drop))
        best = min(options, key=lambda o: o[0], default=(abs(due), None, None))
        if best[0] >= abs(due) - 1e-9:
            break
        _, add, drop = best
        if add is not None:
            copies[add] += 1
            due -= sizes[add]
        if drop is not None:
            copies[drop] -= 1
            due += sizes[drop]
        if abs(due) <= 0.5:
            break
    return copies


def _rounded(rates: DataFrame, most: int) -> DataFrame:
    """Whole copies per (source, size), by carrying the error from larger to smaller sizes.

    One group holds the distinct sizes of one source, which the longest text bounds, not its rows.
    """

    def carry(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("size", ascending=False)
        due, copies = 0.0, []
        for size, n, rate in zip(cells["size"], cells["n"], cells["rate"]):
            due += size * n * rate
            k = min(max(round(due / size), 0), most * n)
            due -= k * size
            copies.append(k)
        sizes, full = cells["size"].to_numpy(), most * cells["n"].to_numpy()
        copies = _nearer(sizes, np.array(copies), full, due)
        return cells.assign(copies=copies)[["source", "size", "n", "copies"]]

    return rates.groupBy("source").applyInPandas(carry, "source string, size long, n long, copies long")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    with_hash: bool = False,
) -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``copies``.

    ``taken`` is ``size`` times ``copies``, which is 0 to ``most``. Rows of one source and
    size have the same rate; which of them get one copy more is decided by a hash of
    doc_id and text, so reruns agree. A null source is a source of its own; null and empty texts
    have size 0, one copy, and take no words. Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(sized(docs), "sizes")
    histogram = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    goals = stored(targets(histogram, weights, share, most), "targets")
    state = tilts(histogram, goals, most).withColumnRenamed("source", "__source")
    rates = histogram.filter("size > 0").join(state, F.expr("__source <=> source")).selectExpr(
        "source", "size", "n", f"{most} / (1 + exp(-tilt * size / scale)) AS rate"
    )
    cells = stored(
        _rounded(rates, most).selectExpr(
            "source AS c_source", "size AS c_size", "copies DIV n AS base", "copies % n AS extra", "n",
            f"greatest(n DIV {BUCKET_ROWS}, 1) AS buckets",
        ),
        "copies",
    )
    # Rows of a cell are ranked in buckets of about a thousand, whatever the size of the cell.
    key = "xxhash64(source, size, source IS NULL)"
    spread = spread_join(
        rows.selectExpr("*", f"{key} AS k", "source IS NULL AS no_source", "coalesce(source, '') AS s"),
        cells.selectExpr("c_size AS size", "c_source IS NULL AS no_source", "coalesce(c_source, '') AS s",
                         "base", "extra", "n", "buckets"),
        ["s", "no_source", "size"],
        "left",
    ).selectExpr("*", "pmod(h, buckets) AS bucket")
    counts = (
        spread.filter("extra > 0")
        .groupBy("s", "no_source", "size", "bucket")
        .agg(F.count(F.lit(1)).alias("here"), F.max("extra").alias("extra"), F.max("n").alias("n"))
        .selectExpr("*", "sum(here) OVER (PARTITION BY s, no_source, size ORDER BY bucket) AS upto")
        .selectExpr(
            "s", "no_source", "size", "bucket",
            "upto * extra DIV n - (upto - here) * extra DIV n AS lucky",
        )
    )
    chosen = spread_join(spread, counts, ["s", "no_source", "size", "bucket"], "left").selectExpr(
        "*",
        "row_number() OVER (PARTITION BY s, no_source, size, bucket ORDER BY h, doc_id) AS place",
    ).selectExpr(
        "doc_id", "source", "size", "h",
        "CASE WHEN size = 0 THEN 1L ELSE base + IF(lucky IS NOT NULL AND place <= lucky, 1L, 0L) END AS copies",
    )
    last = goals.selectExpr(
        "coalesce(source, '') AS s", "source IS NULL AS no_source", "source_size", "target"
    )
    return spread_join(
        chosen.selectExpr("*", "coalesce(source, '') AS s", "source IS NULL AS no_source"),
        last, ["s", "no_source"], "inner",
    ).selectExpr(
        "doc_id", "size", "CAST(source_size AS long) AS source_size", "CAST(target AS double) AS target",
        "size * copies AS taken", "CAST(copies AS int) AS copies", *["h"] * with_hash,
    )


def repeated(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it, with all their columns.

    Repeated rows (same doc_id and text) cannot be told apart; one of them stands for the copies of all.
    """
    copies = mix(docs, weights, share, most, with_hash=True).groupBy("doc_id", "h").agg(F.sum("copies").alias("copies"))
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*own).alias("row"), F.col("doc_id").alias("__id"), F.xxhash64("doc_id", text).alias("__h")
    ).dropDuplicates(["__id", "__h"])
    joined = rows.join(copies, F.expr("__id <=> doc_id AND __h = h"))
    return (
        joined.filter("copies > 0")
        .select("row", F.explode(F.expr("sequence(1L, copies)")).alias("__copy"))
        .select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    )
