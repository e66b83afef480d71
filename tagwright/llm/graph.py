"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import stored
from tagwright.operators.skew import spread_join


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each node to its least neighbour."""
    both = edges.union(edges.select("v", "u")) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
    joined = spread_join(both, least, "u", "inner")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        joined.select("u", F.col("m").alias("v"))
    ).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node reachable, for every node of the edges (u, v).

    Each round is written, so nothing is recomputed and a lost executor costs one round. The
    number of rounds grows with the logarithm of the longest chain. Only counts reach the driver.
    """
    now = stored(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    mark = None
    while True:
        found = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
        now = stored(_stars(_stars(now, large=True), large=False), "stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()
