"""Kinematics of series that grow: new steps only, from the last two steps of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwright.functions.text import named
from tagwright.operators.matching import written
from tagwright.operators.skew import HOT_ROWS, spread_join
from tagwright.operators.trajectory import STEP_SECONDS, kinematics

BATCH = "__batch"


def _last_two(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key its last steps, at most two; kept as greatest structs, so a hot key is two steps per task."""
    step = F.struct(*order, *[c for c in rows.columns if c not in (*keys, *order, "__n")])
    top = rows.groupBy(*keys).agg(F.max_by(step, F.struct(*order)).alias("__one"), F.sum("__n").alias("__n"))
    rest = spread_join(rows.select(*keys, step.alias("__step")), top.drop("__n"), list(keys), "inner").filter("__step <> __one")
    second = rest.groupBy(*keys).agg(F.max("__step").alias("__two"))
    both = spread_join(top, second, list(keys), "left")
    return both.selectExpr(*map(named, keys), "__n", "inline(array_compact(array(__two, __one)))")


def add_batch(
    new: DataFrame,
    batch: int,
    target: str,
    keys: Sequence[str],
    order: Sequence[str],
    axes: Sequence[str],
    dt: float = STEP_SECONDS,
    hot_rows: int | None = HOT_ROWS,
) -> None:
    """Write the steps of one batch: ``series`` as ``kinematics`` would give them, ``late`` ones, and the new ``state``.

    Keys must not be null, and an order may not repeat within a key. State is the last two steps of every key and how many it had; batch ``b`` reads that of ``b - 1`` and writes its own, so
    a batch that runs twice replaces what it wrote. Steps not after the last one of their key are late: they
    are kept aside and change nothing.
    """
    spark = new.sparkSession
    columns = [*dict.fromkeys([*keys, *order, *axes])]
    new = written(new.select(*columns), "new")
    if batch:
        former = spark.read.parquet(f"{target}/state/{BATCH}={batch - 1}")
    else:
        former = new.limit(0).withColumn("__n", F.lit(0).cast("long"))
    at = F.struct(*order)
    known = former.groupBy(*keys).agg(F.max(at).alias("__last"), F.count(F.lit(1)).alias("__context"), F.max("__n").alias("__seen"))
    placed = spread_join(new, known, list(keys), "left")
    is_late = "__last IS NOT NULL AND struct({}) <= __last".format(", ".join(map(named, order)))
    placed.filter(is_late).select(*columns).write.mode("overwrite").parquet(f"{target}/late/{BATCH}={batch}")
    fresh = written(placed.filter(f"NOT ({is_late})").select(*columns), "fresh")
    touched = fresh.select(*keys).distinct()
    context = spread_join(former.select(*columns), touched, list(keys), "left_semi")
    series = kinematics(context.unionByName(fresh), keys, list(order), axes, dt, hot_rows)
    counted = spread_join(series, known.drop("__last"), list(keys), "left")
    counted.filter("position >= coalesce(__context, 0)").withColumn(
        "position", F.expr("position - coalesce(__context, 0) + coalesce(__seen, 0)")
    ).drop("__context", "__seen").write.mode("overwrite").parquet(f"{target}/series/{BATCH}={batch}")
    grown = _with_counts(former, keys, order).unionByName(fresh.withColumn("__n", F.lit(1).cast("long")))
    _last_two(grown, keys, order).write.mode("overwrite").parquet(f"{target}/state/{BATCH}={batch}")


def _with_counts(former: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """State rows of which the last one of a key carries its number of steps, and the other none."""
    last = former.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__last"))
    at = f"struct({', '.join(map(named, order))})"
    return spread_join(former, last, list(keys), "inner").withColumn("__n", F.expr(f"IF({at} = __last, __n, 0L)")).drop("__last")


def add_new_files(
    spark: SparkSession,
    source: str,
    schema: str | T.StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    axes: Sequence[str],
    dt: float = STEP_SECONDS,
    max_files: int | None = None,
    timeout: float | None = None,
) -> bool:
    """``add_batch`` of every file of ``source`` not yet seen, in order of arrival. False if ``timeout`` seconds passed first."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def one(df: DataFrame, batch: int) -> None:
        add_batch(df, batch, target, keys, order, axes, dt)

    query = (
        reader.parquet(source).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    try:
        return query.awaitTermination(timeout) is not False
    finally:
        query.stop()


def series(spark: SparkSession, target: str) -> DataFrame:
    """The steps of all batches so far."""
    return spark.read.parquet(f"{target}/series").drop(BATCH)
