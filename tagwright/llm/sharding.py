"""Sharding by histogram sort: probe key boundaries, count exact bytes below them, exchange once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import n_bytes, stored, text_or_empty

SHARDS = 40
ROW_BYTES = 16
PROBES = 63
TOLERANCE = 0.002
#: Groups of equal texts up to this share of a shard are never cut.
WHOLE = 0.25

_TOP = 1 << 64


def _below(rows: DataFrame, column: str, probes: list[int]) -> list[int]:
    """For each probe, the exact bytes of the rows whose unsigned key is below it.

    Every task sums its own rows by interval; what is shuffled and returned is one number per probe.
    """
    edges = np.array(sorted(set(probes)), np.uint64)

    def work(batches):
        sums = np.zeros(len(edges) + 1, np.int64)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            sizes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            # An interval starts at its probe; bincount of float weights would round.
            at = np.searchsorted(edges, keys, side="right")
            np.add.at(sums, at, sizes)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], ["at", "bytes"])

    found = (
        rows.select(column, "size").mapInArrow(work, "at long, bytes long").groupBy("at").agg(F.sum("bytes")).collect()
    )
    sums = np.zeros(len(edges) + 1, np.int64)
    for at, total in found:
        sums[at] = total
    upto = dict(zip(edges.tolist(), np.cumsum(sums)[:-1].tolist()))
    return [upto[p] for p in probes]


def boundaries(
    rows: DataFrame, column: str, total: int, goals: list[int], near: float
) -> list[tuple[int, int, int, int]]:
    """For each goal in bytes: a bracket (low, high, bytes below low, bytes below high) of keys.

    All brackets start as the whole key space. Each round probes every open bracket at ``PROBES``
    inner keys and keeps the interval around the goal. A bracket is closed when either of its ends is within
    ``near`` bytes of the goal, or when it holds a single key. Keys have 64 bits, so eleven rounds
    are the most; hashed keys take two or three.
    """
    found = [(0, _TOP, 0, total)] * len(goals)

    def closed(bracket, goal):
        low, high, before, after = bracket
        return high - low <= 1 or min(abs(before - goal), abs(after - goal)) <= near

    while True:
        probes = {}
        for i, goal in enumerate(goals):
            if not closed(found[i], goal):
                low, high = found[i][:2]
                probes[i] = sorted({low + (high - low) * k // (PROBES + 1) for k in range(1, PROBES + 1)} - {low})
        if not probes:
            return found
        every = sorted({p for ps in probes.values() for p in ps})
        upto = dict(zip(every, _below(rows, column, every)))
        for i, ps in probes.items():
            low, high, before, after = found[i]
            for p in ps:
                if upto[p] <= goals[i]:
                    low, before = p, upto[p]
                else:
                    high, after = p, upto[p]
                    break
            found[i] = (low, high, before, after)


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE, whole: float = WHOLE) -> list[tuple[int, int]]:
    """Cuts (key, second key): a row is in the shard of the number of cuts at or before it."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    mean = total / shards
    near = tolerance * mean
    goals = [total * j // shards for j in range(1, shards)]
    cuts: list[tuple[int, int] | None] = []
    inside: dict[int, list[tuple[int, int, int]]] = {}
    for j, (low, high, before, after) in enumerate(boundaries(rows, "k1", total, goals, near)):
        goal = goals[j]
        better = low if goal - before <= after - goal else high
        if high - low <= 1 and after - before > whole * mean and min(goal - before, after - goal) > near:
            inside.setdefault(low, []).append((j, goal - before, after - before))
            cuts.append(None)
        else:
            cuts.append((better, 0))
    for key, wanted in inside.items():
        signed = key - _TOP if key >> 63 else key
        group = rows.filter(F.col("k1") == signed)
        brackets = boundaries(group, "k2", wanted[0][2], [goal for _, goal, _ in wanted], near)
        for (j, goal, _), (low, high, before, after) in zip(wanted, brackets):
            second = low if goal - before <= after - goal else high
            cuts[j] = (key + 1, 0) if second >= _TOP else (key, second)
    return sorted(cuts)


def _unsigned(x: int) -> str:
    """SQL literal of an unsigned key, moved so that signed order is unsigned order."""
    moved = x - (1 << 63)
    return f"CAST({moved} AS bigint)" if moved < (1 << 63) else "NULL"


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``bytes``: shards have nearly the same sum of sizes (UTF-8 bytes and 16). Rows are
    ordered by a hash of the text, so equal texts lie together; a group of them is cut, by a hash of doc_id, only where it is
    larger than a quarter of a shard. ``slot`` counts from 0 in each shard without gaps. Null
    texts have size 16 and the checksum of the empty text. Repeated rows have the same keys and are not
    cut apart. Other columns are ignored; an empty table gives no rows.
    """
    text = text_or_empty()
    rows = stored(
        docs.select(
            "doc_id",
            (n_bytes(text) + ROW_BYTES).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64("doc_id", text).alias("k2"),
        ),
        "keys",
    )
    cuts = splitters(rows, shards, tolerance)
    moved = "({} ^ {})"
    least = f"{-(1 << 63) + 1}L - 1L"
    a, b = moved.format("k1", f"({least})"), moved.format("k2", f"({least})")
    tests = [
        f"IF({a} > {_unsigned(x)} OR ({a} = {_unsigned(x)} AND {b} >= {_unsigned(y)}), 1, 0)"
        for x, y in cuts
        if x < _TOP
    ]
    placed = rows.withColumns({"a": F.expr(a), "b": F.expr(b)}).withColumn(
        "shard", F.expr(" + ".join(tests) if tests else "0")
    )
    # The one exchange. Ranges of (shard, key) are sorted and numbered where they land.
    numbered = stored(
        placed.repartitionByRange("shard", "a", "b")
        .sortWithinPartitions("shard", "a", "b", "doc_id")
        .selectExpr(
            "doc_id", "size", "text_crc32", "shard", "spark_partition_id() AS part",
            "monotonically_increasing_id() & 8589934591L AS at",
        ),
        "exchanged",
    )
    # One row per partition and shard in it.
    starts = (
        numbered.groupBy("shard", "part")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .selectExpr("shard", "part", "sum(n) OVER (PARTITION BY shard ORDER BY part) - n - first AS shift")
    )
    return numbered.join(starts, ["shard", "part"]).selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' AS law", "CAST(shard AS int) AS shard",
        "at + shift AS slot", "CAST(NULL AS int) AS grown_shard",
    )
