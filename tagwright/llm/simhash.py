"""SimHash near-dedup: an inverted index over byte positions, with count filtering.

Two 64-bit fingerprints that differ in at most 2 bits agree in at least 6 of their 8 bytes. A posting of a single byte
would hold a 256th of all fingerprints, so postings are of four byte positions at a time: the 14 blocks of
the Steiner system S(3, 4, 8). Any three positions are in exactly one block; so fingerprints that share 6, 7 or 8 bytes
share 3, 7 or 14 postings, and those that share 5 or fewer share one at most. The tally of shared postings of
a pair thus tells exactly whether it reaches the guaranteed 6 bytes; pairs that do are verified by their bits.
Members of a large posting are posted again under 6 positions. No pair is missed, whatever the data.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import as_bytes, per_batch, stored
from tagwright.llm.graph import components
from tagwright.operators.skew import spread_join

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Larger postings are not paired but refined.
PAIRED = 64

_BYTES = [0xFF << 8 * i for i in range(8)]
#: Four positions are a block if their numbers cancel out under exclusive or.
_BLOCKS = [b for b in combinations(range(8), 4) if b[0] ^ b[1] ^ b[2] ^ b[3] == 0]
_SIXES = list(combinations(range(8), 6))
#: Least number of common blocks of fingerprints with 6 common bytes.
_COMMON = 3

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, bit 0 first."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        piece = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.int32)
    return counts


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased word shingles, repeats included; no word gives zero."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], np.uint64)
    on = 2 * bit_counts(hashes) > len(hashes)
    return int(np.packbits(on, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, for every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(t) for t in as_bytes(batch.column(1))]
        column = pa.array(np.array(prints, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), column], ["doc_id", "fp"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(per_batch(work), f"doc_id {kind}, fp long")


def _mask(positions: tuple[int, ...]) -> int:
    return sum(_BYTES[i] for i in positions)


def _postings(prints: DataFrame, sets: list[tuple[int, ...]], name: str) -> DataFrame:
    """``(fp, slot, key, n)``: the bytes of each set of positions, where ``n`` fingerprints, at least two, have the same."""
    entries = ", ".join(f"struct({i} AS slot, fp & {_signed(_mask(p))}L AS key)" for i, p in enumerate(sets))
    each = prints.selectExpr("fp", f"inline(array({entries}))")
    sizes = each.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return stored(spread_join(each, sizes, ["slot", "key"], "inner"), name)


def _pairs(members: DataFrame, paired: int) -> DataFrame:
    """The pairs ``u > v`` of postings with at most ``paired`` members, once for each posting they share."""
    few = members.filter(f"n <= {paired}").select("slot", "key", "fp")
    return (
        few.withColumnRenamed("fp", "v").join(few.withColumnRenamed("fp", "u"), ["slot", "key"]).filter("v < u").select("u", "v")
    )


def links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp`` that connect all within 2 bits.

    A posting with up to ``paired`` members emits its pairs; a pair is kept if its tally of postings reaches that of 6
    common bytes. Members of larger postings, where tallies would be incomplete, are posted again under each 6 positions; a pair
    of such a posting has 6 common bytes. Where even those are large, members differ in 16 bits only and meet
    at every value within one bit of theirs: two share such a value exactly if they differ in at most 2 bits, at
    most 17 share one, and each links to the least there.
    """
    blocks = _postings(prints, _BLOCKS, "postings")
    tallied = _pairs(blocks, paired).groupBy("u", "v").agg(F.count(F.lit(1)).alias("common")).filter(f"common >= {_COMMON}")
    pairs = tallied.select("u", "v")

    crowded = blocks.filter(f"n > {paired}").select("fp").distinct()
    sixes = _postings(crowded, _SIXES, "refined")
    pairs = pairs.union(_pairs(sixes, paired).distinct())

    rest = "CASE slot " + " ".join(f"WHEN {i} THEN {_signed(~_mask(p) & (1 << 64) - 1)}L" for i, p in enumerate(_SIXES)) + " END"
    flips = F.expr("array_append(transform(sequence(0, 63), i -> shiftleft(1L, i)), 0L)")
    meets = (
        sixes.filter(f"n > {paired}")
        .select("slot", "fp", F.expr(rest).alias("__rest"), F.explode(flips).alias("__flip"))
        .filter("(__flip & __rest) = __flip")
        .select("slot", "fp", F.expr("fp ^ __flip").alias("at"))
    )
    least = meets.groupBy("slot", "at").agg(F.min("fp").alias("v"))
    stars = meets.join(least, ["slot", "at"]).filter("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.union(stars).filter(F.expr(f"bit_count(u ^ v) <= {MAX_BITS}")).distinct()


def near_groups(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` in hex, ``component_id``.

    ``component_id`` is the smallest doc_id reachable over links of at most 2 differing bits, the
    row's own included; rows without a doc_id never name a component that has one. Null and
    empty texts have fingerprint zero and link like any other. Equal fingerprints are one node,
    so copies cost nothing. Other columns are ignored; an empty table gives no rows.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp")))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = spread_join(placed.select("fp", "root"), named, "root", "inner").select("fp", "component_id")
    return spread_join(rows, classes, "fp", "inner").select(
        "doc_id",
        F.expr("lower(lpad(hex(fp), 16, '0'))").alias("fingerprint"),
        "component_id",
    )


def first_of_groups(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One row of each component, that of the smallest doc_id, with all columns.

    ``groups`` has doc_id and component_id of every row, by default those of ``near_groups``.
    Rows without a doc_id stay, as no component can name them. Repeated rows of that doc_id stay all.
    """
    groups = stored(near_groups(docs) if groups is None else groups, "near_groups")
    gone = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    still = groups.filter("doc_id = component_id").select("doc_id").distinct()
    drop = gone.join(still, "doc_id", "left_anti")
    return docs.join(drop, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
