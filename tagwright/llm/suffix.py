"""Removal of repeated passages by merging Burrows-Wheeler transforms.

Every string of ``LENGTH`` bytes that starts at two places is removed wherever it occurs. A suffix array of the whole corpus would
show them as neighbours with a common prefix of that length; here it is built in shards that are merged.

1. *Anchors.* Each window of ``LENGTH`` bytes names the leftmost least hash among its ``GRAM``-byte strings. Equal windows
   name equal anchors at equal distances, so windows need only be compared under one anchor hash. The windows that
   share an anchor are consecutive and form a *segment*. A hash seen once is not repeated, which
   spares most of the corpus.
2. *Segments* seen twice as a whole are repeated in full. The distinct segments of one
   anchor hash that differ are fetched, one copy each, and dealt to buckets by that hash.
3. *Transforms.* The segments of a bucket are cut into shards. A shard's suffixes are sorted by ``STEPS`` symbols, a symbol being the
   hash of a block of ``LENGTH / STEPS`` bytes, and its transform lists for each suffix in order the
   symbol before it. Two shards are merged from their transforms alone: starting with one after the other, each round
   sorts the interleave stably by the symbols before, after which it is right for one symbol more
   (Holt and McMillan). Where the order by all symbols has no border, the common prefix is the whole window: those are the repeated intervals.
4. Marked windows go back to their documents, and the bytes that they cover are cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import as_bytes, stored, text_or_empty
from tagwright.operators.skew import spread_join

LENGTH = 400
GRAM = 32
STEPS = 4
CHUNK = 1 << 21
BUCKET_BYTES = 3 << 20
SHARD_BYTES = 1 << 20
#: Distinct segments of one anchor hash from which its windows are counted by Spark, row by row, instead of in one bucket.
HOT_SEGMENTS = 2_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Random values per byte, from a rule.
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([b]), 1) for b in range(256)], np.uint64)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of ``size`` bytes, by doubling: those of longer strings from those of shorter ones."""
    n = len(data) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power, width = None, 0, _BYTES[data], 1
    left = size
    while left:
        if left & 1:
            part = power[done : done + n]
            out = part.copy() if out is None else (out ^ (out >> np.uint64(31))) * _MIX + part
            done += width
        left >>= 1
        if left:
            power = (power[:-width] ^ (power[:-width] >> np.uint64(29))) * _MIX + power[width:]
            width *= 2
    out ^= out >> np.uint64(32)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each window of ``width`` consecutive values, from prefix and suffix minima of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK):
    """Arrays (text, first window, number of windows, anchor hash, segment hash) over all windows of the texts.

    Texts are taken together up to ``chunk`` bytes; longer ones in pieces that overlap by a window.
    """
    out = []
    waiting, size = [], 0

    def flush():
        nonlocal waiting, size
        if waiting:
            out.append(_chunk_segments(waiting, length, gram))
        waiting, size = [], 0

    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        for start in range(0, len(text) - length + 1, chunk):
            piece = text[start : start + chunk + length - 1]
            waiting.append((i, start, piece))
            size += len(piece)
            if size >= chunk:
                flush()
    flush()
    if not out:
        return [np.empty(0, np.int64)] * 5
    return [np.concatenate(c) for c in zip(*out)]


def _chunk_segments(pieces, length, gram):
    joined = b"".join(p for _, _, p in pieces)
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(p) for _, _, p in pieces])
    begins = np.cumsum(sizes) - sizes
    hashes = gram_hashes(data, gram)
    at = np.arange(len(hashes), dtype=np.uint64)
    # Always the same width, so that equal windows name the same anchor in any chunk: of equal upper halves the first counts.
    bits = np.uint64(32)
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = least_in_windows((hashes & ~low) | at, length - gram + 1)
    anchor = (least & low).astype(np.int64)
    # Windows over the end of a piece are none.
    windows = np.repeat(np.arange(len(pieces)), sizes - length + 1)
    starts = np.concatenate([np.arange(b, b + s - length + 1) for b, s in zip(begins, sizes)])
    named = anchor[starts]
    first = np.r_[True, (named[1:] != named[:-1]) | (windows[1:] != windows[:-1])]
    head = np.flatnonzero(first)
    count = np.diff(np.r_[head, len(starts)])
    begin = starts[head]
    view = memoryview(joined)
    digest = xxhash.xxh3_64_intdigest
    whole = np.array([digest(view[b : b + n + length - 1]) for b, n in zip(begin.tolist(), count.tolist())], np.uint64)
    piece = windows[head]
    docs = np.array([i for i, _, _ in pieces])[piece]
    offset = np.array([s for _, s, _ in pieces])[piece] + begin - begins[piece]
    return docs, offset, count, hashes[named[head]].view(np.int64), whole.view(np.int64)


# ---- transforms -------------------------------------------------------------


class Shard:
    """Suffixes of some segments in order of their first ``steps`` symbols, and the transform.

    A position's symbol hashes the block that starts there; the suffix goes on one block further. The last
    positions of a segment, where no whole block is left, end their strings: symbol 0. The symbol
    before the first of a string is its end, which closes the circle that the merge runs along.
    """

    def __init__(self, texts: list[bytes], length: int, steps: int):
        self.steps, block = steps, length // steps
        symbol, before, at = [], [], 0
        self.starts = []
        for text in texts:
            n = len(text)
            real = (gram_hashes(np.frombuffer(text, np.uint8), block) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            symbol += [real, np.zeros(block, np.uint32)]
            own = np.arange(n + 1, dtype=np.int32) - block
            first = np.arange(min(block, n + 1))
            last = n - (n - first) % block  # the end of the string that starts there
            own[: len(first)] = last
            before.append(own + at)
            self.starts.append(at)
            at += n + 1
        self.symbol, self.before = np.concatenate(symbol), np.concatenate(before)
        order = np.arange(at, dtype=np.int32)
        for _ in range(steps):
            order = self.before[order]
            order = order[stable_order(self.symbol[order])]
        self.order = order
        self.transform = self.symbol[self.before[order]]


def stable_order(values: np.ndarray) -> np.ndarray:
    """Stable sorting order of 32-bit values, by two rounds of 16 bits, which numpy sorts by counting."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    high = (values >> np.uint32(16)).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")]


def interleave(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """Which shard the suffix at each merged rank comes from, and where a new common prefix begins.

    Only the transforms are read. A border after a round is where the symbol changes or where a border lay between
    the two ranks that they come from; equal prefixes of all ``steps`` symbols have none between them.
    """
    source = np.concatenate([np.full(len(s.transform), k, np.int16) for k, s in enumerate(shards)])
    group = np.zeros(len(source), np.int32)
    for _ in range(shards[0].steps):
        before = np.empty(len(source), np.uint32)
        for k, s in enumerate(shards):
            before[source == k] = s.transform
        order = stable_order(before)
        source, before, group = source[order], before[order], group[order]
        border = np.r_[True, (before[1:] != before[:-1]) | (group[1:] != group[:-1])]
        group = np.cumsum(border, dtype=np.int32)
    return source, border


def repeated_windows(texts: list[bytes], length: int = LENGTH, steps: int = STEPS, shard_bytes: int = SHARD_BYTES):
    """Per text: the ranges (first, last) of windows that occur more than once among the texts."""
    groups, size = [[]], 0
    for i, text in enumerate(texts):
        if size and size + len(text) > shard_bytes:
            groups.append([])
            size = 0
        groups[-1].append(i)
        size += len(text)
    shards = [Shard([texts[i] for i in g], length, steps) for g in groups]
    source, border = interleave(shards)
    edge = np.flatnonzero(border)
    run = np.diff(np.r_[edge, len(border)])
    # Only whole windows count; at the ends of segments the blocks run out.
    alone = np.repeat(run, run) < 2
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for k, (shard, members) in enumerate(zip(shards, groups)):
        mark = np.zeros(len(shard.symbol), bool)
        mark[shard.order[~alone[source == k]]] = True
        for i, start in zip(members, shard.starts):
            own = mark[start : start + len(texts[i]) - length + 1]
            change = np.flatnonzero(np.diff(np.r_[0, own.view(np.int8), 0]))
            out[i] = list(zip(change[::2].tolist(), (change[1::2] - 1).tolist()))
    return out


# ---- the job ----------------------------------------------------------------


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            texts = as_bytes(batch.column(2))
            which, first, count, key, whole = segments(texts, length)
            take = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(first), pa.array(count, pa.int32()),
                 pa.array(key), pa.array(whole)],
                ["doc_id", "xx", "first", "count", "key", "whole"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "xx", "text").mapInArrow(
        work, f"doc_id {kind}, xx long, first long, count int, key long, whole long"
    )


def _fetched(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """One copy of each wanted segment (key, whole): its bytes."""
    lists = wanted.groupBy("doc_id", "xx").agg(F.collect_list(F.struct("key", "whole", "first", "count")).alias("list"))
    joined = docs.join(lists.withColumnsRenamed({"doc_id": "l_id", "xx": "l_xx"}), F.expr("doc_id <=> l_id AND xx = l_xx"))

    def work(batches):
        for batch in batches:
            key, whole, data = [], [], []
            for text, wants in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist()):
                for w in wants:
                    key.append(w["key"])
                    whole.append(w["whole"])
                    data.append(text[w["first"] : w["first"] + w["count"] + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(whole, pa.int64()), pa.array(data, pa.binary())], ["key", "whole", "data"]
            )

    return joined.select("text", "list").mapInArrow(work, "key long, whole long, data binary")


_RANGES = "key long, whole long, ranges array<struct<a: int, b: int>>"


def _hot_ranges(texts: DataFrame, length: int, steps: int) -> DataFrame:
    """Repeated ranges of the segments of hot anchors: windows are rows, counted by their symbols."""

    def spread(batches):
        block = length // steps
        for batch in batches:
            for key, whole, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                hashes = gram_hashes(np.frombuffer(data, np.uint8), block) >> np.uint64(32)
                n = len(data) - length + 1
                parts = [hashes[k * block : k * block + n] for k in range(steps)]
                d1 = (parts[0] << np.uint64(32)) | parts[1 % steps]
                d2 = (parts[2 % steps] << np.uint64(32)) | parts[3 % steps]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.int64()), pa.array([whole] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)),
                     pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))],
                    ["key", "whole", "at", "d1", "d2"],
                )

    rows = stored(texts.mapInArrow(spread, "key long, whole long, at int, d1 long, d2 long"), "hot_windows")
    twice = rows.groupBy("key", "d1", "d2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    marked = spread_join(rows, twice, ["key", "d1", "d2"], "left_semi")
    return marked.groupBy("key", "whole").agg(
        F.expr("transform(array_sort(collect_list(at)), i -> struct(i AS a, i AS b))").alias("ranges")
    )


def repeated_ranges(docs: DataFrame, length: int = LENGTH, steps: int = STEPS, hot: int = HOT_SEGMENTS) -> DataFrame:
    """``doc_id``, ``xx`` (hash of the text) and ``spans``, the byte ranges that repeated strings cover."""
    anchors = stored(_anchored(docs, length), "anchors")
    seen = anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = stored(spread_join(anchors, seen, "key", "inner").drop("n"), "candidates")
    distinct = stored(
        twice.groupBy("key", "whole").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("count").alias("count"),
            F.min(F.struct("doc_id", "xx", "first")).alias("at"),
        ),
        "segments",
    )
    # A hash whose segments are all alike, or all repeated, needs no comparison.
    open_keys = (
        distinct.groupBy("key")
        .agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
        .filter("kinds > 1 AND least = 1")
        .select("key", "kinds")
    )
    wanted = spread_join(distinct, open_keys, "key", "inner").select(
        "key", "whole", "kinds", "at.doc_id", "at.xx", "at.first", "count"
    )
    texts = stored(_fetched(docs, wanted, length).dropDuplicates(["key", "whole"]), "texts")
    kinds = texts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
    hot_keys = kinds.filter(f"kinds > {hot}").select("key")
    total = texts.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "whole"], ignore_index=True)
        ranges = repeated_windows([bytes(d) for d in rows["data"]], length, steps)
        rows = rows.assign(ranges=[[{"a": a, "b": b} for a, b in r] for r in ranges])
        return rows.loc[rows["ranges"].str.len() > 0, ["key", "whole", "ranges"]]

    cold = spread_join(texts, hot_keys, "key", "left_anti")
    compared = cold.groupBy(F.expr(f"pmod(xxhash64(key), {buckets})").alias("bucket")).applyInPandas(
        lambda rows: compare(rows[["key", "whole", "data"]]), _RANGES
    )
    hottest = _hot_ranges(spread_join(texts, hot_keys, "key", "left_semi"), length, steps)
    in_full = distinct.filter("n > 1").select(
        "key", "whole", F.expr("array(struct(0 AS a, count - 1 AS b))").alias("ranges")
    )
    part = compared.union(hottest)
    found = in_full.union(spread_join(part, in_full.select("key", "whole"), ["key", "whole"], "left_anti"))
    ranges = stored(found, "ranges")
    marked = spread_join(twice.select("doc_id", "xx", "first", "key", "whole"), ranges, ["key", "whole"], "inner")
    spans = marked.select(
        "doc_id", "xx", F.expr(f"inline(transform(ranges, r -> struct(first + r.a AS s, first + r.b + {length} AS e)))")
    )
    # A set: repeated rows of one doc_id and text name the same spans, which are kept once in each task.
    return spans.groupBy("doc_id", "xx").agg(F.expr("collect_set(struct(s, e))").alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for s, e in spans:
        out.append(text[at:s])
        at = e
    return b"".join(out) + text[at:]


def remove_repeats(docs: DataFrame, length: int = LENGTH, steps: int = STEPS, hot: int = HOT_SEGMENTS) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Texts are UTF-8 bytes, null and empty ones have none. A byte goes if a string of ``length`` bytes over it also starts elsewhere,
    in this row or another, as the input stands; repeated rows therefore lose all such bytes. ``length`` must be a
    multiple of ``steps``. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("xx", F.xxhash64("text"))
    ranges = stored(repeated_ranges(rows, length, steps, hot), "spans")
    joined = rows.join(
        ranges.withColumnsRenamed({"doc_id": "r_id", "xx": "r_xx"}), F.expr("doc_id <=> r_id AND xx = r_xx"), "left"
    )

    def work(batches):
        for batch in batches:
            out = []
            for text, found in zip(as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                spans = merged([(f["s"], f["e"]) for f in found or ()])
                kept = without(text, spans)
                out.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "spans").mapInArrow(
        work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
