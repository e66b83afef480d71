"""Document fingerprints: a Merkle tree over paragraphs and sections.

Leaves are paragraphs: lines, cut further at sentence ends once they are long, since many texts have no
lines. Sections are runs of leaves that end where a leaf's hash says so, so an
edit moves only the borders near it. Section hashes cover their leaves, the root covers the sections. A fingerprint is text,
``root:section=leaf+leaf…,section=…``: equal roots mean equal texts, equal sections need no look at
their leaves, and differing branches locate the edit.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from os.path import commonprefix

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import as_bytes, n_bytes, stored, text_or_empty

#: Bytes after which a line may be cut, at the next sentence end or at the limit; a shorter rest is a leaf.
LEAF_LEAST, LEAF_MOST = 64, 256
#: One leaf in so many ends a section.
SECTION = 8
RANGE_BYTES = 8 << 20

#: Rows with their result; the first and the last text of a range.
_DONE, _FIRST, _LAST = 0, 1, 2
#: Characters of a fingerprint that are the root.
_ROOT = 32

_LEAF = re.compile(
    rb"[^\n]{0,%d}(?:\n|$)|[^\n]{%d,%d}?[.!?|](?=\s)|[^\n]{%d,%d}(?:\n|$)|[^\n]{%d}"
    % (LEAF_LEAST, LEAF_LEAST, LEAF_MOST - 1, LEAF_LEAST + 1, LEAF_MOST - 1, LEAF_MOST)
)


def leaves(text: bytes) -> list[bytes]:
    """Consecutive pieces of the text, of at most ``LEAF_MOST`` bytes, which joined give it back."""
    return [m.group() for m in _LEAF.finditer(text) if m.group()]


def _hash(data: bytes, seed: int = 0) -> str:
    return xxhash.xxh64_hexdigest(data, seed)


def tree(text: bytes) -> tuple[str, list[tuple[str, list[str]]]]:
    """Root and sections; a leaf is known by its hash and its length."""
    sections, run = [], []
    for leaf in leaves(text):
        h = _hash(leaf)
        run.append(f"{h[:12]}.{len(leaf):x}")
        if int(h[-2:], 16) % SECTION == 0:
            sections.append(run)
            run = []
    if run:
        sections.append(run)
    nodes = [(_hash("+".join(s).encode(), 1), s) for s in sections]
    root = xxhash.xxh128_hexdigest(",".join(n for n, _ in nodes).encode() + b"#" + xxhash.xxh128_digest(text))
    return root, nodes


def written(root: str, nodes: list[tuple[str, list[str]]]) -> str:
    return root + ":" + ",".join(f"{n}={'+'.join(s)}" for n, s in nodes)


def read(fingerprint: str) -> tuple[str, list[tuple[str, list[str]]]]:
    root, _, rest = fingerprint.partition(":")
    parts = [s.partition("=") for s in rest.split(",") if s]
    return root, [(n, s.split("+")) for n, _, s in parts]


def likeness(a: tuple[str, list], b: tuple[str, list]) -> float:
    """Bytes in common leaves, twice, by the bytes of both texts; 1 for equal roots.

    Sections that both trees have are matched whole; only the leaves below the others are compared.
    """
    if a[0] == b[0]:
        return 1.0

    def weight(leaf: str) -> int:
        return int(leaf.rpartition(".")[2], 16)

    whole = sum(weight(x) for _, s in (*a[1], *b[1]) for x in s)
    if not whole:
        return 0.0
    left, right = Counter(n for n, _ in a[1]), Counter(n for n, _ in b[1])
    same = left & right
    of = {n: s for n, s in a[1]}
    common = sum(k * sum(map(weight, of[n])) for n, k in same.items())

    def others(nodes):
        used, out = Counter(same), Counter()
        for n, s in nodes:
            if used[n]:
                used[n] -= 1
            else:
                out.update(s)
        return out

    common += sum(weight(x) * k for x, k in (others(a[1]) & others(b[1])).items())
    return min(1.0, 2 * common / whole)


def changes(a: tuple[str, list], b: tuple[str, list]) -> list[tuple[int, int]]:
    """Byte spans of the first text whose leaves the second lacks."""
    there, out, at = {n for n, _ in b[1]}, [], 0
    kept = {x for _, s in b[1] for x in s}
    for n, s in a[1]:
        for leaf in s:
            size = int(leaf.rpartition(".")[2], 16)
            if n not in there and leaf not in kept:
                if out and out[-1][1] == at:
                    out[-1] = (out[-1][0], at + size)
                else:
                    out.append((at, at + size))
            at += size
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row; null is the empty text."""

    def work(batches):
        for batch in batches:
            prints = [written(*tree(t)) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(work, f"doc_id {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third, in whole code points, replaced by the first as many of the next text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _row(doc_id: int | None, text: str, known: tuple, following: str, next_tree: tuple) -> tuple:
    """One row of ``fingerprint_edits``; ``known`` and ``next_tree`` are the trees of both texts."""
    new = edited(text, following).encode()
    changed = known if new == text.encode() else tree(new)
    return (
        doc_id, len(text), hashlib.sha256(new).hexdigest(), written(*known), written(*changed),
        likeness(known, changed), likeness(known, next_tree),
    )


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = [f.split()[0] for f in _RESULT.split(", ")]


def fingerprint_edits(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each row and its edited text, with both fingerprints and how alike they are.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. The next document is the one with the next smaller doc_id, after the last the
    first; a table of one row is its own next. Null texts are empty. Null doc_ids come last; equal ones are
    ordered by a hash of the text, and equal rows by the task that read them, so that copies lie in many
    ranges too. Other columns are ignored; an empty table gives no rows.

    Spark shuffles the texts once, into ranges of that order of about ``range_bytes`` bytes each; a task reads its
    range in order. Its last text has its next one in another range: first and last texts of the ranges are written beside
    the results and joined, two rows a range. Neither the plan nor what the driver holds grows with
    the number of ranges, but for the range bounds that Spark itself keeps.
    """
    text = text_or_empty()
    total = docs.agg(F.sum(n_bytes(text))).first()[0] or 0
    parts = max(1, -(-int(total) // range_bytes))
    # Order: descending doc_id, then the hash. ``o`` rises along it.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).selectExpr(
        "coalesce(-1L - doc_id, 9223372036854775807L) AS o", "xxhash64(text) AS tie", "spark_partition_id() AS task", "doc_id", "text"
    )
    order = ["o", "tie", "task"]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def work(batches):
        def finish(out):
            columns = list(zip(*out))
            arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int32(), pa.int32(), pa.string(), pa.int32(), *_KINDS])]
            return pa.RecordBatch.from_arrays(arrays, ["kind", "part", "text", "shared", *_NAMES])

        none = [None] * (len(_NAMES) - 1)
        last, out, held = None, [], 0
        for batch in batches:
            for part, doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2))):
                whole, now = raw.decode(), tree(raw)
                if last is None:
                    out.append((_FIRST, part, whole, None, doc, *none))
                else:
                    row = _row(*last[1:], whole, now)
                    # The edited fingerprint is written without the branches that it begins with in common.
                    shared = len(commonprefix([row[3][_ROOT:], row[4][_ROOT:]]))
                    out.append((_DONE, part, None, shared, *row[:4], row[4][:_ROOT] + row[4][_ROOT + shared :], *row[5:]))
                    held += len(raw) + len(row[3])
                last = (part, doc, whole, now)
                if held > 8 << 20:
                    yield finish(out)
                    out, held = [], 0
        if last:
            out.append((_LAST, last[0], last[2], None, last[1], *none))
        if out:
            yield finish(out)

    done = stored(
        ranged.selectExpr("spark_partition_id() AS part", "doc_id", "text").mapInArrow(
            work, f"kind int, part int, text string, shared int, {_RESULT}"
        ),
        "fingerprints",
        compression="zstd",
    )
    edges = done.filter(f"kind <> {_DONE}").select("kind", "part", "doc_id", "text")
    first = edges.filter(f"kind = {_FIRST}").select(F.col("part").alias("next"), F.col("text").alias("following"))
    # One number for each range that has rows; the first follows the last.
    after = first.selectExpr(
        "lag(next, 1) OVER (ORDER BY next) AS part", "max(next) OVER () AS end", "next"
    ).selectExpr("coalesce(part, end) AS part", "next")
    pairs = edges.filter(f"kind = {_LAST}").join(after, "part").join(first, "next").select("doc_id", "text", "following")

    def meet(batches):
        for batch in batches:
            out = []
            for doc, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                out.append(_row(doc, a, tree(a.encode()), b, tree(b.encode())))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)] if out else [pa.array([], k) for k in _KINDS], _NAMES)

    whole = (
        f"concat(left(edited_fingerprint, {_ROOT}), substring(fingerprint, {_ROOT + 1}, shared), "
        f"substring(edited_fingerprint, {_ROOT + 1})) AS edited_fingerprint"
    )
    rows = done.filter(f"kind = {_DONE}").selectExpr(*[whole if n == "edited_fingerprint" else n for n in _NAMES])
    return rows.union(pairs.mapInArrow(meet, _RESULT))
