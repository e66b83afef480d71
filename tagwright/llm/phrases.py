"""Phrase collocation mining by top-order marginalisation.

Each word of a piece opens one window: itself and the words that follow, padded at the end of the piece. The
words after the first are columns of the same words, shifted. Only these longest windows are counted, within tasks first.
Every shorter phrase is the prefix of the windows that it opens, so its count is a sum over them, which ROLLUP
takes for all shorter prefixes at once; no n-grams of other lengths are made. Candidates are then cut, scored
and compared with the longer ones that hold them.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagwright.llm.common import as_bytes, stored
from tagwright.operators.skew import spread_join

LONGEST = 3
LEAST = 10
#: A candidate goes if a longer one around it has at least this percentage of its count.
HELD_PERCENT = 50
TOP = 2000
SCALE = 1_000_000
UNKNOWN = "und"

#: Texts counted at a time, positions of a text counted at a time, different words after a prefix that stay in its bucket.
FLUSH_BYTES, _POSITIONS, TAIL_MOST = 4 << 20, 1 << 20, 1024
#: What ends a piece; the first of them also pads windows, and another stands for rare words: no word can hold them.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_END, RARE = b".", ","
_TABLE = bytes.maketrans(
    string.ascii_uppercase.encode() + _ENDS + b"\t", string.ascii_lowercase.encode() + _END * len(_ENDS) + b" "
)
#: An odd number that mixes the bits of a hash.
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _words(n: int) -> list[str]:
    return [f"w{i}" for i in range(1, n + 1)]


class Counting:
    """Counts the padded windows of texts, and packs them for the shuffle.

    Word columns are one list of ids, shifted; a window is one number made of them, so counting is a sort of numbers. Each
    counted window is a line, its words and, after a tab, its number if that is not one. Lines go to buckets by a hash of
    all words but the last, the prefix. The lines of a prefix that many different words follow are dealt over the
    buckets by that word too; a line with ``RARE`` in its place then tells every bucket of the prefix that it is frequent.
    """

    def __init__(self, longest: int, buckets: int, tail_most: int):
        self.longest, self.buckets, self.tail_most = longest, buckets, tail_most

    def blobs(self, texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
        text = _END.join(texts).translate(_TABLE).replace(_END, b" " + _END + b" ")
        tokens = text.split()
        # A piece of so many positions has few enough words for its windows to be 64-bit numbers.
        for start in range(0, len(tokens), _POSITIONS):
            yield from self._counted(tokens[start : start + _POSITIONS + self.longest - 1])

    def _counted(self, tokens: list[bytes]) -> Iterator[tuple[int, bytes]]:
        words = list(dict.fromkeys([_END, *tokens]))
        index = dict(zip(words, range(len(words))))
        ids = np.fromiter(map(index.__getitem__, tokens), np.int64, len(tokens))
        opened = min(len(ids), _POSITIONS)
        ids = np.r_[ids, np.zeros(self.longest, np.int64)]
        columns = [ids[:opened]]
        for k in range(1, self.longest):
            columns.append(np.where(columns[-1] == 0, 0, ids[k : k + opened]))
        is_word = np.flatnonzero(columns[0])
        if not len(is_word):
            return
        columns = [c[is_word] for c in columns]
        prefix = columns[0]
        for column in columns[1:-1]:
            prefix = prefix * len(words) + column
            if len(words) ** self.longest >= 1 << 62:
                prefix = np.unique(prefix, return_inverse=True)[1]
        windows, first, counts = np.unique(prefix * len(words) + columns[-1], return_index=True, return_counts=True)
        columns = [c[first] for c in columns]
        prefix = prefix[first]
        hashes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        mixed = np.zeros(len(windows), np.uint64)
        for column in columns[:-1]:
            mixed = (mixed ^ hashes[column]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        sizes = np.diff(np.r_[starts, len(windows)])
        many = np.repeat(sizes > self.tail_most, sizes)
        by_last = (mixed ^ hashes[columns[-1]]) * _MIX
        home = (mixed >> np.uint64(11)) % np.uint64(self.buckets)
        bucket = np.where(many, (by_last >> np.uint64(11)) % np.uint64(self.buckets), home).astype(np.int64)

        texts = [list(map(words.__getitem__, c.tolist())) for c in columns]
        lines = list(map(b" ".join, zip(*texts)))
        for i in np.flatnonzero(counts > 1).tolist():
            lines[i] += b"\t%d" % counts[i]
        extra: set[tuple[int, bytes]] = set()
        for i in np.flatnonzero(many).tolist():
            told = b" ".join([*(t[i] for t in texts[:-1]), RARE.encode()]) + b"\t0"
            extra.update(((int(bucket[i]), told), (int(home[i]), told)))
        order = np.argsort(bucket, kind="stable")
        sorted_bucket = bucket[order]
        lines = list(map(lines.__getitem__, order.tolist()))
        at = np.flatnonzero(np.r_[True, sorted_bucket[1:] != sorted_bucket[:-1], True])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield int(sorted_bucket[a]), b"\n".join(lines[a:b])
        for k, line in extra:
            yield k, line


def _merged(blobs: Counter, least: int) -> Iterator[tuple[list[str], int]]:
    """Words and count of each window of a bucket, rare ones together; ``blobs`` counts equal lines."""
    counts: Counter = Counter()
    opened, totals = set(), Counter()
    for line, n in blobs.items():
        window, _, times = line.partition(b"\t")
        if times == b"0":
            opened.add(window[: window.rindex(b" ")] if b" " in window else b"")
        else:
            counts[window] += n * int(times) if times else n
    for window, n in counts.items():
        totals[window[: window.rindex(b" ")]] += n
    rest: Counter = Counter()
    rare = RARE.encode()
    for window, n in counts.items():
        prefix = window[: window.rindex(b" ")]
        if prefix in opened or n >= least:
            yield window.decode().split(" "), n
        elif totals[prefix] >= least:
            rest[prefix + b" " + rare] += n
        else:
            rest[prefix[: prefix.rindex(b" ") + 1] + rare + b" " + rare if b" " in prefix else rare + b" " + rare] += n
    for window, n in rest.items():
        yield window.decode().split(" "), n


def packed_windows(docs: DataFrame, longest: int, buckets: int, tail_most: int = TAIL_MOST) -> DataFrame:
    """``lang``, ``bucket`` and ``blob``, the counted windows of one task's texts that belong there."""

    def work(batches):
        counting = Counting(longest, buckets, tail_most)

        def counted(held):
            for lang, texts in held.items():
                found = list(counting.blobs(texts))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(found), pa.string()), pa.array([k for k, _ in found], pa.int32()),
                            pa.array([b for _, b in found], pa.binary()),
                        ],
                        ["lang", "bucket", "blob"],
                    )

        held, size = {}, 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size > FLUSH_BYTES:
                    yield from counted(held)
                    held, size = {}, 0
        yield from counted(held)

    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(work, "lang string, bucket int, blob binary")


def windows(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, tail_most: int = TAIL_MOST) -> DataFrame:
    """``lang``, the words ``w1`` to ``wN`` of every padded window, and ``f``, how often it occurs.

    Words that make a prefix or a window rarer than ``least`` are replaced by ``RARE``, as no count of theirs is ever looked up; all
    sums over windows stay what they are. So few distinct windows are left that shuffling them again is cheap.
    The one shuffle of everything is of packed lines by bucket, eight buckets for each shuffle partition. A task
    counts one bucket at a time; a frequent window is one line per task that has it, and a prefix that is a third of the
    table lies in all buckets.
    """
    names = _words(longest)
    buckets = 8 * max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def merge(batches):
        def emitted(lang, blobs):
            found = list(_merged(blobs, least))
            if found:
                columns = list(zip(*[w for w, _ in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string())]
                    + [pa.array(c, pa.string()) for c in columns]
                    + [pa.array([n for _, n in found], pa.int64())],
                    ["lang", *names, "f"],
                )

        key, blobs = None, Counter()
        for batch in batches:
            for lang, bucket, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if (lang, bucket) != key:
                    if key:
                        yield from emitted(key[0], blobs)
                    key, blobs = (lang, bucket), Counter()
                blobs.update(blob.split(b"\n"))
        if key:
            yield from emitted(key[0], blobs)

    dealt = packed_windows(docs, longest, buckets, tail_most).repartition("lang", "bucket").sortWithinPartitions("lang", "bucket")
    merged = dealt.mapInArrow(merge, "lang string, " + ", ".join(f"{w} string" for w in names) + ", f long")
    return merged.groupBy("lang", *names).agg(F.sum("f").alias("f"))


def counted(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, tail_most: int = TAIL_MOST
) -> tuple[DataFrame, DataFrame]:
    """Written counts: of the longest windows, and of the words and shorter phrases that ROLLUP sums from them.

    The second table has ``lang``, ``w1`` to ``wN-1`` (null beyond the phrase) and ``f``; phrases of no word are the
    language's words altogether. Both aggregate within tasks first, so a frequent word or language is a
    few partial sums.
    """
    names = _words(longest)
    top = stored(windows(docs, longest, least, tail_most), "windows")
    shorter = top.rollup("lang", *names[:-1]).agg(F.sum("f").alias("f"), F.grouping("lang").alias("all"))
    return top, shorter.filter("all = 0").drop("all")


def top_rows(df: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group and their ``rank``; no task sorts a whole group.

    Rows are dealt by their hash to as many salts as there are shuffle partitions, then to the square root of that, and
    each keeps its first ``n``; what reaches the last task of a group is at most ``n`` rows for each salt of the second deal.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    shuffles = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    listed = ", ".join(f"`{c}`" for c in df.columns)
    for salts in (shuffles, isqrt(shuffles), 1):
        salted = df.withColumn("__salt", F.expr(f"pmod(xxhash64({listed}), {salts})"))
        over = F.row_number().over(Window.partitionBy(group, "__salt").orderBy(*order))
        df = salted.withColumn("rank", over).filter(F.col("rank") <= n)
        if salts > 1:
            df = df.select(*columns)
    return df.select(*columns, F.col("rank").cast("long").alias("rank"))


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    held_percent: int = HELD_PERCENT,
    top: int = TOP,
    tail_most: int = TAIL_MOST,
) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words by how much they stick together.

    Columns: ``lang`` (null: ``und``), ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of the two
    parts of its loosest cut), ``n`` (words of the language), ``score``: floor(10⁶·a²/(l·r)) at that cut. Candidates
    have at least ``least`` occurrences; one that lies in a longer candidate with ``held_percent`` of its count or more is
    dropped. Arithmetic is in decimals of 38 digits, exact up to 10¹⁵ occurrences. Null and empty texts have
    no words; repeated rows count each; other columns are ignored; an empty table gives no rows.
    """
    names = _words(longest)
    windows_, shorter = counted(docs, longest, least, tail_most)
    none = f"'{_END.decode()}', '{RARE}'"
    full = windows_.filter(f"f >= {least} AND {names[-1]} NOT IN ({none})").selectExpr("lang", _joined(names), f"{longest} AS k", "f")
    # Parts of a candidate occur at least as often as it does, so rarer phrases are never looked up.
    parts = []
    for k in range(longest):
        here = [f"{w} NOT IN ({none})" for w in names[:k]] + [f"{w} IS NULL" for w in names[k:-1]]
        parts.append(" AND ".join(here))
    kinds = "CASE " + " ".join(f"WHEN {p} THEN {k}" for k, p in enumerate(parts)) + " END"
    frequent = stored(
        shorter.filter(f"f >= {least}")
        .selectExpr("lang", _joined(names[:-1]), f"{kinds} AS k", "f")
        .filter("k IS NOT NULL")
        .union(full),
        "phrases",
    )
    totals = frequent.filter("k = 0").select("lang", F.col("f").alias("n"))
    known = frequent.filter("k > 0").select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))
    candidates = frequent.filter("k > 1").selectExpr("lang", "phrase", "split(phrase, ' ') AS words", "k", "f AS a")

    cuts = candidates.select("lang", "phrase", "words", "k", "a", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.selectExpr(
        "lang", "phrase", "a", "cut",
        "concat_ws(' ', slice(words, 1, cut)) AS first", "concat_ws(' ', slice(words, cut + 1, k - cut)) AS rest",
    )
    for part, count in (("first", "l"), ("rest", "r")):
        cuts = spread_join(cuts, known.toDF("lang", part, count), ["lang", part], "inner")
    big = "CAST({} AS DECIMAL(15, 0))"
    a, l, r = (big.format(x) for x in "alr")
    scored = cuts.selectExpr(
        "lang", "phrase", "a", "struct(" f"CAST((CAST({SCALE} AS DECIMAL(7, 0)) * ({a} * {a})) div ({l} * {r}) AS BIGINT) AS score, cut, l, r) AS s"
    )
    best = scored.groupBy("lang", "phrase", "a").agg(F.min("s").alias("s"))

    # The greatest count among the longer candidates around each phrase.
    inner = candidates.filter("k > 2").selectExpr("lang", "words", "k", "a AS around").selectExpr(
        "lang", "around", "words", "k", "explode(sequence(2, k - 1)) AS size"
    )
    inner = inner.selectExpr("lang", "around", "words", "size", "explode(sequence(1, k - size + 1)) AS at").selectExpr(
        "lang", "around", "concat_ws(' ', slice(words, at, size)) AS phrase"
    )
    most = inner.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = spread_join(best, most, ["lang", "phrase"], "left").filter(
        f"around IS NULL OR {big.format('around')} * 100 < {big.format('a')} * {held_percent}"
    )
    rows = spread_join(kept.selectExpr("lang", "phrase", "a", "s.l", "s.r", "s.score"), totals, "lang", "inner")
    ranked = top_rows(rows, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _joined(names: list[str]) -> str:
    """SQL: the words of a window up to its pad as one text; null words are left out."""
    return f"concat_ws(' ', {', '.join(names)}) AS phrase" if names else "'' AS phrase"
