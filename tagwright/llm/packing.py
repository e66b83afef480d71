"""Best-fit packing with certified bin counts.

Remainders of documents are dealt to partitions, and each partition packs its own by best fit
decreasing. A lower bound from dual-feasible functions tells whether its number of bins is the least
possible. Where it is, all bins but the emptiest are final; else the partition keeps its full bins only. The
other documents are exchanged between the partitions and packed again. A partition that is left alone with a gap
packs part of its bins again, several times.
"""

from __future__ import annotations

import json
import sys
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from pathlib import Path
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import as_bytes, stored

CAPACITY = 4096
END = 1
ROUNDS = 4
#: How often an uncertified part is packed again where no exchange follows.
ATTEMPTS = 24
#: Rows that a task packs at a time.
PART_ROWS = 20_000
#: Words whose ids a worker keeps, and bytes of text that it encodes at once.
KNOWN_WORDS = 400_000
CHUNK = 8_000_000


def _parted(word: bytes) -> tuple[bytes, bytes]:
    """A run as a stem in lower case and its closing marks, which have the same ids apart as together.

    The tokenizer lower-cases, and between a letter or digit and a mark it always cuts. Runs with an apostrophe or the
    beginning of a special token are left whole, as are those where the stem ends otherwise.
    """
    if word.isalpha():  # ASCII letters only
        return word.lower(), b""
    if b"'" in word or b"<|" in word:
        return word, b""
    lower = word.lower()
    stem = lower.rstrip(_MARKS)
    if not stem or len(stem) == len(lower):
        return lower, b""
    if not (stem[-1:].isalnum() or stem[-4:].decode(errors="ignore")[-1:].isalnum()):
        return lower, b""
    return stem, lower[len(stem) :]


#: Small letters of ASCII and Latin-1: one token of the pre-tokenizer, composed, and in lower case already.
_SMALL = "[a-z\u00df-\u00f6\u00f8-\u00ff]"
_LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))

_MARKS = b".,;:!?%$&*#|\"()=[]{}/-_+<>~^@"


class _Known:
    """Words, each closed by a blank, and their ids: one Arrow array and one flat array, a tenth of the memory of a dict.

    Row 0 is the empty word, row 1 the end of a text. When there are over ``most`` words, the half that was met last stays.
    """

    def __init__(self, end: int, most: int):
        self.most, self.clock = most, 0
        self.words = pa.array([" ", ""], pa.large_string())  # no word is ""
        self.ids = np.array([end], "<u4")
        self.ends = np.array([0, 1])
        self.met = np.zeros(2, np.int64)

    def find(self, words: pa.Array) -> np.ndarray:
        """The row of each word, -1 where it is not known."""
        rows = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().astype(np.int64)
        self.met[rows[rows >= 0]] = self.clock
        return rows

    def add(self, words: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The rows of the words, which were not known."""
        rows = np.arange(len(self.words), len(self.words) + len(words))
        self.words = pa.concat_arrays([self.words, words])
        self.ends = np.r_[self.ends, self.ends[-1] + np.cumsum(lengths)]
        self.ids = np.r_[self.ids, ids]
        self.met = np.r_[self.met, np.full(len(words), self.clock)]
        return rows

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        """Ids of each row's word."""
        return self.ends[rows] - np.where(rows, self.ends[rows - 1], 0)

    def take(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The ids of the words, one after the other."""
        at = np.repeat(self.ends[rows] - np.cumsum(lengths), lengths)
        at += np.arange(len(at))
        return self.ids[at]

    def trim(self) -> None:
        self.clock += 1
        if len(self.words) > self.most:
            self.met[:2] = self.clock
            rows = np.sort(np.argsort(self.met, kind="stable")[-self.most // 2 :])
            lengths = self.lengths(rows)
            self.ids, self.ends = self.take(rows, lengths), np.cumsum(lengths)
            self.words, self.met = self.words.take(pa.array(rows)), self.met[rows]


def stream_encoder(tokenizer_file: str, end: int = END) -> Callable[[list[bytes]], Iterator[bytes]]:
    """Text → little-endian 32-bit ids, the end id last.

    The tokenizer never joins across blanks, so each run of other characters is encoded once and kept, and so are
    the parts that ``_parted`` makes of runs: up to ``KNOWN_WORDS`` of both, and those that ``CHUNK`` bytes add. The runs of
    so many bytes are told apart by Arrow at once, and their ids gathered by numpy.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    model = Tokenizer.from_file(tokenizer_file)
    # Small letters alone are neither changed by the normalizer nor cut by the pre-tokenizer, so these steps are left out.
    bare = Tokenizer.from_file(tokenizer_file)
    bare.normalizer = normalizers.Sequence([])
    by_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), by_bytes])
    spec = json.loads(Path(tokenizer_file).read_text())["model"]
    suffix, last = spec.get("end_of_word_suffix"), np.zeros(max(spec["vocab"].values()) + 1, bool)
    last[[i for token, i in spec["vocab"].items() if suffix and token.endswith(suffix)]] = True
    known = _Known(end, KNOWN_WORDS)
    blank = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))

    def learn_parts(parts: pa.Array) -> np.ndarray:
        """Rows of parts that were not known."""
        small = pc.match_substring_regex(parts, f"^{_SMALL}+ $")
        if not last.any():
            small = pc.and_(small, False)
        small, rows = small.to_numpy(zero_copy_only=False), np.empty(len(parts), np.int64)
        for many, at in ((True, np.flatnonzero(small)), (False, np.flatnonzero(~small))):
            for some in np.array_split(at, -(-len(at) // 50_000) or 1):
                words = parts.take(pa.array(some))
                texts = words.to_pylist()
                if many:  # a thousand words in a text
                    texts = ["".join(texts[i : i + 1000]) for i in range(0, len(texts), 1000)]
                    found = bare.encode_batch_fast(texts, add_special_tokens=False)
                else:
                    found = model.encode_batch_fast([t[:-1] for t in texts], add_special_tokens=False)
                found = [np.array(e.ids, "<u4") for e in found]
                ids = np.concatenate([np.empty(0, "<u4"), *found])
                lengths = np.diff(np.flatnonzero(last[ids]), prepend=-1) if many else np.array([len(i) for i in found], np.int64)
                rows[some] = known.add(words, ids, lengths)
        return rows

    def learn(words: pa.Array) -> np.ndarray:
        """Rows of words that were not known."""
        stems, marks = pc.ascii_rtrim(words, _MARKS.decode() + " "), pc.utf8_ltrim(words, _LETTERS)
        simple = pc.match_substring_regex(stems, f"^{_SMALL}+$")  # small letters, then marks
        order = np.argsort(~simple.to_numpy(zero_copy_only=False), kind="stable")
        split = [_parted(w[:-1].encode()) for w in words.filter(pc.invert(simple)).to_pylist()]
        stems = pc.binary_join_element_wise(stems.filter(simple), *(pa.scalar(x, words.type) for x in (" ", "")))
        stems = pa.concat_arrays([stems, pa.array([s.decode() + " " for s, _ in split], words.type)])
        marks = pa.concat_arrays([marks.filter(simple), pa.array([m.decode() + " " for _, m in split], words.type)])
        words = words.take(pa.array(order))
        both = pa.concat_arrays([stems, marks]).dictionary_encode()
        parts = both.dictionary
        rows = known.find(parts)
        new = np.flatnonzero(rows < 0)
        rows[new] = learn_parts(parts.take(pa.array(new)))
        rows = rows[both.indices.to_numpy()].reshape(2, -1)
        out = rows[0].copy()
        more = np.flatnonzero(pc.not_equal(words, stems).to_numpy(zero_copy_only=False))  # the others are one part each
        of = rows[:, more].T.ravel()
        lengths = known.lengths(of)
        out[more] = known.add(words.take(pa.array(more)), known.take(of, lengths), lengths.reshape(-1, 2).sum(1))
        out[order] = out.copy()
        return out

    def chunk(texts: list[bytes]) -> list[bytes]:
        known.trim()
        # The tokenizer lower-cases all but special tokens, so words that differ by case are one.
        raw = bytearray(b" ".join([*(t if b"<|" in t else t.lower() for t in texts), b""]))
        chars = np.frombuffer(raw, np.uint8)
        ends = np.flatnonzero(blank[chars]) + 1
        chars[ends - 1] = 32
        offsets = pa.array(np.r_[0, ends], pa.int64()).buffers()[1]
        runs = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, offsets, pa.py_buffer(raw)])
        runs = runs.dictionary_encode()
        words = runs.dictionary.cast(pa.large_string())
        rows = known.find(words)
        new = np.flatnonzero(rows < 0)
        rows[new] = learn(words.take(pa.array(new)))
        closed = np.searchsorted(ends, np.cumsum([len(t) + 1 for t in texts]), "right")  # runs up to each text's end
        rows = np.insert(rows[runs.indices.to_numpy()], closed, 1)
        lengths = known.lengths(rows)
        coded = known.take(rows, lengths)
        stops = np.cumsum(lengths)[closed + np.arange(len(texts))].tolist()
        return [coded[a:b].tobytes() for a, b in zip([0, *stops], stops)]

    def encoded(texts: list[bytes]) -> Iterator[bytes]:
        start, size = 0, 0
        for i, t in enumerate(texts, 1):
            size += len(t)
            if size >= CHUNK or i == len(texts):
                yield from chunk(texts[start:i])
                start, size = i, 0

    return encoded


def encoder(tokenizer_file: str, end: int = END) -> Callable[[list[bytes]], list[bytes]]:
    """The same for all texts at once."""
    encoded = stream_encoder(tokenizer_file, end)
    return lambda texts: list(encoded(texts))


def kept_encoder(tokenizer_file: str, end: int = END):
    """The ``stream_encoder`` of this Python worker, which Spark uses for one task after another: files are read and words encoded once.

    It is kept in a module of its own, as this one is sent with every task.
    """
    kept = sys.modules.setdefault("_tagwright_kept", ModuleType("_tagwright_kept")).__dict__
    key = f"encoder of {tokenizer_file} {end}"
    if key not in kept:
        kept[key] = stream_encoder(tokenizer_file, end)
    return kept[key]


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Per piece of a document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""

    def work(batches):
        encode = kept_encoder(tokenizer_file, end)
        step = 4 * capacity
        for batch in batches:
            ids, texts = batch.column(0), as_bytes(batch.column(1))
            at, rows = [], []
            for i, coded in enumerate(encode(texts)):
                for k, begin in enumerate(range(0, len(coded), step)):
                    piece = coded[begin : begin + step]
                    at.append(i)
                    rows.append((k, begin // 4, len(piece) // 4, zlib.crc32(piece)))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int32())]
                + [pa.array(c, pa.int64()) for c in columns[1:]],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        pa.default_memory_pool().release_unused()  # the worker stays for a while

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing has fewer bins: the best of a family of dual-feasible functions.

    For a threshold t up to half the capacity, items over capacity - t count as whole bins,
    items under t not at all, the rest by size. The function that counts only items over half a bin,
    and the rounding ones with 2 to 20 parts, complete the family.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)
    sizes = np.arange(capacity + 1)
    n_upto, sum_upto = np.cumsum(counts), np.cumsum(counts * sizes)
    t = np.arange(0, capacity // 2 + 1)
    large = n_upto[capacity] - n_upto[capacity - t]
    middle = sum_upto[capacity - t] - np.where(t > 0, sum_upto[np.maximum(t - 1, 0)], 0)
    best = int(np.max(large + -(-middle // capacity)))
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        # An exact multiple of a part counts by size, anything else by the parts below it; in units of 1 / (k * capacity).
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, int(-(-(counts * value).sum() // (k * capacity))))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY, order: np.ndarray | None = None) -> np.ndarray:
    """Bin of each item, numbered from 0, by best fit decreasing (ties by position), or in the given order."""
    if order is None:
        order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    open_rooms: list[int] = []  # the rooms that some bin has, ascending
    by_room: dict[int, list[int]] = {}
    count = 0

    def put(room: int, where: int) -> None:
        if room:
            if room in by_room:
                by_room[room].append(where)
            else:
                by_room[room] = [where]
                insort(open_rooms, room)

    for i in order.tolist():
        size = int(lengths[i])
        at = bisect_left(open_rooms, size)
        if at == len(open_rooms):
            where, room = count, capacity
            count += 1
        else:
            room = open_rooms[at]
            where = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                open_rooms.pop(at)
        bins[i] = where
        put(room - size, where)
    return bins


def repacked(lengths: np.ndarray, bins: np.ndarray, capacity: int = CAPACITY, attempts: int = ATTEMPTS) -> np.ndarray:
    """Fewer bins, where that is found, for a part that the bound does not certify and that has nobody to exchange with.

    Each attempt takes the emptiest bins and a changing quarter of the others as a second part, whose documents are packed
    again by best fit in an order that is nearly decreasing. It stays if it needs no more bins, and
    attempts end as soon as the bound is met. The same part gives the same bins in every run.
    """
    count, bound = int(bins.max()) + 1, lower_bound(lengths, capacity)
    for attempt in range(attempts):
        if count <= bound:
            break
        rng = np.random.default_rng(attempt)
        fill = np.bincount(bins, lengths, count)
        taken = rng.random(count) < 0.25
        taken[np.argsort(fill, kind="stable")[: max(2, count >> 1 + attempt % 4)]] = True
        items = np.flatnonzero(taken[bins])
        nearly = lengths[items] * (1 + (rng.random(len(items)) - 0.5) * (0.02, 0.05, 0.1, 0.2)[attempt % 4])
        again = best_fit(lengths[items], capacity, np.argsort(-nearly, kind="stable"))
        if again.max() < taken.sum():
            left = ~taken
            bins = (np.cumsum(left) - 1)[bins]
            bins[items] = again + left.sum()
            count = int(bins.max()) + 1
    return bins


def _round(rows: DataFrame, parts: int, number: int, last: bool, capacity: int) -> DataFrame:
    """Pack each part; ``final`` rows have a sequence, the others go on.

    The deal is by a hash that changes from round to round, so parts with gaps exchange rows.
    """

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        lengths = group["length"].to_numpy(np.int64)
        bins = best_fit(lengths, capacity)
        if last:
            bins = repacked(lengths, bins, capacity)
        count = int(bins.max()) + 1
        fill = np.bincount(bins, lengths, count).astype(np.int64)
        certified = count <= lower_bound(lengths, capacity)
        done = np.full(count, True) if certified or last else fill == capacity
        if not last and fill.min() < capacity:
            done[fill.argmin()] = False  # what a part has left over may fit into those of others
        by_bin = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[by_bin])
        starts = ends - lengths[by_bin]
        first = np.r_[0, np.flatnonzero(np.diff(bins[by_bin])) + 1]
        offset = np.empty(len(bins), np.int64)
        offset[by_bin] = starts - np.repeat(starts[first], np.diff(np.r_[first, len(bins)]))
        sequence = (number << 58) + (group["part"].to_numpy(np.int64) << 26) + bins
        return pd.DataFrame(
            {"row": group["row"], "length": lengths, "final": done[bins], "certified": certified,
             "sequence_id": sequence, "offset": offset}
        )

    dealt = rows.select("row", "length", F.expr(f"pmod(xxhash64(row, {number}), {parts})").alias("part"))
    return dealt.groupBy("part").applyInPandas(
        pack, "row long, length long, final boolean, certified boolean, sequence_id long, offset long"
    )


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    rounds: int = ROUNDS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``, ``certified``.

    Documents are encoded, closed by the end id, and cut only where longer than a sequence. A full piece
    is a sequence of its own; the others are packed in at most ``rounds`` rounds, each over what the one before left in
    parts with gaps. ``certified`` tells whether the part that placed the piece has the least possible number of bins; one that has
    not, and has nobody left to exchange with, was packed again ``ATTEMPTS`` times. Null texts are empty: a piece of the end id alone. Repeated rows are packed
    like any other. Other columns are ignored; an empty table gives no rows.
    """
    numbered = stored(
        pieces(docs, tokenizer_file, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces"
    )
    full = numbered.filter(F.col("length") == capacity).selectExpr(
        "row", "shiftleft(1L, 62) + row AS sequence_id", "0L AS offset", "true AS certified"
    )
    rest = numbered.filter(F.col("length") < capacity).select("row", "length")
    placed = full
    for number in range(rounds):
        n = rest.count()
        if not n:
            break
        parts = -(-n // part_rows)
        last = number == rounds - 1 or parts == 1
        packed = stored(_round(rest, parts, number, last, capacity), "packed")
        placed = placed.union(packed.filter("final").select("row", "sequence_id", "offset", "certified"))
        rest = packed.filter("NOT final").select("row", "length")
        if last:
            break
    return numbered.join(placed, "row").drop("row")
