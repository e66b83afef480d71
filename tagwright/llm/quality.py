"""Quality by compression: dictionaries of good and of bad text, and which of them shortens a text more.

Two zstandard dictionaries are trained, on labelled rows of either kind. A text is compressed with each and with
neither; the size with the bad dictionary less that with the good one, normalised by the text's
length and by the compressed size, is what tells them apart. A logistic fit on other labelled rows turns
it into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import as_bytes, text_or_empty

#: Labelled rows per label that a dictionary is trained on, and the characters taken of each, in pieces
#: spread evenly over the whole text: what the driver holds.
DICTIONARY_ROWS = 1500
EXCERPT, PIECES = 4000, 4
DICTIONARY_BYTES = 64 << 10
#: Other labelled rows per label that the probability is fitted on; only their sizes reach the driver.
CALIBRATION_ROWS = 4000
LEVEL = 3
ACCEPTED = 0.3
FOLDS = 5

_PAD = 32
_SHARES = 1_000_003


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b" ".join(samples)[:DICTIONARY_BYTES] or b" "


def measurer(dictionaries: tuple[bytes, bytes]):
    """Text → its normalised size differences, and how short it gets at all."""

    def compressor(data: bytes | None):
        own = zstandard.ZstdCompressionDict(data) if data else None
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    bad, good, none = (compressor(d) for d in (*dictionaries, None))

    def measure(text: bytes) -> tuple[float, ...]:
        n, b, g, p = len(text) + _PAD, len(bad.compress(text)), len(good.compress(text)), len(none.compress(text))
        return ((b - g) / n, (b - g) / (max(b, g) + _PAD), g / n, p / n)

    return measure


def _terms(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / spread, -4, 4)
    return np.hstack([np.ones((len(z), 1)), z, z**2, z[:, :1] * z[:, 2:3], z[:, 1:2] * z[:, 3:4]])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge, which keeps separable samples finite."""
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-3 * weight.sum())
    ridge[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * beta
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _measured(rows: DataFrame, dictionaries: tuple[bytes, bytes], keep: str) -> DataFrame:
    """The column ``keep`` and the four measures of ``text``."""

    def work(batches):
        measure = measurer(dictionaries)
        for batch in batches:
            columns = list(zip(*map(measure, as_bytes(batch.column(1))))) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.float64()) for c in columns]], [keep, "m0", "m1", "m2", "m3"]
            )

    kind = rows.schema[keep].dataType.simpleString()
    return rows.select(keep, "text").mapInArrow(work, f"{keep} {kind}, m0 double, m1 double, m2 double, m3 double")


def held_out(doc_id: str = "doc_id") -> str:
    """SQL: the row is in the fold that nothing is learnt from."""
    return f"crc32(CAST(coalesce(CAST({doc_id} AS string), '') AS binary)) % {FOLDS} = 0"


def fit(
    docs: DataFrame,
    labels: DataFrame,
    target: str = "quality",
    dictionary_rows: int = DICTIONARY_ROWS,
    calibration_rows: int = CALIBRATION_ROWS,
    excerpt: int = EXCERPT,
) -> dict:
    """Dictionaries and probability from labelled rows outside the held-out fold.

    doc_ids are chosen by hash, up to ``dictionary_rows`` and ``calibration_rows`` per label, and each gives one row, of
    several that with the least hash of the text; the shares of the labels among all labelled rows weigh them.
    A dictionary sees ``excerpt`` characters of a text, in pieces from its beginning to its end. Without
    rows of both labels the score is the share of label 1, or a half without any. Of several labels of a doc_id the
    greater counts. Labels that are null or have no document are ignored.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(target).cast("int").alias("y"))
        .filter(f"y IN (0, 1) AND id IS NOT NULL AND NOT {held_out('id')}")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    share = dict(known.groupBy("y").count().collect())
    if not share:
        return {"prior": 0.5}
    prior = share.get(1, 0) / sum(share.values())
    if len(share) < 2:
        return {"prior": prior}

    most = dictionary_rows + calibration_rows
    chosen = []
    for y in (0, 1):
        # A share of the hashes that holds some more than are wanted: no task sends candidates for more.
        cut = min(_SHARES, int(_SHARES * (1.2 * most + 100) / share[y]) + 1)
        some = known.filter(f"y = {y} AND pmod(xxhash64(id), {_SHARES}) < {cut}")
        chosen += some.orderBy(F.xxhash64("id"), "id").limit(most).collect()
    seen = {0: 0, 1: 0}
    dealt = []
    for r in chosen:
        # The two uses alternate, so that a few labels serve both.
        k = seen[r.y]
        seen[r.y] += 1
        train = k % 2 == 0 and k < 2 * dictionary_rows
        dealt.append((r.id, r.y, train))
    # At most ``most`` rows per label, whatever the tables.
    ids = docs.sparkSession.createDataFrame(
        dealt, f"id {known.schema['id'].dataType.simpleString()}, y int, train boolean"
    )
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), F.expr("doc_id = id"))
    piece = excerpt // PIECES
    parts = ", ".join(f"substring(text, 1 + CAST(floor((length(text) - {piece}) * {k}D / {PIECES - 1}) AS INT), {piece})" for k in range(PIECES))
    spread = F.expr(f"encode(IF(length(text) > {excerpt}, concat({parts}), text), 'UTF-8')")
    # Both lists have one entry for each chosen doc_id at most.
    excerpts = rows.filter("train").select("doc_id", "y", F.xxhash64("text").alias("h"), spread.alias("b"))
    by = {0: [], 1: []}
    for y, b in sorted((r.y, bytes(r.m.b)) for r in excerpts.groupBy("doc_id", "y").agg(F.min(F.struct("h", "b")).alias("m")).collect()):
        by[y].append(b)
    dictionaries = (_dictionary(by[0]), _dictionary(by[1]))
    measured = _measured(
        rows.filter("NOT train").select(F.struct("doc_id", "y", F.xxhash64("text").alias("h")).alias("of"), "text"), dictionaries, "of"
    )
    one = measured.groupBy("of.doc_id", "of.y").agg(F.min(F.struct("of.h", "m0", "m1", "m2", "m3")).alias("m"))
    sizes = one.select("y", "m.m0", "m.m1", "m.m2", "m.m3").collect()
    if len({r[0] for r in sizes}) < 2:
        return {"prior": prior}
    data = np.array(sorted(map(tuple, sizes)), float)
    y, x = data[:, 0], data[:, 1:]
    weight = np.where(y == 1, prior / (y == 1).mean(), (1 - prior) / (y == 0).mean())
    mean = x.mean(axis=0)
    spread = x.std(axis=0) + 1e-9
    beta = _logistic(_terms(x, mean, spread), y, weight)
    return {"prior": prior, "dictionaries": dictionaries, "mean": mean, "spread": spread, "beta": beta}


def probabilities(x: np.ndarray, model: dict) -> np.ndarray:
    z = _terms(x, model["mean"], model["spread"]) @ model["beta"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """The columns of ``docs`` as ``c0``, ``c1`` and so on, and ``score``; whole texts, one pass, no shuffle."""
    column = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]
    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema))

    def work(batches):
        measure = measurer(model["dictionaries"]) if "beta" in model else None
        for batch in batches:
            texts = as_bytes(batch.column(column).cast(pa.string()))
            if measure is None or not texts:
                p = np.full(len(texts), model["prior"])
            else:
                p = probabilities(np.array([measure(t) for t in texts]), model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*names, "score"])

    return docs.toDF(*names).mapInArrow(work, f"{fields}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Only the text is an input of the score. Null and empty texts are scored as the empty text. Rows stand
    alone: repeated rows and doc_ids give repeated results, other columns are ignored, an empty table
    gives no rows. A null doc_id is hashed as the empty text.
    """
    model = fit(docs, labels)
    rows = scored(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    return rows.selectExpr(
        "c0 AS doc_id",
        f"{held_out('c0')} AS held_out",
        "score",
        f"IF(score >= {ACCEPTED}, 1, 0) AS predicted",
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose score is at least ``ACCEPTED``, with all their columns."""
    model = fit(docs, labels)
    good = scored(docs, model).filter(F.col("score") >= ACCEPTED)
    return good.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
