"""Annotation of a growing folder, with retries that wait between micro-batches instead of in a task."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tagwright.operators.annotate import annotation_results, annotation_values, answered_rows
from tagwright.operators.responses import mark_failed
from tagwright.vocabulary import VOCABULARY

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Retrying(StatefulProcessor):
    """Per distinct input row: the attempts used, the last error, and a timer for the next attempt.

    A new row is asked at once. After an error it waits ``pause`` of the attempts used (2, 4, … seconds); an
    empty answer is tried again at once. What is out of attempts leaves as failed.
    """

    def __init__(self, inputs: T.StructType, keys, answer, vocab, attempts: int, pause: Callable[[int], float]):
        self.inputs, self.keys, self.answer, self.vocab = inputs, list(keys), answer, vocab
        self.attempts, self.pause = attempts, pause

    def init(self, handle) -> None:
        self.handle = handle
        more = [T.StructField("__used", T.IntegerType()), T.StructField("__due", T.LongType())]
        self.waiting = handle.getListState("waiting", T.StructType([*self.inputs, *more]))

    def _ask(self, row: dict, used: int) -> tuple[list[Row], int]:
        """Result rows if the row is done, and the attempts used so far."""
        error, found = None, []
        while used < self.attempts:
            used += 1
            try:
                found = answered_rows(self.answer(row), self.vocab)
                if found:
                    break
                error = "no rows"
            except Exception as failure:
                error = str(failure)
                if used < self.attempts:
                    return [], used
        key = [row[k] for k in self.keys]
        state = [used, "ok" if found else "failed", None if found else error]
        result = Row(*self.keys, *annotation_results(self.vocab).names)
        return [result(*key, *annotation_values(r, self.vocab), *state) for r in found or [{}]], used

    def _step(self, rows: Iterator[tuple[dict, int]], now: int) -> Iterator[Row]:
        for row, used in rows:
            done, used = self._ask(row, used)
            if done:
                yield from done
                continue
            due = now + int(self.pause(used) * 1000)
            self.waiting.appendValue((*[row[f] for f in self.inputs.names], used, due))
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues):
        names = self.inputs.names
        return self._step((({n: r[n] for n in names}, 0) for r in rows), timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, names = timerValues.getCurrentProcessingTimeInMs(), self.inputs.names
        held = list(self.waiting.get())
        self.waiting.clear()
        for r in held:
            if r[-1] > expiredTimerInfo.getExpiryTimeInMs():
                self.waiting.appendValue(tuple(r))
        due = [r for r in held if r[-1] <= expiredTimerInfo.getExpiryTimeInMs()]
        return self._step(((dict(zip(names, r)), r[-2]) for r in due), now)

    def close(self) -> None:
        pass


def annotate_stream(
    stream: DataFrame,
    keys: list[str],
    answer: Callable[[dict], Mapping | str],
    vocab: dict[str, list[str]] = VOCABULARY,
    attempts: int = 3,
    pause: Callable[[int], float] = lambda used: 2.0**used,
) -> DataFrame:
    """``annotate`` of a stream: ``(keys, fields…, attempts, status, error)``, one batch after another.

    No task sleeps: a row that failed is kept as state with a processing-time timer, and other rows go on. State is
    per distinct input row, by hash, so a key with very many rows is spread. The session needs the RocksDB state store.
    A batch that is run again after a failure calls again, so ``answer`` must be safe to repeat.
    """
    inputs = stream.schema
    result = T.StructType([*[inputs[k] for k in keys], *annotation_results(vocab)])
    grouped = stream.withColumn("__row", F.xxhash64(*[F.col(f"`{c}`") for c in stream.columns])).groupBy("__row")
    out = grouped.transformWithState(
        Retrying(inputs, keys, answer, vocab, attempts, pause), result, "append", "processingTime"
    )
    return mark_failed(out, F.col("status") == "failed", attempts, vocab)


def annotate_new_files(
    spark: SparkSession,
    source: str,
    schema: str | T.StructType,
    target: str,
    checkpoint: str,
    keys: list[str],
    answer: Callable[[dict], Mapping | str],
    vocab: dict[str, list[str]] = VOCABULARY,
    attempts: int = 3,
    pause: Callable[[int], float] = lambda used: 2.0**used,
    max_files: int | None = None,
    every: str = "1 second",
    timeout: float = 3600.0,
) -> bool:
    """Annotate every file of ``source`` not yet seen, with retries, and append to ``target``; stop when nothing is open.

    Progress and waiting rows are kept in ``checkpoint``: a run that was cut off goes on where it stopped, pauses included, whether or not
    a file is new. Returns False if ``timeout`` seconds passed first. A checkpoint made before the stream had its ticks
    is refused by Spark.
    """
    former = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, _ROCKS)
    try:
        reader = spark.readStream.schema(schema)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        rows = annotate_stream(_ticking(spark, reader.parquet(source)), keys, answer, vocab, attempts, pause)
        query = (
            rows.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=every)
            .start()
        )
    finally:
        spark.conf.set(_STATE_STORE, former)
    try:
        return _drained(query, timeout)
    finally:
        query.stop()


def _ticking(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The same rows, in a stream that always has a next batch.

    A query that starts again runs no batch until a source has something new, even if timers wait in its state.
    """
    ticks = spark.readStream.format("rate-micro-batch").options(rowsPerBatch=1, numPartitions=1).load().filter("value < 0")
    return files.union(ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in files.schema]))


def _drained(query, timeout: float) -> bool:
    """Wait for a batch without new files that leaves no row waiting."""
    end = time.time() + timeout
    while time.time() < end:
        if query.exception() is not None:
            raise query.exception()
        last = query.lastProgress
        if last and last["stateOperators"] and last["sources"][0]["startOffset"] == last["sources"][0]["endOffset"]:
            if last["batchId"] >= 0 and sum(s["numRowsTotal"] for s in last["stateOperators"]) == 0:
                return True
        time.sleep(0.2)
    return False
