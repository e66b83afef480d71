"""Retries between micro-batches, and the bound on open calls."""

import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagwright.operators import annotate as an
from tagwright.plans.catalog_streams import _failing_caller, _in_files
from tagwright.streaming.retries import annotate_new_files

VOCABULARY = {"lang": ["en", "de", "none"]}
DOCS = "doc_id long, lang string, text string"


def rows_of(df):
    return sorted(df.collect(), key=repr)


def test_three_batches_give_the_batch_result(spark, tmp_path):
    rows = [(i, "en de fr es".split()[i % 4], "x" * (i * 300)) for i in range(24)]
    docs = spark.createDataFrame(rows, DOCS)
    fails, empty = {"de": 1, "es": 3, "fr": 2}, {"en": 1}
    expected = an.annotate(docs.repartition(1), ["doc_id"], _failing_caller(fails, empty), VOCABULARY, sleep=lambda s: None)
    expected = rows_of(expected)
    for part in range(3):
        docs.filter(f"doc_id % 3 = {part}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    how = dict(pause=lambda used: 0.05 * used, max_files=1, every="0 seconds", timeout=240)
    args = (spark, f"{tmp_path}/in", DOCS, f"{tmp_path}/out", f"{tmp_path}/cp", ["doc_id"])
    assert annotate_new_files(*args, _failing_caller(fails, empty), VOCABULARY, **how)
    assert rows_of(spark.read.parquet(f"{tmp_path}/out")) == expected
    assert {r.status for r in expected} == {"ok", "failed"} and {r.attempts for r in expected} == {2, 3}
    # Nothing new: nothing is asked, nothing added.
    assert annotate_new_files(*args, lambda row: 1 / 0, VOCABULARY, **how)
    assert rows_of(spark.read.parquet(f"{tmp_path}/out")) == expected


def test_no_task_writes_a_whole_part(spark, tmp_path):
    """Every task writes its own rows, so that no task reads the whole table; the parts are a third of the files each."""
    rows = spark.range(0, 800, 1, 8)
    path, files = _in_files(rows, str(tmp_path), 3)
    assert files == 8
    got = spark.read.parquet(path)
    assert len(got.inputFiles()) == 24 and rows_of(got) == rows_of(rows)
    assert got.groupBy(F.input_file_name().alias("file")).agg((F.max("id") - F.min("id")).alias("of")).filter("of >= 100").isEmpty()


def test_a_run_that_was_cut_off_goes_on_with_its_attempts(spark, tmp_path):
    """The first run ends while rows wait for their pause; the second asks them once more only."""
    docs = spark.createDataFrame([(1, "en", "a"), (2, "de", "b"), (2, "de", "b"), (2, "de", "c")], DOCS)
    docs.coalesce(1).write.parquet(f"{tmp_path}/in")
    calls = tmp_path / "calls"
    calls.mkdir()

    def answer(row):
        with (calls / row["text"]).open("a") as f:
            f.write("x")
        if row["lang"] == "de" and not (Path(calls) / "open").exists():
            raise ConnectionError("closed")
        return {"rows": [{"lang": row["lang"]}]}

    args = (spark, f"{tmp_path}/in", DOCS, f"{tmp_path}/out", f"{tmp_path}/cp", ["doc_id"], answer, VOCABULARY)
    assert not annotate_new_files(*args, pause=lambda used: 30.0, every="0 seconds", timeout=25)
    assert [r.doc_id for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [1]
    assert (calls / "b").read_text() == "xx"  # repeated rows are asked each
    (calls / "open").write_text("x")
    assert annotate_new_files(*args, pause=lambda used: 30.0, every="0 seconds", timeout=240)
    got = rows_of(spark.read.parquet(f"{tmp_path}/out").select("doc_id", "lang", "attempts", "status"))
    assert [tuple(r) for r in got] == [(1, "en", 1, "ok")] + [(2, "de", 2, "ok")] * 3
    assert (calls / "a").read_text() == "x" and (calls / "c").read_text() == "xx"


def test_a_run_that_ended_between_batches_goes_on(spark, tmp_path):
    """No batch is left to repeat and no file is new: the waiting rows are asked again all the same, and then nothing is open."""
    docs = spark.createDataFrame([(1, "en", "a"), (2, "de", "b"), (2, "de", "b")], DOCS)
    docs.coalesce(1).write.parquet(f"{tmp_path}/in")

    def answer(row):
        if row["lang"] == "de" and not (Path(tmp_path) / "open").exists():
            raise ConnectionError("closed")
        return {"rows": [{"lang": row["lang"]}]}

    args = (spark, f"{tmp_path}/in", DOCS, f"{tmp_path}/out", f"{tmp_path}/cp", ["doc_id"], answer, VOCABULARY)
    how = dict(pause=lambda used: 1.0)
    assert not annotate_new_files(*args, **how, every="1 day", timeout=25)  # one batch; the next is not due
    (tmp_path / "open").write_text("x")
    assert annotate_new_files(*args, **how, every="0 seconds", timeout=120)
    expected = [(1, "en", 1, "ok")] + [(2, "de", 2, "ok")] * 2
    assert [tuple(r) for r in rows_of(spark.read.parquet(f"{tmp_path}/out").select("doc_id", "lang", "attempts", "status"))] == expected
    # Nothing is open: a run of one batch finds that out.
    assert annotate_new_files(*args, **how, every="1 day", timeout=120)
    assert [tuple(r) for r in rows_of(spark.read.parquet(f"{tmp_path}/out").select("doc_id", "lang", "attempts", "status"))] == expected


def test_never_more_open_calls_than_allowed(spark, tmp_path):
    """Two threads in each of two barrier tasks, while another job keeps the cores busy."""
    marks = str(tmp_path)

    def answer(row):
        mark = Path(marks) / f"open-{row['id']}"
        mark.write_text("x")
        seen = len(list(Path(marks).glob("open-*")))
        time.sleep(0.05)
        mark.unlink()
        return {"rows": [{"lang": str(seen)}]}

    stop = threading.Event()

    def busy():
        while not stop.is_set():
            spark.range(200_000).repartition(3).agg(F.sum("id")).collect()

    other = threading.Thread(target=busy)
    other.start()
    try:
        rows = an.annotate(spark.range(60), ["id"], answer, VOCABULARY, calls=4, concurrency=2).collect()
    finally:
        stop.set()
        other.join()
    assert len(rows) == 60
    assert 1 < max(int(r.lang) for r in rows) <= 4


def test_bounds_that_do_not_fit_are_refused(spark):
    for how in ({"calls": 5, "concurrency": 2}, {"calls": 4, "partitions": 2}):
        with pytest.raises(ValueError):
            an.annotate(spark.range(1), ["id"], lambda row: {}, VOCABULARY, **how)
