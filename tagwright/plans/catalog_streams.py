"""Named queries over tables that grow file by file."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagwright.operators import quality as qa
from tagwright.plans.catalog import DOCUMENT_VOCABULARY, SQL, event_steps, query, rated_labels, table
from tagwright.sources import parts as pt
from tagwright.sources.shared import shared_folder
from tagwright.streaming import arrivals as ar
from tagwright.streaming import counts as ct
from tagwright.streaming import retries as rt
from tagwright.streaming import series as se


def _arrive(df, path: str) -> int:
    """Append the rows in as many files as Spark has tasks for them, and tell how many files are there now."""
    df.write.mode("append").parquet(path)
    return len(df.sparkSession.read.schema(df.schema).parquet(path).inputFiles())


def _in_files(df, base: str, n: int) -> tuple[str, int]:
    """The rows in ``n`` parts, one after another in time, and the files a part has; every row is in one."""
    path = f"{base}/input"
    files = [_arrive(df.filter(f"pmod(xxhash64(*), {n}) = {i}"), path) for i in range(n)]
    return path, -(-files[-1] // n)


def _failing_caller(fails: dict[str, int], empty: dict[str, int]):
    """Knows its calls by files, as state goes from task to task: the first ones fail, or answer nothing, for some languages."""
    import tempfile
    from pathlib import Path

    seen = Path(tempfile.mkdtemp(prefix="calls-"))

    def answer(row: dict) -> dict:
        mark = seen / str(row["doc_id"])
        call = len(mark.read_text()) + 1 if mark.exists() else 1
        mark.write_text("x" * call)
        lang = row["lang"]
        if call <= fails.get(lang, 0):
            raise ConnectionError("no answer")
        if call <= fails.get(lang, 0) + empty.get(lang, 0):
            return {"rows": []}
        size = "long" if len(row["text"]) > 2000 else "Shor"
        return {"rows": [{"lang": lang.upper(), "size": size, "confidence": "high"}]}

    return answer


@query(SQL["batch_annotate"])
def stream_annotate(spark, folder):
    """``batch_annotate`` over files that come in three parts: failed rows wait as state and are asked again in later batches."""
    base = shared_folder(spark, "stream_annotate")
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    source, files = _in_files(docs, base, 3)
    answer = _failing_caller({"de": 1, "es": 3}, {"fr": 2})
    rt.annotate_new_files(
        spark, source, docs.schema, f"{base}/answers", f"{base}/progress", ["doc_id"], answer, DOCUMENT_VOCABULARY,
        pause=lambda used: 0.2 * used, max_files=files, every="0 seconds",
    )
    return spark.read.parquet(f"{base}/answers").drop("error")


@query(SQL["merge_repaired"])
def merge_in_parts(spark, folder):
    """``merge_repaired`` on a table in parts; repaired in two rounds, and the second round twice."""
    path = f"{shared_folder(spark, 'merge_in_parts')}/table"
    labels = table(spark, folder, "labels")
    pt.write_parts(labels, path, "doc_id", 64)
    fixed = labels.filter("toxic = 1").select("doc_id", (F.col("quality") + 10).alias("quality"), F.lit(0).alias("toxic"))
    for some in ("doc_id % 2 = 0", "doc_id % 2 = 1", "doc_id % 2 = 1"):
        pt.merge_parts(spark, path, fixed.filter(some), "doc_id", 64)
    return pt.read_parts(spark, path)


@query(SQL["confidence_summary"])
def growing_summary(spark, folder):
    """``confidence_summary`` of a table that comes in four parts, counted in two runs; no file is read twice."""
    base = shared_folder(spark, "growing_summary")
    rated = rated_labels(spark, folder)
    for run in range(2):
        for part in (2 * run, 2 * run + 1):
            files = _arrive(rated.filter(f"pmod(xxhash64(*), 4) = {part}"), f"{base}/input")
        ct.count_new_files(
            spark, f"{base}/input", rated.schema, f"{base}/counts", f"{base}/progress", qa.summary_columns("state"),
            max_files=-(-files // (2 * run + 2)),
        )
    return ct.totals(spark, f"{base}/counts")


@query(SQL["missing_outputs"])
def arriving_outputs(spark, folder):
    """``missing_outputs`` over three parts of documents and of labels; two last ones of each carry only later times."""
    base = shared_folder(spark, "arriving_outputs")
    when = "timestamp_seconds(86400 + doc_id * 60{}) AS at"
    docs = table(spark, folder, "documents").selectExpr("doc_id", "lang", "n_chars", when.format(""))
    labels = table(spark, folder, "labels").selectExpr("doc_id", when.format(" + 20"))
    end = docs.agg(F.max("doc_id")).first()[0] + 1
    for part in range(5):
        bounds = f"doc_id >= {end} * {part} div 3 AND doc_id < {end} * ({part} + 1) div 3"
        for df, name in ((docs, "docs"), (labels, "labels")):
            some = df.filter(bounds) if part < 3 else df.limit(1).selectExpr(
                *["-1L AS doc_id" if c == "doc_id" else f"timestamp_seconds({end} * 60 + 86400 * {part}) AS at" if c == "at" else c for c in df.columns]
            )
            _arrive(some, f"{base}/{name}")
        ar.missing_new_files(
            spark, f"{base}/docs", docs.schema, f"{base}/labels", labels.schema, f"{base}/missing", f"{base}/progress",
            "doc_id", "at", "30 seconds",
        )
    return spark.read.parquet(f"{base}/missing").filter("doc_id >= 0").drop("at")


@query(SQL["step_speed"])
def growing_series(spark, folder):
    """``step_speed`` of events that come in three parts, in two runs; each batch reads only new events and two steps a user."""
    base = shared_folder(spark, "growing_series")
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "value")
    first, third = (events.agg(F.expr(f"percentile_approx(ts, {q})")).first()[0] for q in (0.3, 0.7))
    for i, some in enumerate((F.col("ts") < first, (F.col("ts") >= first) & (F.col("ts") < third), F.col("ts") >= third)):
        # A part has each user's events in one file, so that batches of any files keep a user's order.
        arrived = _arrive(events.filter(some).repartition("user_id"), f"{base}/input")
        if not i:
            files = arrived
        else:
            se.add_new_files(
                spark, f"{base}/input", events.schema, f"{base}/steps", f"{base}/progress", ["user_id"], ["ts", "event_id"], ["value"],
                max_files=files,
            )
    return event_steps(se.series(spark, f"{base}/steps"))
