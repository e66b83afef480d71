"""Time the named queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; print one JSON line.

Each query is built and run into a sink that discards the rows. ``queries`` holds
the best of the warm runs, ``cold`` the first run, ``rows_per_sec`` the input rows
of the query's largest table by its warm time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tagwright.plans.catalog import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_RUNS = int(os.environ.get("BENCH_WARM_RUNS", "2"))

# Query → its largest input.
HEADLINE = {
    "vocab_clean": "orders",
    "vocab_join": "orders",
    "row_validate": "part",
    "validation_outcomes": "orders",
    "rule_violations": "lineitem",
    "rule_labels": "documents",
    "batch_annotate": "documents",
    "predicted_rows": "documents",
    "response_rows": "labels",
    "response_conformance": "documents",
    "prompt_column": "documents",
    "request_payload": "documents",
    "chat_messages": "conversations",
    "error_recovery": "documents",
    "missing_outputs": "documents",
    "ade": "embeddings",
    "min_ade": "embeddings",
    "vector_series": "embeddings",
    "step_speed": "events",
    "throttle_brake": "events",
    "control_lists": "events",
    "confidence_summary": "labels",
    "csv_roundtrip": "customer",
    "csv_fixed_columns": "customer",
    "one_column": "documents",
    "nonblank_text": "documents",
    "first_n": "documents",
    "kth_row": "documents",
    "any_column_contains": "customer",
    "error_semi": "documents",
    "merge_repaired": "labels",
    "priority_counts": "orders",
    "driving_rows": "lineitem",
    "driving_rule_labels": "documents",
    "long_view": "part",
    "observed_summary": "labels",
    "props_decode": "events",
    "vocab_block": "orders",
    "definition_block": "customer",
    "first_message_override": "conversations",
    "batch_requests": "documents",
    "offline_annotation": "documents",
    "unwrap_trace": "documents",
    "unwrap_samples": "documents",
    "annotation_repair": "documents",
    "status_summary": "documents",
    "incremental_ingest": "conversations",
    "incremental_predict": "documents",
    "rotate_points": "embeddings",
    "ade_uneven": "embeddings",
    "step_speed_cut": "events",
    "control_lists_cut": "events",
    "chat_messages_cut": "conversations",
    "vocab_clean_table": "orders",
    "vocab_fuzzy_join": "conversations",
    "driving_rule_table": "documents",
    "word_rule_table": "documents",
    "schema_conformance": "documents",
    "nested_schema": "documents",
    "vocab_pieces": "customer",
    "definition_pieces": "documents",
    "stream_annotate": "documents",
    "merge_in_parts": "labels",
    "growing_summary": "labels",
    "arriving_outputs": "documents",
    "growing_series": "events",
}


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or list(HEADLINE)
    cold, warm, speed = {}, {}, {}
    for name in chosen:
        cold[name] = round(run(spark, name), 3)
        warm[name] = round(min(run(spark, name) for _ in range(WARM_RUNS)), 3)
        rows = spark.read.parquet(f"{FOLDER}/{HEADLINE.get(name, 'lineitem')}.parquet").count()
        speed[name] = int(rows / warm[name])
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "rows_per_sec": speed,
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "partitions": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
