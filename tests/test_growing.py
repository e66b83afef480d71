"""Merges that touch few parts, counts by batch, inputs without outputs as they arrive."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tagwright.operators import quality as qa
from tagwright.operators.recover import merge_repaired
from tagwright.sources import parts as pt
from tagwright.streaming import arrivals as ar
from tagwright.streaming import counts as ct


def rows_of(df):
    return sorted(df.collect(), key=repr)


@pytest.fixture
def base(spark):
    rows = [(i % 40, f"v{i}") for i in range(300)] + [(7, "hot")] * 200 + [(None, "no key")] * 3
    return spark.createDataFrame(rows, "id long, value string").repartition(5)


def test_merging_parts_equals_merging_everything(spark, tmp_path, base):
    path = f"{tmp_path}/table"
    pt.write_parts(base, path, "id", 16)
    assert rows_of(pt.read_parts(spark, path)) == rows_of(base)
    fixed = spark.createDataFrame([(7, "new"), (7, "newer"), (9, "nine"), (99, "added"), (None, "none either")], "id long, value string")
    expected = rows_of(merge_repaired(base, fixed, "id"))
    assert 0 < pt.merge_parts(spark, path, fixed.select("value", "id"), "id", 16) < 5
    assert rows_of(pt.read_parts(spark, path)) == expected
    # Keys that are merged again are replaced by the same rows; those without a key are added, as by merge_repaired.
    pt.merge_parts(spark, path, fixed.filter("id IS NOT NULL"), "id", 16)
    assert rows_of(pt.read_parts(spark, path)) == expected
    assert pt.merge_parts(spark, path, fixed.limit(0), "id", 16) == 0


def test_other_parts_are_neither_read_nor_written(spark, tmp_path, base):
    path = f"{tmp_path}/table"
    pt.write_parts(base, path, "id", 16)
    part = spark.range(1).selectExpr("CAST(pmod(xxhash64(9L), 16) AS INT) AS p").first().p
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/__part=*/*.parquet")}
    before = files()
    assert pt.merge_parts(spark, path, spark.createDataFrame([(9, "nine")], "id long, value string"), "id", 16) == 1
    after = files()
    assert {f for f in before if before[f] == after.get(f)} == {f for f in before if f"__part={part}/" not in f}
    assert rows_of(pt.read_parts(spark, path).filter("id = 9").select("id", "value")) == [(9, "nine")]
    plan = spark.read.parquet(path).filter(F.col("__part").isin([part]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"(__part#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_counts_of_batches_add_up_and_a_replayed_batch_changes_nothing(spark, tmp_path):
    rows = [("high" if i % 3 else "odd", "PARSE_ERROR" if i % 10 == 0 else "x") for i in range(100)]
    df = spark.createDataFrame(rows, "confidence string, state string")
    columns, schema = qa.summary_columns("state"), df.schema
    args = (spark, f"{tmp_path}/in", schema, f"{tmp_path}/counts", f"{tmp_path}/cp", columns)
    for part in df.randomSplit([1.0, 1.0, 1.0], 3):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        assert ct.count_new_files(*args, max_files=1)
        assert ct.count_new_files(*args, max_files=1)
    seen = spark.read.parquet(f"{tmp_path}/in")
    assert ct.totals(spark, f"{tmp_path}/counts").collect() == qa.summary(df, "state").collect()
    ct.write_partial(seen.limit(0), 0, f"{tmp_path}/other", [], columns)
    ct.write_partial(seen, 0, f"{tmp_path}/other", [], columns)
    ct.write_partial(seen, 0, f"{tmp_path}/other", [], columns)
    assert ct.totals(spark, f"{tmp_path}/other").collect() == qa.summary(df, "state").collect()


def test_grouped_counts(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, n long")
    for batch, some in enumerate(("n < 3", "n >= 3")):
        ct.write_partial(df.filter(some), batch, f"{tmp_path}/c", ["k"], [F.count("*").alias("rows"), F.sum("n").alias("n")])
    assert rows_of(ct.totals(spark, f"{tmp_path}/c", ["k"])) == [("a", 2, 5), ("b", 1, 2), (None, 1, 3)]


def test_each_missing_input_is_told_once(spark, tmp_path):
    at = "timestamp_seconds(1000 + {}) AS at"

    def put(name, ids, second):
        rows = spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id", at.format(second))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        return rows.schema

    def run():
        assert ar.missing_new_files(
            spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", schema, f"{tmp_path}/missing", f"{tmp_path}/cp", "id", "at", "10 seconds"
        )
        return sorted(r.id for r in spark.read.parquet(f"{tmp_path}/missing").filter("id > 0").collect())

    schema = put("in", [1, 2, 3], 0)
    put("out", [2, 2], 5)
    assert run() == []
    # Input 4 is answered; an answer to 3 comes too late.
    put("in", [4], 30)
    put("out", [4, 3], 31)
    run()
    for later in (90, 120):
        put("in", [0], later)
        put("out", [0], later)
        run()
    assert run() == [1, 3]
