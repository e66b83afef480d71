"""Rows, recovery, quality rules, files, incremental runs and the whole annotation run."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tagwright.functions.text import samples, unwrapped
from tagwright.operators import quality as qa
from tagwright.operators import recover as rc
from tagwright.operators import rows as rw
from tagwright.operators import skew
from tagwright.operators import trajectory as tr
from tagwright.operators import validate as va
from tagwright.plans.annotation import Annotation
from tagwright.sources import files
from tagwright.sources.shared import removed_after, shared_folder
from tagwright.streaming.ingest import process_new_files
from tagwright.vocabulary import FAILED, GROUPS, VOCABULARY, response_fields


def sample_rows(spark, *changes):
    """Annotated rows: every field ``none`` but for the changes."""
    base = {f: "none" for f in VOCABULARY} | {"confidence": "high", "confidence_notes": ""}
    columns = ["clip_id", *response_fields()]
    return spark.createDataFrame(
        [tuple((base | c).get(k) for k in columns) for c in changes],
        ", ".join(f"{c} string" for c in columns),
    )


# ---- rows -------------------------------------------------------------------


def test_blank_texts_go(spark):
    df = spark.createDataFrame([("a",), (" 　\t\n",), ("",), (None,), (" b ",)], "t string")
    assert [r.t for r in rw.non_blank(df, "t").collect()] == ["a", " b "]


def test_first_rows_and_row_at(spark):
    df = spark.range(10).orderBy(F.desc("id"))
    assert [r.id for r in rw.first_rows(df, "id", 3).collect()] == [0, 1, 2]
    assert rw.first_rows(df, "id", None).count() == 10
    assert [r.id for r in rw.row_at(df, "id", 4).collect()] == [4]
    assert rw.row_at(df, "id", 99).isEmpty()


def test_many_first_rows_are_cut_from_ranges(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 AS id", "id AS `odd name`").repartition(6)
    cut = rw.first_rows(df, "id", 333, few=10)
    assert sorted(r.id for r in cut.collect()) == list(range(333)) and cut.columns == df.columns
    assert [r.id for r in rw.row_at(df, ["id"], 500, few=10).collect()] == [500]
    assert rw.row_at(df, "id", 1000, few=10).isEmpty()


def test_search_in_any_column(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("b", 22, [FAILED]), (FAILED + "x", 3, [])], "s string, n int, `odd name` array<string>"
    )
    assert [r.n for r in rc.failed_rows(df).collect()] == [22, 3]
    assert [r.n for r in rc.failed_rows(df, "2{2}").collect()] == [22]
    assert rc.failed_rows(df, "2{2}", regex=False).isEmpty()
    assert rc.failed_rows(df, FAILED.lower()).isEmpty()


def test_unwrapping(spark):
    cases = {
        "[['Slow down.']]": "Slow down.",
        '[["It\'s red."]]': "It's red.",
        "[['two\nlines']]": "two\nlines",
        "[['']]": "",
        "[[']]": "[[']]",
        "[['a\"]]": "[['a\"]]",
        "plain": "plain",
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.u for r in df.withColumn("u", unwrapped("t")).collect()} == cases


@pytest.mark.parametrize(
    "lists",
    [
        [["a", "b"]], [["a"], ["b"]], [["it's", 'say "x"'], []], [["both ' and \""]], [["tab\tline\nback\\slash\\n"]],
        [["\xa0é\u200b 😀"]], [[""]], [["]], [["]], [["x" * 50_000]], [["a\\"], ["\\'"]],
    ],
)
def test_printed_samples_are_read_back(spark, lists):
    text = str(lists)
    df = spark.createDataFrame([(text,)], "t string").select(unwrapped("t").alias("u"), samples("t").alias("s"))
    row = df.collect()[0]
    assert row.s == lists
    assert row.u == (lists[0][0] if [len(x) for x in lists] == [1] else text)


# ---- recovery ---------------------------------------------------------------


def test_recovery_multiplies_repeats_and_keeps_rows_without_source(spark):
    failed = spark.createDataFrame([("a",), ("a",), ("b",), ("x",), (None,)], "k string")
    source = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "3"), ("c", "4"), (None, "5")], "k string, t string")
    got = sorted(map(repr, map(tuple, rc.recover(failed, source, "k", ["t"]).collect())))
    want = [("a", "1"), ("a", "1"), ("b", "2"), ("b", "3"), ("x", None), (None, None)]
    assert got == sorted(map(repr, want))
    safe = rc.recover(failed, source, "k", ["t"], null_safe=True).filter("k is null").collect()
    assert [r.t for r in safe] == ["5"]
    assert sorted(r.t for r in rc.rows_of(source, failed, "k").collect()) == ["1", "2", "3"]


def test_missing_and_merge(spark):
    base = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "k string, v int")
    fixed = spark.createDataFrame([(10, "a"), (11, "a"), (12, "a"), (13, "new")], "v int, k string")
    assert sorted(r.v for r in rc.missing(base, fixed, "k").collect()) == [3, 4, 5]
    merged = rc.merge_repaired(base, fixed, "k")
    assert sorted(r.v for r in merged.collect()) == [3, 4, 5, 10, 11, 12, 13]
    assert merged.columns == base.columns


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti", "inner"])
def test_spread_join_equals_a_plain_join(spark, how):
    key = F.when(F.col("id") % 3 > 0, 7).when(F.col("id") % 7 > 0, F.col("id"))
    left = spark.range(0, 400, 1, 8).select("id", key.alias("k"))
    right = spark.range(0, 300, 2).select(F.col("id").alias("k")).union(spark.range(7, 8))
    right = right if "semi" in how or "anti" in how else right.withColumn("r", F.col("k") * 2)
    got = skew.spread_join(left, right, "k", how)
    want = left.join(right, "k", how)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("how", ["rows_of", "missing", "ade_arrays", "lookup_values"])
def test_a_hot_left_key_is_split_over_tasks(spark, how):
    """With real thresholds this takes hundreds of megabytes, so they are set low here."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.shuffle.partitions": "8",
    }
    hot = "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k"
    left = spark.range(0, 60000, 1, 8).selectExpr("id", hot, "array(struct(double(id) AS x, 2D AS y)) AS points")
    right = spark.range(0, 60000, 2, 4).selectExpr(hot)
    for name, value in low.items():
        spark.conf.set(name, value)
    try:
        if how == "rows_of":
            out = rc.rows_of(left, right, "k")
        elif how == "missing":
            out = rc.missing(left, right, "k")
        elif how == "lookup_values":
            values = right.selectExpr("'f' AS field", "CAST(k AS STRING) AS value")
            out = va.lookup_values(left.selectExpr("id", "CAST(k AS STRING) AS k"), "k", values, "f")
        else:
            truth = right.groupBy("k").agg(F.array(F.struct(F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))).alias("points"))
            out = tr.min_ade(tr.ade_arrays(left, truth, ["k"]), ["k"])
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in low:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "skew=true" in plan


# ---- quality ----------------------------------------------------------------


def test_rules(spark):
    lane = {"maneuver_lat": "lane_keeping"}
    df = sample_rows(
        spark,
        {"clip_id": "fine", **lane, "agent_type": "car", "lane_relation": "same_lane"},
        {"clip_id": "idle"},
        {"clip_id": "mixed", **lane},
        {"clip_id": "mixed", "maneuver_long": "yield"},
        {"clip_id": "ghost", **lane, "lane_relation": "same_lane", "agent_behavior": "weaving"},
        {"clip_id": "noted", **lane, "confidence_notes": "why"},
        {"clip_id": "level", **lane, "confidence": "sure"},
        {"clip_id": "level", **lane, "confidence": None},
        {"clip_id": "odd", **lane, "agent_type": "pickup,Jet"},
        {"clip_id": "fuzzy", **lane, "agent_type": "police car"},
    )
    got = sorted((r.rule, r.key, r.detail or "") for r in qa.check_rules(df, "clip_id").collect())
    assert got == [
        ("details_without_agent", "ghost", "lane_relation=same_lane,agent_behavior=weaving"),
        ("differing_context", "mixed", ""),
        ("high_with_notes", "noted", "why"),
        ("no_maneuver", "idle", ""),
        ("out_of_vocabulary", "odd", "agent_type=jet"),
        ("out_of_vocabulary", "odd", "agent_type=pickup"),
        ("unknown_confidence", "level", ""),
        ("unknown_confidence", "level", "sure"),
    ]


def test_key_rules_never_sort(spark):
    plan = qa.check_keys(sample_rows(spark, {"clip_id": "a"}), "clip_id")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan


def test_summary_and_observation(spark):
    df = sample_rows(
        spark,
        {"clip_id": "a"},
        {"clip_id": "b", "confidence": "low", "maneuver_lat": FAILED},
        {"clip_id": "c", "confidence": "sure"},
        {"clip_id": "d", "confidence": None},
    )
    want = {"rows": 4, "high": 1, "medium": 0, "low": 1, "other": 2, "errors": 1}
    assert qa.summary(df).collect()[0].asDict() == want
    assert qa.summary(df.limit(0)).collect()[0].asDict() == {k: 0 for k in want}
    seen = Observation("seen")
    qa.observed(df, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == want


# ---- files ------------------------------------------------------------------


def test_csv_round_trip_keeps_quotes_commas_and_spaces(spark, tmp_path):
    rows = [("a", ' say "hi", then '), ("b", "back\\slash"), ("c", "it's, so"), ("d", None), ("e", "none"), ("f", '"')]
    df = spark.createDataFrame(rows, "clip_id string, reasoning_trace string")
    files.write_csv(df, str(tmp_path / "o"))
    back = files.read_csv(spark, str(tmp_path / "o"), required=["clip_id"])
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_of_other_writers(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(
        'clip_id,reasoning_trace,extra\r\n001,"Keep ""distance"", é",1\r\n002,,2\r\n'.encode()
    )
    df = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert [tuple(r) for r in df.collect()] == [("001", 'Keep "distance", é', "1"), ("002", None, "2")]
    with pytest.raises(ValueError, match="available: .*clip_id.*extra"):
        files.read_csv(spark, str(tmp_path / "t.csv"), required=["trace"])
    (tmp_path / "m.csv").write_text('k,t\n1,"two\nlines"\n')
    assert files.read_csv(spark, str(tmp_path / "m.csv"), multi_line=True).collect()[0].t == "two\nlines"


def test_a_schema_that_does_not_fit_the_header_is_refused(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?s)header"):
        files.read_csv(spark, str(tmp_path / "t.csv"), "a string, b string").collect()


def test_fixed_columns_and_lines(spark, tmp_path):
    df = spark.createDataFrame([("x", None)], "b string, c string")
    assert files.with_columns_in_order(df, ["a", "b", "c"]).collect() == [("none", "x", None)]
    files.write_lines(df, "b", str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).collect()] == ["x"]


def test_a_column_scan_reads_one_column(spark, tmp_path):
    spark.range(3).withColumn("other", F.lit("x")).write.parquet(str(tmp_path / "p"))
    plan = files.read_column(spark, str(tmp_path / "p"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_intermediate_tables_go_to_the_folder_of_the_cluster(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(base + "/x-") and one != two


class Session:
    """What the choice of a folder reads of a session."""

    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = {"spark.checkpoint.dir": conf} if conf else {}
        self.sparkContext = self
        self.master = master
        self.getCheckpointDir = lambda: checkpoint


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(master), "x")
    assert shared_folder(Session(master, checkpoint="hdfs://a/b"), "x").startswith("hdfs://a/b/x-")
    assert shared_folder(Session(master, "hdfs://c", "hdfs://a/b"), "x").startswith("hdfs://c/x-")


def test_a_single_machine_may_use_a_local_folder():
    assert os.path.isdir(os.path.dirname(shared_folder(Session("local[2]"), "x")))


def test_folders_are_removed_when_the_caller_is_done(spark):
    df = spark.range(100)
    with removed_after(spark):
        kept = shared_folder(spark, "kept")
        assert rw.first_rows(df, "id", 50, few=10).count() == 50
        df.write.parquet(kept)
        assert os.path.isdir(kept.removeprefix("file://"))
    assert not os.path.isdir(kept.removeprefix("file://"))


def test_null_tokens_of_other_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,score,name\n1,NA,nan\n2,0.5,null\n3,x,Ann\n")
    plain = files.read_csv(spark, str(tmp_path), "id int, score double, name string")
    assert [r.name for r in plain.collect()] == ["nan", "null", "Ann"]
    read = files.read_csv(spark, str(tmp_path), "id int, score double, name string", null_tokens=files.NULL_TOKENS)
    assert [tuple(r) for r in read.collect()] == [(1, None, None), (2, 0.5, None), (3, None, "Ann")]
    assert read.dtypes == [("id", "int"), ("score", "double"), ("name", "string")]


# ---- incremental runs -------------------------------------------------------


def test_only_new_files_are_processed(spark, tmp_path):
    source, target, progress = (str(tmp_path / d) for d in ("in", "out", "progress"))

    def run():
        assert process_new_files(
            spark, source, "id bigint", target, progress, lambda d: d.filter("id <> 3"), 1, 120
        )
        return sorted(r.id for r in spark.read.parquet(target).collect())

    spark.range(0, 5, 1, 2).write.parquet(source)
    assert run() == [0, 1, 2, 4]
    assert run() == [0, 1, 2, 4]
    spark.range(10, 12, 1, 1).write.mode("append").parquet(source)
    assert run() == [0, 1, 2, 4, 10, 11]


# ---- the whole run ----------------------------------------------------------


def test_annotation_run_and_repair(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def answer(broken):
        def of(row):
            (calls / f"{row['clip_id']}-{os.urandom(8).hex()}").touch()
            assert row["reasoning_trace"] in row["prompt"] and "[[" not in row["prompt"]
            if row["clip_id"] in broken:
                raise ConnectionError("down")
            agent = "pickup" if row["clip_id"] == "b" else "Car"
            rows = [{"maneuver_lat": "lane keeping", "agent_type": agent, "confidence": "high"}]
            return {"rows": rows * (2 if row["clip_id"] == "c" else 1)}

        return of

    traces = spark.createDataFrame(
        [(k, f"[['Trace {k}']]") for k in "abcde"] + [("blank", " "), ("null", None)],
        "clip_id string, reasoning_trace string",
    )
    common = {"folder": str(tmp_path), "sleep": lambda s: None, "attempts": 2}
    first = Annotation(answer=answer({"d", "e"}), **common)
    table = first.run(traces, "first")
    assert table.columns == ["clip_id", *response_fields()]
    assert first.summary(table).collect()[0].asDict() == {
        "rows": 6, "high": 3, "medium": 1, "low": 2, "other": 0, "errors": 2,
    }
    b = table.filter("clip_id = 'b'").collect()[0]
    assert b.confidence_notes == "VALIDATION: agent_type: 'pickup' NOT in vocabulary"
    assert (b.maneuver_lat, b.confidence) == ("lane_keeping", "medium")
    assert first.failed_traces(table, traces).count() == 2
    assert len(list(calls.iterdir())) == 3 + 2 * 2

    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        first.repair(table, traces, "first")
    assert table.count() == 6

    second = Annotation(answer=answer({"e"}), **common)
    merged = second.repair(table, traces, "second")
    assert len(list(calls.iterdir())) == 7 + 1 + 2
    assert sorted(r.clip_id for r in merged.collect()) == ["a", "b", "c", "c", "d", "e"]
    assert second.summary(merged).collect()[0].errors == 1
    assert sorted(r.clip_id for r in rc.missing(traces, merged, "clip_id").collect()) == ["blank", "null"]
    assert set(GROUPS["agent"]) <= set(merged.columns)
