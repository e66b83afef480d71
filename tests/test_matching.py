"""Vocabularies and rules as tables give what lists give."""

import random

import pytest
from pyspark.sql import functions as F

from tagwright.functions.text import unwrapped
from tagwright.operators import annotate as an
from tagwright.operators import matching as ma
from tagwright.operators import rules as ru
from tagwright.operators import validate as va
from tagwright.vocabulary import VOCABULARY, vocabulary_table


def table_of(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "position long, value string")


def cells_for(values, n, seed):
    rng = random.Random(seed)

    def token():
        v = rng.choice(values) or "x"
        return rng.choice(
            [v, v.upper().replace("_", " "), v[: rng.randint(1, len(v))], v[rng.randrange(len(v)) :], f"very {v}", f"{v}-ish",
             "", "  ", "zzz", "e", "a b", "ÄÖ😀", f"😀{v}😀"]
        )

    return [(i, ",".join(token() for _ in range(rng.randint(1, 4)))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, ",,")]


@pytest.mark.parametrize("field", ["maneuver_lat", "traffic_light", "agent_behavior"])
def test_built_in_lists(spark, field):
    values = VOCABULARY[field]
    df = spark.createDataFrame(cells_for(values, 150, 1), "id long, cell string").repartition(3)
    expected = va.clean_column(df, "cell", values, "out", field)
    ours = ma.clean_column_by_table(df, "cell", table_of(spark, values), "out", field)
    assert ours.columns == expected.columns
    assert sorted(ours.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_any_values_and_any_gram_size(spark, size):
    """Short, nested, repeated, blank-free and non-Latin values; no value is called none."""
    values = ["b", "abc", "ab", "abcd", "é", "ÄÖ".lower(), "😀", "x_y", "abc", "zz", "a.c", "%"]
    df = spark.createDataFrame(cells_for(values, 200, 2), "id long, cell string")
    expected = va.clean_column(df, "cell", values, "out")
    ours = ma.clean_column_by_table(df, "cell", table_of(spark, values), "out", size=size)
    assert sorted(ours.collect()) == sorted(expected.collect())


def test_large_vocabulary_without_large_plan(spark):
    values = [f"item_{i:06d}_{i % 977:x}" for i in range(100_000)]
    vocabulary = spark.range(100_000).selectExpr(
        "id AS position", "concat('item_', lpad(id, 6, '0'), '_', lower(hex(id % 977))) AS value"
    )
    cells = [(0, "Item 000017 11"), (1, "item_099999_"), (2, "the item_000500_1f4 here, 000501"), (3, "nothing"), (4, "tem_0"), (5, "m"), (6, " "), (7, "")]
    df = spark.createDataFrame(cells, "id long, cell string")
    ours = ma.clean_column_by_table(df, "cell", vocabulary, "out")
    assert len(ours._jdf.queryExecution().analyzed().toString()) < 60_000
    got = {r.id: r.out for r in ours.collect()}
    first = lambda t: next((v for v in values if t in v or v in t), t)
    assert got == {
        0: "item_000017_11", 1: first("item_099999_"), 2: f"{first('the_item_000500_1f4_here')},{first('000501')}", 3: "nothing",
        4: first("tem_0"), 5: first("m"), 6: values[0], 7: "none",
    }


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id long, cell string")
    none = table_of(spark, [])
    assert [r.out for r in ma.clean_column_by_table(df, "cell", none, "out").orderBy("id").collect()] == ["a,b", "none"]
    assert ma.clean_column_by_table(df.limit(0), "cell", table_of(spark, ["a"]), "out").collect() == []


def test_long_cells_stay_linear(spark):
    df = spark.createDataFrame([(1, "q" * 200_000 + "needle" + "q" * 200_000), (2, ",".join(["needl"] * 20_000))], "id long, cell string")
    got = ma.clean_column_by_table(df, "cell", table_of(spark, ["thread", "needle"]), "out").orderBy("id").collect()
    assert got[0].out == "needle" and got[1].out == ",".join(["needle"] * 20_000)


def test_built_in_rules_as_a_table(spark):
    rng = random.Random(7)
    words = "slow stop for the lead red light Stop Sign yield nudge within lane change lanes left merging rain fog training nightly curve bumps".split()
    texts = [(i, " ".join(rng.choices(words, k=rng.randint(0, 25)))) for i in range(200)] + [(200, None), (201, ""), (202, "rain")]
    df = spark.createDataFrame(texts, "id long, text string").union(spark.createDataFrame([(202, "rain")], "id long, text string"))
    fields = list(dict.fromkeys(r[0] for r in an.DRIVING_RULES))
    for lower in (True, False):
        expected = an.label_by_rules(df, "text", an.DRIVING_RULES, lower)
        ours = ru.label_by_rule_table(df, "text", ru.rules_table(spark, an.DRIVING_RULES), fields, lower)
        assert ours.columns == expected.columns
        assert sorted(ours.collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_rules_without_words_and_five_thousand_rules(spark):
    rules = [("code", rf"\bx{i}\b", f"v{i}", (f"x{i}",)) for i in range(5000)] + [("digits", r"\d{4}", "four"), ("code", r"y\s+z", "yz", ("y z", "y\tz"))]
    df = spark.createDataFrame([(1, "x17 and x4999 x17"), (2, "x99999"), (3, "y z"), (4, "y\tz x5")], "id long, text string")
    table = ru.rules_table(spark, rules)
    labelled = ru.label_by_rule_table(df, "text", table, ["code", "digits"])
    assert len(labelled._jdf.queryExecution().analyzed().toString()) < 60_000
    got = {r.id: (r.code, r.digits) for r in labelled.collect()}
    assert got == {
        1: (["v17", "v4999"], ["four"]), 2: (["none"], ["four"]), 3: (["yz"], ["none"]), 4: (["v5", "yz"], ["none"]),
    }


def test_whole_word_rules_move_no_text(spark, tmp_path, monkeypatch):
    """Rules for a word between blanks give what patterns give, odd line ends included, and the texts are not written."""
    rng = random.Random(3)
    blanks = [" ", "\t", "\n", "\r\n", "\x0b", "\u0085", "\u2028", "\u00a0", ".", "  "]
    values = ["a", "in", "rain", "ä", "x_1", "Rain", "a"]
    texts = [(i, "".join(rng.choice([*values, "raining"]) + rng.choice(blanks) for _ in range(rng.randint(0, 9)))) for i in range(300)]
    df = spark.createDataFrame([*texts, *texts[:50], (300, None), (301, ""), (302, "a"), (303, "in\u2029"), (304, "in\u0085\n")], "id long, text string")
    spelled = [r"(^|\s){}($|\s)", r"(^|[ \t\n\x0B\f\r]){}($|[ \t\n\x0B\f\r])", r"(^|[ \t\n\x0B\f\r]){}($|[ \t\n\x0B\f\r])", r"\b{}\b"]
    rules = [("even" if i % 2 else "odd", spelled[i % 4].format(v), f"{v}{i}", (v,)) for i, v in enumerate(values)]
    for some in (rules, [r for r in rules if r[1][0] == "("]):
        for lower in (True, False):
            expected = an.label_by_rules(df, "text", some, lower)
            ours = ru.label_by_rule_table(df, "text", ru.rules_table(spark, some), ["odd", "even"], lower)
            assert sorted(ours.select(expected.columns).collect(), key=repr) == sorted(expected.collect(), key=repr)
    names = []
    monkeypatch.setattr(ma, "shared_folder", lambda spark, name: names.append(name) or str(tmp_path / f"{name}-{len(names)}"))
    ru.label_by_rule_table(df, "text", ru.rules_table(spark, [r for r in rules if r[1][0] == "("]), ["odd", "even"]).collect()
    assert names == ["rules"]


def test_unwrapping_of_stray_quotes(spark):
    cells = {
        """[['plain']]""": "plain",
        """[['it\\'s']]""": "it's",
        '''[["it's"]]''': "it's",
        """[['it's']]""": "it's",
        '''[["he said "no", twice"]]''': 'he said "no", twice',
        """[['a', 'b']]""": """[['a', 'b']]""",
        """[['a'], ["b"]]""": """[['a'], ["b"]]""",
        """[['a "quoted" \\ slash' here
and a line']]""": """a "quoted" \\ slash' here
and a line""",
        """[['mixed"]]""": """[['mixed"]]""",
        "[[']]": "[[']]",
        "[[]]": "[[]]",
        "[['']]": "",
        "plain": "plain",
    }
    df = spark.createDataFrame([(k,) for k in cells], "cell string")
    assert {r.cell: r.text for r in df.select("cell", unwrapped("cell").alias("text")).collect()} == cells


def test_unwrapping_every_document_as_python_prints_it(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    odd = ["'", '"', "\\", "\n\t'\"", "a\\'b", "é\x07", ""]
    texts = {r.doc_id: r.text + odd[r.doc_id % len(odd)] for r in docs}
    df = spark.createDataFrame([(i, repr([[t]])) for i, t in texts.items()], "doc_id long, cell string")
    assert {r.doc_id: r.text for r in df.select("doc_id", unwrapped("cell").alias("text")).collect()} == texts
