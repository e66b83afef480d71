"""Labelling by a table of rules: any number of them in a plan of constant size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.functions.text import named, quoted
from tagwright.operators.annotate import Rule
from tagwright.operators.matching import contained, digest, written
from tagwright.operators.skew import spread_join
from tagwright.vocabulary import NOT_MENTIONED

RULES = "position long, field string, pattern string, value string, words array<string>"

#: Up to so many whole-word rules are broadcast; beyond that they are joined by a shuffle.
BROADCAST_RULES = 100_000

#: Both spellings of what ``split(text, '\\s+')`` cuts at.
_BLANKS = (r"\s", r"[ \t\n\x0B\f\r]")


def rules_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """``(position, field, pattern, value, words)``, one row per rule in its order."""
    rows = [(i, r[0], r[1], r[2], list(r[3]) if len(r) > 3 else []) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, RULES)


def _pieces(rules: DataFrame) -> DataFrame:
    """``(position, piece)``: of each of a rule's words the longest part without blanks; empty for a rule without words.

    A text with the words has a blank-free run with that part inside.
    """
    words = "IF(size(words) > 0, words, array(''))"
    longest = "array_max(transform(split(word, '\\\\s+'), p -> struct(length(p) AS n, p))).p"
    return rules.selectExpr("position", f"explode({words}) AS word").selectExpr("position", f"{longest} AS piece").distinct()


def _whole_word() -> Column:
    """Whether a rule asks for its one word as a whole blank-free run, so that the runs of a text tell the pattern's result."""
    word = F.get("words", F.lit(0))
    spelled = [F.concat(F.lit(f"(^|{b})"), word, F.lit(f"($|{b})")) for b in _BLANKS]
    whole = (F.size("words") == 1) & word.rlike(r"\A[\p{L}\p{N}_]+\z") & F.col("pattern").isin(*spelled)
    return F.coalesce(whole, F.lit(False))


def _whole_word_hits(texts: DataFrame, rules: DataFrame, small: bool) -> DataFrame:
    """``(digest, field, hit)`` of whole-word rules: runs of a text that equal a word.

    A pattern's ``$`` also matches before one of three line ends that are no blanks, so the last run counts without it as well.
    """
    last = "slice(split(left(text, length(text) - 1), '\\\\s+'), -1, 1)"
    ended = f"IF(right(text, 1) IN ('\u0085', '\u2028', '\u2029'), {last}, CAST(array() AS ARRAY<STRING>))"
    runs = texts.selectExpr("digest", f"explode(array_distinct(concat(split(text, '\\\\s+'), {ended}))) AS run")
    words = rules.filter("position IS NOT NULL").select(
        F.get("words", F.lit(0)).alias("run"), "field", F.struct("position", "value").alias("hit")
    )
    return runs.join(F.broadcast(words) if small else words, "run").select("digest", "field", "hit")


def _pattern_hits(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(digest, field, hit)`` of rules of any kind; each distinct text is judged once."""
    texts = written(texts.dropDuplicates(["digest"]), "texts")
    pieces = written(_pieces(rules), "pieces")
    runs = written(
        texts.selectExpr("digest", "explode(array_distinct(split(text, '\\\\s+'))) AS run").filter("run <> ''"), "runs"
    )
    with_part = pieces.filter("piece <> ''")
    hits = contained(runs.select(F.col("run").alias("text")), with_part.select(F.col("piece").alias("entry")))
    met = spread_join(runs, hits.groupBy("text").agg(F.collect_set("entry").alias("parts")).withColumnRenamed("text", "run"), "run", "inner")
    pairs = met.select("digest", F.explode("parts").alias("piece")).distinct()
    every = texts.select("digest").withColumn("piece", F.lit(""))
    pairs = pairs.union(every).join(pieces, "piece").select("digest", "position").distinct()
    asked = pairs.join(rules, "position").withColumnRenamed("digest", "of")
    has_words = "size(words) = 0 OR exists(words, w -> contains(text, w))"
    return (
        asked.join(texts, F.expr("of = digest"))
        .filter(f"({has_words}) AND text RLIKE pattern")
        .select("digest", "field", F.struct("position", "value").alias("hit"))
    )


def label_by_rule_table(
    df: DataFrame, text_col: str, rules: DataFrame, fields: Sequence[str], lower: bool = False
) -> DataFrame:
    """``label_by_rules`` with the rules as a table (see ``rules_table``) and the names of their fields.

    Rules whose pattern is one word between blanks or the text's ends meet the runs of each text by equality, and no text is moved.
    For the others, the distinct blank-free runs of all texts are matched with the rules' rarest parts through an index of
    character grams; a text then meets only the rules whose part it has, and patterns run on those pairs. A
    rule without words meets every text. Texts are told apart by SHA-256; a null text has no labels.
    """
    read = f"lower({named(text_col)})" if lower else named(text_col)
    told = df.selectExpr("*", f"{digest(read)} AS __digest")
    texts = df.selectExpr(f"{read} AS text").filter("text IS NOT NULL").selectExpr(f"{digest('text')} AS digest", "text")
    rules = written(rules.withColumn("whole", _whole_word()), "rules")
    numbers = {r["whole"]: r["count"] for r in rules.groupBy("whole").count().collect()}
    found = _whole_word_hits(texts, rules.filter("whole"), numbers.get(True, 0) <= BROADCAST_RULES)
    if numbers.get(False):
        others = _pattern_hits(texts, rules.filter("NOT whole").drop("whole"))
        found = found.union(others) if numbers.get(True) else others
    # One list per field, as long as the field has rules at most.
    lists = [
        F.expr(f"array_distinct(transform(array_sort(collect_set(hit) FILTER (WHERE field = {quoted(f)})), h -> h.value))").alias(f"__{f}")
        for f in fields
    ]
    labels = found.groupBy("digest").agg(*lists).withColumnRenamed("digest", "__digest")
    kept = [named(c) for c in df.columns if c not in fields]
    return spread_join(told, labels, "__digest", "left").selectExpr(
        *kept,
        *[f"IF(size({named('__' + f)}) > 0, {named('__' + f)}, array({quoted(NOT_MENTIONED)})) AS {named(f)}" for f in fields],
    )
