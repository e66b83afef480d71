"""Containment between texts and a table of short texts, by an inverted index of character grams.

A text that lies inside another has all its grams there, so one gram is enough to find it: the one that the
fewest entries of the table have. Pairs that share that gram are verified. Vocabularies and rules may have any
number of rows: they are joined, never written into an expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import EXACT, FUZZY, UNKNOWN, filled, named, normal_form, quoted
from tagwright.operators.skew import spread_join
from tagwright.sources.shared import shared_folder
from tagwright.vocabulary import NOT_MENTIONED

GRAM = 3


def written(df: DataFrame, name: str) -> DataFrame:
    """A table below the shared folder: what several branches read, and what a lost executor need not repeat."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def grams(text: str, size: int) -> str:
    """SQL: the distinct pieces of exactly ``size`` characters, in time that grows with the text."""
    return f"array_distinct(regexp_extract_all({text}, '(?s)(?=(.{{{size}}}))', 1))"


def every_gram(text: str, size: int = GRAM) -> str:
    """SQL: the pieces of ``size`` characters and of fewer, and the empty one."""
    return f"concat(array(''), {', '.join(grams(text, k) for k in range(1, size + 1))})"


def _posted(entries: DataFrame, size: int) -> DataFrame:
    """``(entry, gram, n)``: grams of ``size`` of longer entries, with the number of entries that have them."""
    each = entries.filter(f"length(entry) >= {size}").selectExpr("entry", f"explode({grams('entry', size)}) AS gram")
    often = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return spread_join(each, often, "gram", "inner")


def contained(texts: DataFrame, entries: DataFrame, size: int = GRAM) -> DataFrame:
    """``(text, entry)``: every distinct ``entry`` of the second table that lies inside a ``text`` of the first.

    Each entry is looked for under its rarest gram; entries shorter than a gram are looked up whole.
    """
    distinct = entries.select("entry").filter("entry IS NOT NULL").distinct()
    posted = _posted(distinct, size)
    keys = posted.groupBy("entry").agg(F.min(F.struct("n", "gram")).alias("least")).select("entry", F.col("least.gram").alias("gram"))
    keys = keys.union(distinct.filter(f"length(entry) < {size}").select("entry", F.col("entry").alias("gram")))
    pieces = texts.select("text").distinct().selectExpr("text", f"explode({every_gram('text', size)}) AS gram")
    return pieces.join(keys, "gram").filter("contains(text, entry)").select("text", "entry")


def containing(texts: DataFrame, entries: DataFrame, size: int = GRAM) -> DataFrame:
    """``(text, entry)``: every distinct ``entry`` in which a ``text`` of at least ``size`` characters lies."""
    distinct = entries.select("entry").filter("entry IS NOT NULL").distinct()
    posted = written(_posted(distinct, size), "grams")
    often = posted.select("gram", "n").distinct()
    long = texts.select("text").distinct().filter(f"length(text) >= {size}")
    own = long.selectExpr("text", f"explode({grams('text', size)}) AS gram")
    # A gram that no entry has tells that none contains the text: it counts as the rarest.
    rarest = (
        spread_join(own, often, "gram", "left")
        .groupBy("text")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("least"))
        .selectExpr("text", "least.n AS n", "least.gram AS gram")
        .filter("n > 0")
        .select("text", "gram")
    )
    return rarest.join(posted.select("entry", "gram"), "gram").filter("contains(entry, text)").select("text", "entry")


def match_tokens(tokens: DataFrame, vocabulary: DataFrame, size: int = GRAM) -> DataFrame:
    """``(token, value)`` for each distinct ``token`` that has a value in ``vocabulary`` (``position``, ``value``).

    As in ``nearest``: an exact value wins; otherwise the first value by position that contains the token or is
    contained in it. The blank token is ``none`` if there is that value, else the first value. Values may repeat; null ones are left
    out.
    """
    values = written(
        vocabulary.filter("value IS NOT NULL").groupBy("value").agg(F.min("position").alias("position")), "values"
    )
    asked = tokens.select("token").filter("token IS NOT NULL").distinct()
    exact = spread_join(asked, values.select(F.col("value").alias("token")), "token", "left_semi").filter("token <> ''")
    blank = values.agg(
        F.coalesce(F.max(F.expr(f"IF(value = {quoted(NOT_MENTIONED)}, value, NULL)")), F.min_by("value", "position")).alias("value")
    ).selectExpr("'' AS token", "value").filter("value IS NOT NULL")
    others = written(
        spread_join(asked, values.select(F.col("value").alias("token")), "token", "left_anti").filter("token <> ''").select(F.col("token").alias("text")),
        "others",
    )
    entries = values.select(F.col("value").alias("entry"))
    # Of the values around a token shorter than a gram only the first counts, so each such piece has one row.
    first = values.selectExpr("value", "position", f"explode({_short(size)}) AS text").groupBy("text").agg(
        F.min(F.struct("position", "value")).alias("best")
    )
    pairs = contained(others, entries, size).union(containing(others, entries, size))
    places = values.select(F.col("value").alias("entry"), "position")
    long = spread_join(pairs, places, "entry", "inner").select("text", F.struct("position", F.col("entry").alias("value")).alias("best"))
    short = others.filter(f"length(text) < {size}").join(first, "text").select("text", "best")
    found = long.union(short).groupBy("text").agg(F.min("best").alias("best")).selectExpr("text AS token", "best.value AS value")
    return exact.selectExpr("token", "token AS value").union(found).union(blank)


def _short(size: int) -> str:
    parts = [grams("value", k) for k in range(1, size)]
    return f"concat({', '.join(parts)})" if parts else "CAST(array() AS ARRAY<STRING>)"


def digest(text: str) -> str:
    """SQL: what stands for a text in joins, however long it is."""
    return f"unhex(sha2({text}, 256))"


def clean_column_by_table(
    df: DataFrame, col: str, vocabulary: DataFrame, out: str, field: str | None = None, size: int = GRAM
) -> DataFrame:
    """``clean_column`` with a table (``position``, ``value``) in place of a list; same columns, same rows.

    Cells are told apart by SHA-256; each distinct cell is split once, each distinct token matched once. A
    cell's tokens are joined again in their order, repeats kept.
    """
    name, record = field or col, f"{out}_outcomes"
    cell = filled(named(col))
    cells = df.selectExpr(f"{digest(cell)} AS __digest", f"{cell} AS __cell").dropDuplicates(["__digest"])
    # Stripped and put in normal form once a token, outside array functions.
    tokens = written(
        cells.selectExpr("__digest", "posexplode(split(__cell, ',', -1)) AS (at, part)").selectExpr(
            "__digest", "at", f"{normal_form('part')} AS token"
        ),
        "tokens",
    )
    hits = match_tokens(tokens, vocabulary, size)
    judged = spread_join(tokens, hits, "token", "left").selectExpr(
        "__digest",
        f"struct(at, named_struct('field', {quoted(name)}, 'token', token, 'outcome', CASE WHEN value = token THEN '{EXACT}' "
        f"WHEN value IS NOT NULL THEN '{FUZZY}' ELSE '{UNKNOWN}' END, 'value', coalesce(value, token)) AS o) AS e",
    )
    per_cell = judged.groupBy("__digest").agg(F.array_sort(F.collect_list("e")).alias("__e"))
    per_cell = per_cell.selectExpr("__digest", "array_join(transform(__e, e -> e.o.value), ',') AS __clean", "transform(__e, e -> e.o) AS __record")
    kept = [c for c in df.columns if c not in (out, record)]
    told = spread_join(df.selectExpr("*", f"{digest(cell)} AS __digest"), per_cell, "__digest", "left")
    return told.select(
        *[F.col(named(c)) for c in kept], F.col("__clean").alias(out), F.col("__record").alias(record)
    )
