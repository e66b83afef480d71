"""Named queries whose vocabularies and rules are tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tagwright.operators import annotate as an
from tagwright.operators import matching as ma
from tagwright.operators import prompts as pr
from tagwright.operators import rules as ru
from tagwright.operators import schemas as sc
from tagwright.plans.catalog import PRIORITIES, RULE_FIELDS, SQL, phrased_documents, planted_answers, query, table
from tagwright.vocabulary import response_json_schema, vocabulary_table


@query(SQL["vocab_clean"])
def vocab_clean_table(spark, folder):
    """``vocab_clean`` with the vocabulary as a table."""
    values = vocabulary_table(spark, {"priority": PRIORITIES}).select("position", "value")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    clean = ma.clean_column_by_table(orders, "o_orderpriority", values, "priority")
    return clean.select("o_orderkey", "priority", F.element_at("priority_outcomes", 1)["outcome"].alias("outcome"))


@query(
    r"""
    WITH v AS (
        SELECT value, row_number() OVER (ORDER BY value DESC) AS position
        FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS value FROM benchmark)),
    c AS (SELECT conv_id, turn, regexp_replace(text, '[\s.]+', ',', 'g') AS cell FROM conversations),
    t AS (SELECT conv_id, turn, unnest(string_split(cell, ',')) AS part, unnest(range(len(string_split(cell, ',')))) AS place FROM c),
    n AS (SELECT conv_id, turn, place, replace(replace(lower(trim(part)), ' ', '_'), '-', '_') AS token FROM t),
    d AS (SELECT DISTINCT token FROM n),
    h AS (
        SELECT token, CASE WHEN token = '' THEN (SELECT arg_min(value, position) FROM v)
                           WHEN bool_or(value = token) THEN token ELSE arg_min(value, position) END AS hit
        FROM d JOIN v ON contains(value, token) OR contains(token, value) GROUP BY token)
    SELECT conv_id, turn, string_agg(coalesce(hit, n.token), ',' ORDER BY place) AS cell,
           count(*) FILTER (WHERE hit = n.token) AS exact, count(*) FILTER (WHERE hit <> n.token) AS fuzzy,
           count(*) FILTER (WHERE hit IS NULL) AS oov
    FROM n LEFT JOIN h ON h.token = n.token GROUP BY conv_id, turn
    """
)
def vocab_fuzzy_join(spark, folder):
    """Every word of whole conversations against all words of the benchmark, exact or by containment."""
    words = table(spark, folder, "benchmark").select(F.explode(F.expr("regexp_extract_all(text, '[A-Za-z]+', 0)")).alias("value"))
    values = words.distinct().selectExpr("value", "row_number() OVER (ORDER BY value DESC) AS position")
    cells = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.regexp_replace("text", r"[\s.]+", ",").alias("said")
    )
    clean = ma.clean_column_by_table(cells, "said", values, "cell")
    counts = [
        F.expr(f"CAST(size(filter(cell_outcomes, o -> o.outcome = '{k}')) AS BIGINT)").alias(k) for k in ("exact", "fuzzy", "oov")
    ]
    return clean.select("conv_id", "turn", "cell", *counts)


@query(SQL["driving_rule_labels"])
def driving_rule_table(spark, folder):
    """The built-in rules as a table, over whole documents with one driving phrase at their end."""
    docs = phrased_documents(spark, folder)
    rules = ru.rules_table(spark, an.DRIVING_RULES)
    labelled = ru.label_by_rule_table(docs, "text", rules, RULE_FIELDS, lower=True)
    return labelled.select("doc_id", *[F.array_join(f, ",").alias(f) for f in RULE_FIELDS])


@query(
    r"""
    WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark),
    t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[^ \t\n\x0B\f\r]+')) AS word FROM documents),
    l AS (SELECT doc_id, count(*) AS n, min(word) AS first_word, max(word) AS last_word FROM t SEMI JOIN w USING (word) GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n, coalesce(first_word, 'none') AS first_word, coalesce(last_word, 'none') AS last_word
    FROM documents LEFT JOIN l USING (doc_id)
    """
)
def word_rule_table(spark, folder):
    """A rule for every word of the benchmark: hundreds to thousands of patterns over whole documents."""
    words = table(spark, folder, "benchmark").select(
        F.explode(F.expr("array_distinct(regexp_extract_all(lower(text), '[a-z]+', 0))")).alias("value")
    ).distinct()
    rules = words.selectExpr(
        "row_number() OVER (ORDER BY value) AS position",
        "'word' AS field",
        r"concat('(^|[ \\t\\n\\x0B\\f\\r])', value, '($|[ \\t\\n\\x0B\\f\\r])') AS pattern",
        "value",
        "array(value) AS words",
    )
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labelled = ru.label_by_rule_table(docs, "text", rules, ["word"], lower=True)
    none = F.col("word")[0] == "none"
    return labelled.select(
        "doc_id",
        F.when(none, 0).otherwise(F.size("word")).cast("bigint").alias("n"),
        F.col("word")[0].alias("first_word"),
        F.element_at("word", -1).alias("last_word"),
    )


@query(SQL["response_conformance"])
def schema_conformance(spark, folder):
    """``response_conformance`` by the compiled schema that the service is given: the first fault in its order."""
    schema = json.loads(response_json_schema({"lang": ["en", "de", "fr", "es", "none"]}))
    judged = sc.check_schema(planted_answers(spark, folder), "answer", schema)

    def any_fault(test: str):
        return F.expr(f"exists(faults, f -> {test})")

    row, value = "f.path RLIKE '^[$].rows.[0-9]+.$'", "f.path RLIKE '^[$].rows.[0-9]+.[.]'"
    status = (
        F.when(any_fault("f.rule = 'not JSON' OR f.path = '$' AND f.rule = 'type'"), "bad_json")
        .when(any_fault(f"f.rule = 'additional' AND NOT {value}"), "extra")
        .when(any_fault("f.path = '$.rows'"), "no_rows")
        .when(any_fault(f"{row} AND f.rule = 'type'"), "bad_type")
        .when(any_fault("f.rule = 'required'"), "missing")
        .when(any_fault("f.rule = 'additional'"), "extra")
        .when(any_fault("f.rule = 'type'"), "bad_type")
        .when(any_fault("f.rule = 'enum'"), "bad_confidence")
        .otherwise("ok")
    )
    return judged.select("doc_id", status.alias("status"))


NESTED = {
    "type": "object",
    "required": ["doc", "labels"],
    "additionalProperties": False,
    "properties": {
        "doc": {"$ref": "#/$defs/doc"},
        "labels": {
            "type": "array",
            "minItems": 1,
            "items": {
                "type": "object",
                "required": ["quality"],
                "properties": {"quality": {"enum": [0, 1]}, "toxic": {"const": 0}},
            },
        },
    },
    "$defs": {
        "doc": {
            "type": "object",
            "properties": {
                "id": {"type": "integer", "minimum": 10},
                "lang": {"enum": ["en", "de", "fr"]},
                "text": {"type": "string", "minLength": 200, "pattern": "[.]"},
            },
        }
    },
}


@query(
    """
    WITH f AS (
        SELECT d.doc_id, l.doc_id IS NULL AS bare, list_filter([
            CASE WHEN d.doc_id < 10 THEN '$.doc.id minimum' END,
            CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN '$.doc.lang enum' END,
            CASE WHEN length(text) < 200 THEN '$.doc.text minLength' END,
            CASE WHEN NOT contains(text, '.') THEN '$.doc.text pattern' END,
            CASE WHEN l.doc_id IS NULL THEN '$.labels minItems' END,
            CASE WHEN l.doc_id % 3 = 0 THEN '$.labels[0].quality required' END,
            CASE WHEN toxic = 1 THEN '$.labels[0].toxic enum' END], lambda x: x IS NOT NULL) AS faults
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT doc_id, len(faults) AS n, list_aggregate(list_sort(faults), 'string_agg', ', ') AS faults FROM f
    """
)
def nested_schema(spark, folder):
    """Whole documents with their labels as nested JSON, checked by a schema with references, arrays and constants."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    known = labels.select(
        F.col("doc_id").alias("of"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("quality")).alias("quality"),
        "toxic",
    )
    joined = docs.join(known, F.expr("doc_id = of"), "left")
    listed = F.when(F.col("of").isNull(), F.expr("CAST(array() AS ARRAY<STRUCT<quality: INT, toxic: INT>>)")).otherwise(
        F.array(F.struct("quality", "toxic"))
    )
    told = F.to_json(F.struct(F.struct(F.col("doc_id").alias("id"), "lang", "text").alias("doc"), listed.alias("labels")))
    judged = sc.check_schema(joined.select("doc_id", told.alias("said")), "said", NESTED)
    texts = F.transform("faults", lambda f: F.concat(f["path"], F.lit(" "), f["rule"]))
    return judged.select(
        "doc_id",
        F.size("faults").cast("bigint").alias("n"),
        F.nullif(F.array_join(F.sort_array(texts), ", "), F.lit("")).alias("faults"),
    )


@query(
    """
    WITH v AS (
        SELECT c_mktsegment AS field, c_name AS value, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1 AS place
        FROM customer)
    SELECT field, place // 50 * 50 AS start, '  ' || field || ': [' || string_agg(value, ', ' ORDER BY place) || ']' AS line
    FROM v GROUP BY field, place // 50 * 50
    """
)
def vocab_pieces(spark, folder):
    """Vocabularies of hundreds to thousands of values, in lines of fifty."""
    values = table(spark, folder, "customer").selectExpr("c_mktsegment AS field", "c_custkey AS position", "c_name AS value")
    return pr.vocabulary_pieces(values, 50)


@query(
    """
    WITH v AS (
        SELECT lang, '  - **' || doc_id || '**: ' || n_chars || ' characters from ' || source AS line,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place
        FROM documents)
    SELECT lang, place // 40 * 40 AS start, string_agg(line, chr(10) ORDER BY place) AS block FROM v GROUP BY ALL
    """
)
def definition_pieces(spark, folder):
    """A line for every document, in blocks of forty per language; languages of over 75 documents are cut."""
    docs = table(spark, folder, "documents").selectExpr(
        "lang", "doc_id", "CAST(doc_id AS STRING) AS name", "concat(n_chars, ' characters from ', source) AS text"
    )
    return pr.definition_pieces(docs, "lang", "doc_id", "name", "text", 40, hot_rows=75)
