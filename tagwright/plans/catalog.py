"""Named queries over the test tables, each with the SQL that gives the same rows.

``QUERIES[name]`` takes ``(spark, folder)``; ``SQL[name]`` is for a plain SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tagwright.functions.text import WHITESPACE, samples, unwrapped
from tagwright.operators import annotate as an
from tagwright.operators import prompts as pr
from tagwright.operators import quality as qa
from tagwright.operators import recover as rc
from tagwright.operators import responses as rs
from tagwright.operators import rows as rw
from tagwright.operators import trajectory as tr
from tagwright.operators import validate as va
from tagwright.plans.annotation import Annotation
from tagwright.plans.offline import OfflineAnnotation
from tagwright.sources import files
from tagwright.sources.shared import shared_folder
from tagwright.streaming.ingest import process_new_files
from tagwright.vocabulary import TOOL_NAME, VOCABULARY, vocabulary_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[build.__name__] = build
        SQL[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---- SQL fragments ----------------------------------------------------------


def sql_list(values: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def sql_tokens(col: str) -> str:
    return (
        f"list_transform(string_split({col}, ','), "
        f"lambda t: replace(replace(lower(trim(t)), ' ', '_'), '-', '_'))"
    )


def sql_hit(token: str, values: Sequence[str]) -> str:
    """The value for a token, NULL if there is none."""
    known = sql_list(values)
    return (
        f"CASE WHEN list_contains({known}, {token}) THEN {token} WHEN {token} = '' THEN 'none' "
        f"ELSE list_filter({known}, lambda v: contains(v, {token}) OR contains({token}, v))[1] END"
    )


def sql_outcome(token: str, hit: str) -> str:
    return (
        f"CASE WHEN {hit} IS NULL THEN 'oov' WHEN {hit} = {token} THEN 'exact' ELSE 'fuzzy' END"
    )


# ---- rows, files, recovery --------------------------------------------------


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, folder):
    customers = table(spark, folder, "customer")
    path = shared_folder(spark, "csv_roundtrip")
    files.write_csv(customers, path, customers.columns)
    text = files.read_csv(spark, path, required=["c_custkey", "c_name"])
    return text.select(
        *[F.col(c).cast(customers.schema[c].dataType).alias(c) for c in customers.columns]
    )


@query("SELECT c_custkey, c_name, c_mktsegment, 'none' AS c_comment FROM customer")
def csv_fixed_columns(spark, folder):
    columns = ["c_custkey", "c_name", "c_mktsegment", "c_comment"]
    path = shared_folder(spark, "csv_fixed_columns")
    files.write_csv(table(spark, folder, "customer"), path, columns)
    schema = "c_custkey bigint, c_name string, c_mktsegment string, c_comment string"
    return files.read_csv(spark, path, schema, columns)


@query("SELECT doc_id FROM documents")
def one_column(spark, folder):
    return files.read_column(spark, f"{folder}/documents.parquet", "doc_id")


@query(
    f"""
    SELECT doc_id, line
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE trim(line, '{WHITESPACE}') <> ''
    """
)
def nonblank_text(spark, folder):
    docs = table(spark, folder, "documents")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return rw.non_blank(lines, "line")


@query("SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 25")
def first_n(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return rw.first_rows(docs, "doc_id", 25)


@query("SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 1 OFFSET 150")
def kth_row(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return rw.row_at(docs, "doc_id", 150)


@query(
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE regexp_matches(CAST(c_custkey AS VARCHAR), 'BUILD|7.7')
       OR regexp_matches(c_name, 'BUILD|7.7')
       OR regexp_matches(CAST(c_nationkey AS VARCHAR), 'BUILD|7.7')
       OR regexp_matches(CAST(c_acctbal AS VARCHAR), 'BUILD|7.7')
       OR regexp_matches(c_mktsegment, 'BUILD|7.7')
    """
)
def any_column_contains(spark, folder):
    return rc.failed_rows(table(spark, folder, "customer"), "BUILD|7.7")


def _checked_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels as a result table in which the toxic documents count as failed."""
    labels = table(spark, folder, "labels")
    return labels.withColumn("state", F.when(F.col("toxic") == 1, "PARSE_ERROR").otherwise("ok"))


@query(
    """
    SELECT doc_id, lang, n_chars FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
    """
)
def error_semi(spark, folder):
    failed = rc.failed_rows(_checked_labels(spark, folder))
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return rc.rows_of(docs, failed, "doc_id")


@query(
    """
    SELECT l.doc_id, d.text FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id
    WHERE l.toxic = 1
    """
)
def error_recovery(spark, folder):
    failed = rc.failed_rows(_checked_labels(spark, folder), regex=False)
    return rc.recover(failed, table(spark, folder, "documents"), "doc_id", ["text"])


@query(
    """
    SELECT doc_id, lang, n_chars FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
    """
)
def missing_outputs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return rc.missing(docs, table(spark, folder, "labels"), "doc_id")


@query(
    """
    SELECT doc_id, quality, toxic FROM labels
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
    UNION ALL
    SELECT doc_id, quality + 10, 0 FROM labels WHERE toxic = 1
    """
)
def merge_repaired(spark, folder):
    labels = table(spark, folder, "labels")
    fixed = labels.filter("toxic = 1").select(
        "doc_id", (F.col("quality") + 10).alias("quality"), F.lit(0).alias("toxic")
    )
    return rc.merge_repaired(labels, fixed, "doc_id")


# ---- validation -------------------------------------------------------------

PRIORITIES = ["urgent", "high", "medium", "low", "none"]
PART_VOCABULARY = {
    "p_type": ["standard", "large", "small", "medium", "economy", "none"],
    "p_name": ["widget", "bolt", "gear", "plate", "ring", "red_rod", "rod", "none"],
}


@query(
    f"""
    WITH t AS (SELECT o_orderkey, {sql_tokens("o_orderpriority")}[1] AS token FROM orders),
    h AS (SELECT o_orderkey, token, {sql_hit("token", PRIORITIES)} AS hit FROM t)
    SELECT o_orderkey, coalesce(hit, token) AS priority, {sql_outcome("token", "hit")} AS outcome
    FROM h
    """
)
def vocab_clean(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    clean = va.clean_column(orders, "o_orderpriority", PRIORITIES, "priority")
    first = F.element_at("priority_outcomes", 1)["outcome"]
    return clean.select("o_orderkey", "priority", first.alias("outcome"))


@query(
    f"""
    WITH t AS (SELECT {sql_tokens("o_orderpriority")}[1] AS token FROM orders),
    h AS (SELECT token, {sql_hit("token", PRIORITIES)} AS hit FROM t)
    SELECT coalesce(hit, token) AS priority, count(*) AS n FROM h GROUP BY 1
    """
)
def priority_counts(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderpriority")
    clean = va.clean_column(orders, "o_orderpriority", PRIORITIES, "priority")
    return qa.counts(clean, "priority")


@query(
    f"""
    SELECT o_orderkey, token, token IN ('1_urgent', '2_high', '3_medium', '5_low') AS known
    FROM (SELECT o_orderkey, unnest({sql_tokens("o_orderpriority || ',' || o_orderstatus")}) AS token
          FROM orders)
    """
)
def vocab_join(spark, folder):
    values = vocabulary_table(spark, {"priority": ["1_urgent", "2_high", "3_medium", "5_low"]})
    cells = table(spark, folder, "orders").select(
        "o_orderkey", F.concat_ws(",", "o_orderpriority", "o_orderstatus").alias("cell")
    )
    return va.lookup_values(cells, "cell", values, "priority").select("o_orderkey", "token", "known")


def _rated_parts(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        "p_partkey",
        "p_type",
        "p_name",
        F.when(size <= 20, "high").when(size <= 35, "medium").alias("confidence"),
        F.when(size > 30, F.col("p_brand")).otherwise("").alias("confidence_notes"),
    )


@query(
    f"""
    WITH t AS (
        SELECT p_partkey, p_size, p_brand, {sql_tokens("p_type")}[1] AS t1,
               {sql_tokens("p_name")}[1] AS t2 FROM part),
    h AS (
        SELECT *, {sql_hit("t1", PART_VOCABULARY["p_type"])} AS h1,
               {sql_hit("t2", PART_VOCABULARY["p_name"])} AS h2 FROM t),
    w AS (
        SELECT *, list_filter([
            CASE WHEN h1 IS NULL THEN 'p_type: ''' || t1 || ''' NOT in vocabulary'
                 WHEN h1 <> t1 THEN 'p_type: ''' || t1 || ''' → fuzzy matched to ''' || h1 || '''' END,
            CASE WHEN h2 IS NULL THEN 'p_name: ''' || t2 || ''' NOT in vocabulary'
                 WHEN h2 <> t2 THEN 'p_name: ''' || t2 || ''' → fuzzy matched to ''' || h2 || '''' END
            ], lambda x: x IS NOT NULL) AS warns,
            CASE WHEN p_size <= 20 THEN 'high' WHEN p_size <= 35 THEN 'medium' ELSE 'low' END AS level,
            CASE WHEN p_size > 30 THEN p_brand ELSE '' END AS said
        FROM h)
    SELECT p_partkey, coalesce(h1, t1) AS p_type, coalesce(h2, t2) AS p_name,
           CASE WHEN len(warns) > 0 AND level = 'high' THEN 'medium' ELSE level END AS confidence,
           CASE WHEN len(warns) = 0 THEN said
                ELSE CASE WHEN said = '' THEN '' ELSE said || '; ' END
                     || 'VALIDATION: ' || array_to_string(warns, '; ') END AS confidence_notes,
           len(warns) AS n_warnings
    FROM w
    """
)
def row_validate(spark, folder):
    valid = va.validate_rows(_rated_parts(spark, folder), PART_VOCABULARY)
    return valid.select(
        "p_partkey",
        "p_type",
        "p_name",
        "confidence",
        "confidence_notes",
        F.size("warnings").cast("bigint").alias("n_warnings"),
    )


@query(
    f"""
    WITH t AS (
        SELECT 'p_type' AS field, {sql_tokens("p_type")}[1] AS token FROM part
        UNION ALL SELECT 'p_name', {sql_tokens("p_name")}[1] FROM part
        UNION ALL SELECT 'o_orderpriority', {sql_tokens("o_orderpriority")}[1] FROM orders),
    h AS (
        SELECT field, token, CASE field
            WHEN 'p_type' THEN {sql_hit("token", PART_VOCABULARY["p_type"])}
            WHEN 'p_name' THEN {sql_hit("token", PART_VOCABULARY["p_name"])}
            ELSE {sql_hit("token", PRIORITIES)} END AS hit
        FROM t)
    SELECT field, {sql_outcome("token", "hit")} AS outcome, count(*) AS n FROM h GROUP BY 1, 2
    """
)
def validation_outcomes(spark, folder):
    parts = va.outcome_counts(table(spark, folder, "part"), PART_VOCABULARY)
    orders = va.outcome_counts(table(spark, folder, "orders"), {"o_orderpriority": PRIORITIES})
    return parts.unionByName(orders)


def _line_cell(values: Sequence[str], place: int, at: str) -> str:
    """SQL of one cell per order line: clean, two values, odd spelling, near or unknown value.

    The same text for both engines but for the choice of a value.
    """
    known = ", ".join(f"'{v}'" for v in values)
    value = at.format(known=known, i=f"CAST((l_partkey + {place} * l_linenumber) % {len(values)} AS INT) + 1")
    other = at.format(known=known, i=f"CAST((l_suppkey + {place}) % {len(values)} AS INT) + 1")
    return (
        f"CASE WHEN l_discount >= 0.09 THEN {value} || ' , ' || {other} "
        f"WHEN l_quantity > 40 THEN upper(replace({value}, '_', ' ')) "
        f"WHEN l_tax >= 0.08 THEN 'x-' || {value} WHEN l_tax >= 0.07 THEN 'zzz' ELSE {value} END"
    )


_SQL_LINE_CELLS = ", ".join(
    f"{_line_cell(values, i, '[{known}][{i}]')} AS {field}"
    for i, (field, values) in enumerate(VOCABULARY.items())
)


def _sql_checked(field: str) -> str:
    hit = sql_hit("t", VOCABULARY[field])
    pairs = f"list_transform({sql_tokens(field)}, lambda t: {{'t': t, 'h': {hit}}})"
    warning = (
        f"CASE WHEN p.h IS NULL THEN '{field}: ''' || p.t || ''' NOT in vocabulary' "
        f"WHEN p.h <> p.t THEN '{field}: ''' || p.t || ''' → fuzzy matched to ''' || p.h || '''' END"
    )
    return (
        f"array_to_string(list_transform({pairs}, lambda p: coalesce(p.h, p.t)), ',') AS {field}, "
        f"list_filter(list_transform({pairs}, lambda p: {warning}), lambda w: w IS NOT NULL) AS w_{field}"
    )


@query(
    f"""
    WITH c AS (SELECT l_orderkey, l_linenumber, {_SQL_LINE_CELLS} FROM lineitem),
    v AS (SELECT l_orderkey, l_linenumber, {", ".join(map(_sql_checked, VOCABULARY))} FROM c),
    w AS (SELECT *, flatten([{", ".join(f"w_{f}" for f in VOCABULARY)}]) AS warns FROM v)
    SELECT l_orderkey, l_linenumber, {", ".join(VOCABULARY)},
           CASE WHEN len(warns) > 0 THEN 'medium' ELSE 'high' END AS confidence,
           CASE WHEN len(warns) > 0 THEN 'VALIDATION: ' || array_to_string(warns, '; ') ELSE '' END
               AS confidence_notes
    FROM w
    """
)
def driving_rows(spark, folder):
    """All twelve driving fields of every order line, with every kind of cell."""
    cells = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        *[
            f"{_line_cell(values, i, 'elt({i}, {known})')} AS {field}"
            for i, (field, values) in enumerate(VOCABULARY.items())
        ],
        "'high' AS confidence",
    )
    return va.validate_rows(cells).drop("warnings")


@query(
    """
    SELECT p_partkey, 'tags' AS field, unnest(string_split(p_type || ',' || p_brand, ',')) AS value
    FROM part
    UNION ALL SELECT p_partkey, 'p_name', p_name FROM part
    """
)
def long_view(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey", F.concat_ws(",", "p_type", "p_brand").alias("tags"), "p_name"
    )
    return va.long_view(parts, ["p_partkey"], ["tags", "p_name"])


# ---- counts and rules -------------------------------------------------------


def rated_labels(spark: SparkSession, folder: str) -> DataFrame:
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    level = F.when(good & ~toxic, "high").when(good, "low").when(toxic, "unsure").otherwise("medium")
    return _checked_labels(spark, folder).select(level.alias("confidence"), "state")


@query(
    """
    WITH t AS (
        SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'high' WHEN quality = 1 THEN 'low'
                    WHEN toxic = 1 THEN 'unsure' ELSE 'medium' END AS level, toxic
        FROM labels)
    SELECT count(*) AS rows, count(*) FILTER (level = 'high') AS high,
           count(*) FILTER (level = 'medium') AS medium, count(*) FILTER (level = 'low') AS low,
           count(*) FILTER (level = 'unsure') AS other, count(*) FILTER (toxic = 1) AS errors
    FROM t
    """
)
def confidence_summary(spark, folder):
    return qa.summary(rated_labels(spark, folder), marker="state")


@query(SQL["confidence_summary"])
def observed_summary(spark, folder):
    """The same counts, taken while the rows are written elsewhere."""
    seen = Observation("summary")
    rows = qa.observed(rated_labels(spark, folder), seen, marker="state")
    rows.write.parquet(shared_folder(spark, "observed_summary"))
    return spark.createDataFrame([seen.get])


LINE_VOCABULARY = {
    "flag": ["return", "accept", "none"],
    "state": ["open", "none"],
    "offer": ["discount", "none"],
    "tax": ["taxed", "none"],
}
LINE_GROUPS = {"maneuver": ["flag"], "environment": ["state"], "agent": ["offer", "tax"]}

_SQL_LINES = """
    SELECT l_orderkey AS key,
           CASE l_returnflag WHEN 'R' THEN 'return' WHEN 'A' THEN 'accept' ELSE 'none' END AS flag,
           CASE l_linestatus WHEN 'O' THEN 'open' ELSE 'filled' END AS state,
           CASE WHEN l_discount = 0 THEN 'none' ELSE 'discount' END AS offer,
           CASE WHEN l_tax > 0.05 THEN 'taxed' ELSE 'none' END AS tax,
           CASE WHEN l_quantity <= 10 THEN 'high' WHEN l_quantity <= 30 THEN 'medium'
                WHEN l_quantity <= 45 THEN 'low' ELSE 'unsure' END AS confidence,
           CASE WHEN l_tax = 0 THEN 'no tax' ELSE '' END AS notes
    FROM lineitem
"""


def _described_lines(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") == "R", "return")
        .when(F.col("l_returnflag") == "A", "accept")
        .otherwise("none")
        .alias("flag"),
        F.when(F.col("l_linestatus") == "O", "open").otherwise("filled").alias("state"),
        F.when(F.col("l_discount") == 0, "none").otherwise("discount").alias("offer"),
        F.when(F.col("l_tax") > 0.05, "taxed").otherwise("none").alias("tax"),
        F.when(quantity <= 10, "high")
        .when(quantity <= 30, "medium")
        .when(quantity <= 45, "low")
        .otherwise("unsure")
        .alias("confidence"),
        F.when(F.col("l_tax") == 0, "no tax").otherwise("").alias("confidence_notes"),
    )


@query(
    f"""
    WITH t AS ({_SQL_LINES})
    SELECT 'details_without_agent' AS rule, key, 'tax=' || tax AS detail FROM t
    WHERE offer = 'none' AND tax <> 'none'
    UNION ALL SELECT 'high_with_notes', key, notes FROM t WHERE confidence = 'high' AND notes <> ''
    UNION ALL SELECT 'unknown_confidence', key, confidence FROM t WHERE confidence = 'unsure'
    UNION ALL SELECT 'out_of_vocabulary', key, 'state=filled' FROM t WHERE state = 'filled'
    UNION ALL SELECT 'no_maneuver', key, NULL FROM t GROUP BY key HAVING bool_and(flag = 'none')
    UNION ALL SELECT 'differing_context', key, NULL FROM t GROUP BY key
              HAVING count(DISTINCT flag || '|' || state) > 1
    """
)
def rule_violations(spark, folder):
    return qa.check_rules(
        _described_lines(spark, folder), "l_orderkey", LINE_VOCABULARY, LINE_GROUPS
    )


# ---- structured answers -----------------------------------------------------


@query(
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, true AS props_ok FROM events
    """
)
def props_decode(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props")
    decoded = rs.parse_json(events, "props", "k int", "found")
    return decoded.select("event_id", "found.k", F.col("found_ok").alias("props_ok"))


LABEL_VOCABULARY = {"quality": ["good", "poor", "none"], "tone": ["toxic", "none"]}


def _answer_row(tone: Column) -> Column:
    return F.struct(
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("quality"),
        tone.alias("tone"),
        F.lit("high").alias("confidence"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("confidence_notes"),
    )


@query(
    """
    SELECT doc_id, 'ok' AS status, 'good' AS quality, 'none' AS tone, 'high' AS confidence,
           'doc ' || doc_id AS confidence_notes
    FROM labels WHERE quality = 1 AND toxic = 0
    UNION ALL
    SELECT doc_id, 'ok', 'poor', unnest(['none', 'toxic']), 'high', 'doc ' || doc_id
    FROM labels WHERE quality = 0 AND toxic = 0
    UNION ALL
    SELECT doc_id, CASE quality WHEN 1 THEN 'no_rows' ELSE 'bad_json' END, NULL, NULL, NULL, NULL
    FROM labels WHERE toxic = 1
    """
)
def response_rows(spark, folder):
    none, toxic = _answer_row(F.lit("none")), _answer_row(F.lit("toxic"))
    rows = F.when(F.col("quality") == 1, F.array(none)).otherwise(F.array(none, toxic))
    whole = F.to_json(F.struct(rows.alias("rows")))
    answer = (
        F.when(F.col("toxic") == 0, whole)
        .when(F.col("quality") == 1, '{"rows": []}')
        .otherwise(F.substring(whole, F.lit(1), F.length(whole) - 3))
    )
    answers = table(spark, folder, "labels").select("doc_id", answer.alias("answer"))
    return rs.decode_responses(answers, ["doc_id"], "answer", LABEL_VOCABULARY)


@query(
    """
    SELECT doc_id, CASE source
        WHEN 'src0' THEN 'bad_json' WHEN 'src1' THEN 'extra' WHEN 'src2' THEN 'no_rows'
        WHEN 'src3' THEN 'missing' WHEN 'src4' THEN 'extra' WHEN 'src5' THEN 'bad_type'
        WHEN 'src6' THEN 'bad_type' WHEN 'src7' THEN 'bad_confidence' WHEN 'src8' THEN 'bad_json'
        WHEN 'src9' THEN 'no_rows' ELSE 'ok' END AS status
    FROM documents
    """
)
def response_conformance(spark, folder):
    vocab = {"lang": ["en", "de", "fr", "es", "none"]}
    return rs.check_responses(planted_answers(spark, folder), ["doc_id"], "answer", vocab)


def planted_answers(spark: SparkSession, folder: str) -> DataFrame:
    """An answer per document, with a fault of every kind for one source each."""

    def answer(row: str, top: str = "") -> Column:
        before, after = f'{{"rows": [{row}]{top}}}'.split("LANG")
        return F.concat(F.lit(before), F.col("lang"), F.lit(after))

    def row(level: str = '"high"', notes: str = ', "confidence_notes": ""', more: str = "") -> str:
        return f'{{"lang": "LANG", "confidence": {level}{notes}{more}}}'

    faults = {
        "src0": F.concat(F.lit("Answer: "), answer(row())),
        "src1": answer(row(), ', "note": "x"'),
        "src2": F.lit('{"rows": []}'),
        "src3": answer(row(notes="")),
        "src4": answer(row(more=', "why": "x"')),
        "src5": answer(row(level="1")),
        "src6": answer(row(notes=', "confidence_notes": null')),
        "src7": answer(row(level='"sure"')),
        "src8": F.concat(answer(row()), F.lit(" Done.")),
        "src9": F.lit("{}"),
    }
    text = answer(row())
    for source, fault in faults.items():
        text = F.when(F.col("source") == source, fault).otherwise(text)
    return table(spark, folder, "documents").select("doc_id", text.alias("answer"))


# ---- prompts and requests ---------------------------------------------------

_VOCABULARY_COLUMNS = [
    ("events", "event_type"),
    ("orders", "o_orderstatus"),
    ("orders", "o_orderpriority"),
    ("part", "p_type"),
    ("customer", "c_mktsegment"),
]


@query(
    " UNION ALL ".join(
        f"""
        SELECT '{column}' AS field,
               '  {column}: [' || string_agg(value, ', ' ORDER BY value) || ']' AS line
        FROM (SELECT DISTINCT {column} AS value FROM {name})
        """
        for name, column in _VOCABULARY_COLUMNS
    )
)
def vocab_block(spark, folder):
    values = None
    for name, column in _VOCABULARY_COLUMNS:
        found = table(spark, folder, name).select(
            F.lit(column).alias("field"), F.col(column).alias("value")
        )
        values = found.distinct() if values is None else values.unionByName(found.distinct())
    position = F.row_number().over(Window.partitionBy("field").orderBy("value"))
    return pr.vocabulary_lines(values.withColumn("position", position))


@query(
    """
    WITH n AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1)
    SELECT r_name AS region,
           string_agg('  - **' || n_name || '**: ' || customers || ' customers', chr(10)
                      ORDER BY n_nationkey) AS block
    FROM nation JOIN region ON n_regionkey = r_regionkey JOIN n ON c_nationkey = n_nationkey
    GROUP BY 1
    """
)
def definition_block(spark, folder):
    customers = table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    text = F.concat(F.col("customers").cast("string"), F.lit(" customers"))
    definitions = nations.join(customers.agg(F.count("*").alias("customers")), "n_nationkey").select(
        F.col("r_name").alias("region"), "n_nationkey", "n_name", text.alias("text")
    )
    return pr.definition_blocks(definitions, "region", "n_nationkey", "n_name", "text")


_SQL_PROMPT = (
    "'Parse the following CoC reasoning trace into the ontology.' || chr(10) || chr(10) || "
    "'Clip ID: ' || doc_id || chr(10) || 'Reasoning Trace: \"' || text || '\"' "
    "|| chr(10) || chr(10) || "
)


@query(
    f"""
    SELECT doc_id, {_SQL_PROMPT} 'Return the parsed JSON.' AS json_prompt,
           {_SQL_PROMPT} 'Call the submit_ontology_parse tool with the parsed result.' AS tool_prompt
    FROM documents
    """
)
def prompt_column(spark, folder):
    key, text = F.col("doc_id"), F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        pr.prompt(key, text, pr.CLOSING_JSON).alias("json_prompt"),
        pr.prompt(key, text, pr.CLOSING_TOOL).alias("tool_prompt"),
    )


def _as_lines(messages: str | Column) -> Column:
    return F.array_join(
        F.transform(messages, lambda m: F.concat_ws(": ", m["role"], m["content"])), "\n"
    )


_SQL_CHATS = """
    WITH t AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos
        FROM conversations)
    SELECT conv_id, CAST(pos // 4 * 4 AS INTEGER) AS start, count(*) AS n,
           string_agg(role || ': ' || text, chr(10) ORDER BY pos) AS chat
    FROM t GROUP BY conv_id, pos // 4
"""


@query(_SQL_CHATS)
def chat_messages(spark, folder):
    return _chats(pr.messages_from_turns(table(spark, folder, "conversations"), ["conv_id"], max_turns=4))


@query(_SQL_CHATS)
def chat_messages_cut(spark, folder):
    """The same, with conversations of more than seven turns cut into ranges."""
    turns = table(spark, folder, "conversations")
    return _chats(pr.messages_from_turns(turns, ["conv_id"], max_turns=4, hot_rows=7))


def _chats(chats: DataFrame) -> DataFrame:
    return chats.select(
        "conv_id",
        F.col("start").cast("int").alias("start"),
        F.size("messages").cast("bigint").alias("n"),
        _as_lines("messages").alias("chat"),
    )


@query(
    """
    WITH t AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos
        FROM conversations)
    SELECT conv_id, (pos - 1) // 4 * 4 AS start,
           string_agg(role || ': ' || CASE pos WHEN 1 THEN 'Go on from here.' ELSE text END, chr(10)
                      ORDER BY pos) AS chat
    FROM t GROUP BY conv_id, (pos - 1) // 4
    """
)
def first_message_override(spark, folder):
    chats = pr.messages_from_turns(table(spark, folder, "conversations"), ["conv_id"], max_turns=4)
    changed = pr.with_first_text(F.col("messages"), F.lit("Go on from here."), F.col("start"))
    return chats.select("conv_id", F.col("start").cast("bigint").alias("start"), _as_lines(changed).alias("chat"))


@query(
    f"""
    SELECT doc_id, 'any-model' AS model, 4096 AS max_tokens, 'system' AS first_role,
           {_SQL_PROMPT} 'Return the parsed JSON.' AS content, 'ontology_parse' AS format_name
    FROM documents
    """
)
def request_payload(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    body = pr.request_body(
        pr.prompt(F.col("doc_id"), F.col("text")), "Label the text.", "any-model"
    )
    custom = F.concat(
        F.lit('{"custom_id": "'), F.col("doc_id").cast("string"), F.lit('", "body": '), body, F.lit("}")
    )
    path = shared_folder(spark, "request_payload")
    files.write_lines(docs.select(custom.alias("line")), "line", path)
    requests = spark.read.schema(
        "custom_id string, body struct<model: string, max_tokens: int, "
        "messages: array<struct<role: string, content: string>>, "
        "response_format: struct<json_schema: struct<name: string>>>"
    ).json(path)
    return requests.select(
        F.col("custom_id").cast("bigint").alias("doc_id"),
        "body.model",
        "body.max_tokens",
        F.col("body.messages")[0]["role"].alias("first_role"),
        F.col("body.messages")[1]["content"].alias("content"),
        F.col("body.response_format.json_schema.name").alias("format_name"),
    )


@query("SELECT doc_id, text AS trace FROM documents")
def unwrap_trace(spark, folder):
    quote = F.when(F.col("lang") == "en", '"').when(F.col("lang") == "de", "").otherwise("'")
    wrapped = F.when(quote == "", F.col("text")).otherwise(
        F.concat(F.lit("[["), quote, "text", quote, F.lit("]]"))
    )
    docs = table(spark, folder, "documents").select("doc_id", wrapped.alias("trace"))
    return docs.select("doc_id", unwrapped("trace").alias("trace"))


# ---- annotation -------------------------------------------------------------

DOCUMENT_RULES = [
    ("notice", r"(?i)license", "license"),
    ("contact", r"[\w.]@[\w.]", "mail"),
    ("contact", r"\d{3}[- ]\d{3,4}", "number"),
]
PAGE_RULES = [
    ("paging", r"page=\d+", "paged"),
    ("markup", r"&amp;", "entity"),
    ("markup", r"<table", "table"),
]


@query(
    r"""
    WITH t AS (
        SELECT 'document' AS kind, doc_id AS id,
               CASE WHEN regexp_matches(text, '(?i)license') THEN 'license' END AS a,
               CASE WHEN regexp_matches(text, '[\w.]+@[\w.]+') THEN 'mail' END AS b,
               CASE WHEN regexp_matches(text, '\d{3}[- ]\d{3,4}') THEN 'number' END AS c
        FROM documents
        UNION ALL
        SELECT 'page', page_id,
               CASE WHEN regexp_matches(url || ' ' || html, 'page=\d+') THEN 'paged' END,
               CASE WHEN regexp_matches(url || ' ' || html, '&amp;') THEN 'entity' END,
               CASE WHEN regexp_matches(url || ' ' || html, '<table') THEN 'table' END
        FROM pages)
    SELECT kind, id, coalesce(a, 'none') AS first_field,
           CASE WHEN b IS NULL AND c IS NULL THEN 'none' ELSE concat_ws(',', b, c) END AS second_field
    FROM t
    """
)
def rule_labels(spark, folder):
    docs = an.label_by_rules(table(spark, folder, "documents"), "text", DOCUMENT_RULES)
    pages = table(spark, folder, "pages").select(
        "page_id", F.concat_ws(" ", "url", "html").alias("text")
    )
    pages = an.label_by_rules(pages, "text", PAGE_RULES)

    def named(df: DataFrame, kind: str, key: str, first: str, second: str) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"),
            F.col(key).alias("id"),
            F.array_join(first, ",").alias("first_field"),
            F.array_join(second, ",").alias("second_field"),
        )

    return named(docs, "document", "doc_id", "notice", "contact").unionByName(
        named(pages, "page", "page_id", "paging", "markup")
    )


DOCUMENT_VOCABULARY = {"lang": ["en", "de", "fr", "es", "none"], "size": ["long", "short", "none"]}


def _no_pause(seconds: float) -> None:
    pass


def _answer_document(fails: dict[str, int], empty: dict[str, int]) -> Callable[[dict], dict]:
    """An annotator whose first calls fail, or answer nothing, for some languages."""
    calls: dict[int, int] = {}

    def answer(row: dict) -> dict:
        key, lang = row["doc_id"], row["lang"]
        call = calls[key] = calls.get(key, 0) + 1
        if call <= fails.get(lang, 0):
            raise ConnectionError("no answer")
        if call <= fails.get(lang, 0) + empty.get(lang, 0):
            return {"rows": []}
        size = "long" if len(row["text"]) > 2000 else "Shor"
        return {"rows": [{"lang": lang.upper(), "size": size, "confidence": "high"}]}

    return answer


@query(
    """
    SELECT doc_id, CASE lang WHEN 'es' THEN 'PARSE_ERROR' ELSE upper(lang) END AS lang,
           CASE WHEN lang = 'es' THEN 'PARSE_ERROR' WHEN length(text) > 2000 THEN 'long'
                ELSE 'Shor' END AS size,
           CASE lang WHEN 'es' THEN 'low' ELSE 'high' END AS confidence,
           CASE lang WHEN 'es' THEN 'Failed after 3 attempts' END AS confidence_notes,
           CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 3 END AS attempts,
           CASE lang WHEN 'es' THEN 'failed' ELSE 'ok' END AS status
    FROM documents
    """
)
def batch_annotate(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    answer = _answer_document({"de": 1, "es": 3}, {"fr": 2})
    rows = an.annotate(docs, ["doc_id"], answer, DOCUMENT_VOCABULARY, sleep=_no_pause)
    return rows.drop("error")


@query(
    """
    SELECT doc_id, lang, CASE WHEN length(text) > 2000 THEN 'long' ELSE 'short' END AS size,
           CASE WHEN length(text) > 2000 THEN 'high' ELSE 'medium' END AS confidence,
           CASE WHEN length(text) > 2000 THEN ''
                ELSE 'VALIDATION: size: ''shor'' → fuzzy matched to ''short''' END
               AS confidence_notes
    FROM documents
    """
)
def annotation_repair(spark, folder):
    """Annotate all documents, some of which fail; then repair and merge those."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")

    def answer(fail: str) -> Callable[[dict], dict]:
        def of(row: dict) -> dict:
            lang, _, text = row["text"].partition(" ")
            if lang == fail:
                raise ConnectionError("no answer")
            size = "long" if len(text) > 2000 else "Shor"
            return {"rows": [{"lang": lang.upper(), "size": size, "confidence": "high"}]}

        return of

    told = docs.select("doc_id", F.concat_ws(" ", "lang", "text").alias("text"))
    common = {
        "folder": shared_folder(spark, "annotation_repair"),
        "key": "doc_id",
        "text": "text",
        "vocab": DOCUMENT_VOCABULARY,
        "sleep": _no_pause,
    }
    first = Annotation(answer=answer("es"), **common)
    second = Annotation(answer=answer(""), **common)
    return second.repair(first.run(told, "first"), told, "second")


_MANY_CHARS = 5000


def _count_spaces(row: dict) -> dict:
    if len(row["text"]) > _MANY_CHARS:
        raise ValueError("too long")
    return {"spaces": row["text"].count(" ")}


def _predicted(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return an.predict(docs, ["doc_id"], _count_spaces, "spaces bigint")


_SQL_PREDICTED = """
    SELECT doc_id, CASE WHEN length(text) <= 5000
                        THEN length(text) - length(replace(text, ' ', '')) END AS spaces,
           CASE WHEN length(text) <= 5000 THEN 'Success' ELSE 'Error: too long' END AS status
    FROM documents
"""


@query(_SQL_PREDICTED)
def predicted_rows(spark, folder):
    return _predicted(spark, folder)


@query(f"SELECT status, count(*) AS n FROM ({_SQL_PREDICTED}) GROUP BY 1")
def status_summary(spark, folder):
    return qa.counts(_predicted(spark, folder))


@query("SELECT role, count(*) AS n FROM conversations GROUP BY 1")
def incremental_ingest(spark, folder):
    """Ingest twice: the second run finds nothing new and adds no row."""
    base = shared_folder(spark, "incremental_ingest")
    schema = table(spark, folder, "conversations").schema
    for _ in range(2):
        process_new_files(
            spark,
            f"{folder}/conversations*.parquet",
            schema,
            f"{base}/turns",
            f"{base}/progress",
            lambda turns: rw.non_blank(turns, "text"),
        )
    return qa.counts(spark.read.parquet(f"{base}/turns"), "role")


@query(_SQL_PREDICTED)
def incremental_predict(spark, folder):
    """Predictions over a folder, committed step by step; a second run finds nothing to do."""
    base = shared_folder(spark, "incremental_predict")
    schema = table(spark, folder, "documents").schema
    for _ in range(2):
        process_new_files(
            spark,
            f"{folder}/documents*.parquet",
            schema,
            f"{base}/results",
            f"{base}/progress",
            lambda docs: an.predict(
                docs.select("doc_id", "text"), ["doc_id"], _count_spaces, "spaces bigint"
            ),
            max_files=5,
        )
    return spark.read.parquet(f"{base}/results")


# ---- trajectories -----------------------------------------------------------


def _trajectories(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Vectors as 32 points, first half x and second half y: ``(samples, truth)`` per label.

    The vector with the lowest id of a label is its truth, the others are samples.
    """
    vectors = table(spark, folder, "embeddings")
    half = F.lit(32)
    points = F.zip_with(
        F.slice("embedding", F.lit(1), half),
        F.slice("embedding", half + 1, half),
        lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")),
    )
    lowest = vectors.groupBy("label").agg(
        F.min("vec_id").alias("truth_id"), F.min_by("embedding", "vec_id").alias("embedding")
    )
    return (
        vectors.select("label", "vec_id", points.alias("points")),
        lowest.select("label", "truth_id", points.alias("points")),
    )


_SQL_ADE = """
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    p AS (SELECT vec_id, label, unnest(range(1, 33)) AS step, e FROM v),
    q AS (SELECT vec_id, label, step, e[step] AS x, e[step + 32] AS y FROM p),
    t AS (SELECT label, min(vec_id) AS truth_id FROM v GROUP BY 1),
    a AS (
        SELECT q.label, q.vec_id, avg(sqrt((q.x - g.x) * (q.x - g.x) + (q.y - g.y) * (q.y - g.y))) AS ade
        FROM q JOIN t ON q.label = t.label AND q.vec_id <> t.truth_id
        JOIN q g ON g.vec_id = t.truth_id AND g.step = q.step
        GROUP BY 1, 2)
"""


@query(f"{_SQL_ADE} SELECT label, vec_id, round(ade, 6) AS ade FROM a")
def ade(spark, folder):
    predicted, truth = _trajectories(spark, folder)
    ids = truth.select("label", "truth_id")
    errors = tr.ade(tr.to_steps(predicted), tr.to_steps(truth), ["label"], "vec_id")
    others = rc.missing(errors, ids.withColumnRenamed("truth_id", "vec_id"), "vec_id")
    return others.select("label", "vec_id", F.round("ade", 6).alias("ade"))


@query(f"{_SQL_ADE} SELECT label, round(min(ade), 6) AS min_ade FROM a GROUP BY 1")
def min_ade(spark, folder):
    predicted, truth = _trajectories(spark, folder)
    errors = tr.ade_arrays(predicted, truth, ["label"])
    others = rc.missing(
        errors.select("label", "vec_id", "ade"), truth.select(F.col("truth_id").alias("vec_id")), "vec_id"
    )
    return tr.min_ade(others, ["label"]).select("label", F.round("min_ade", 6).alias("min_ade"))


@query(
    """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT vec_id, step, -e[step + 33] AS x, e[step + 1] AS y
    FROM (SELECT vec_id, e, unnest(range(0, 32)) AS step FROM v)
    """
)
def rotate_points(spark, folder):
    predicted, _ = _trajectories(spark, folder)
    points = tr.rotate(tr.to_steps(predicted))
    return points.select("vec_id", F.col("step").cast("bigint").alias("step"), "x", "y")


_SQL_VECTOR_SERIES = """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    p AS (SELECT vec_id, e, unnest(range(1, 33)) AS step FROM v),
    d AS (
        SELECT vec_id, step, e[step] - lag(e[step]) OVER w AS dx, e[step + 32] - lag(e[step + 32]) OVER w AS dy
        FROM p WINDOW w AS (PARTITION BY vec_id ORDER BY step)),
    s AS (SELECT vec_id, step, sqrt(dx * dx + dy * dy) / 0.1::DOUBLE AS speed FROM d),
    a AS (
        SELECT vec_id, step, speed,
               (speed - lag(speed) OVER (PARTITION BY vec_id ORDER BY step)) / 0.1::DOUBLE AS acc
        FROM s)
"""


@query(
    f"""
    {_SQL_VECTOR_SERIES}
    SELECT vec_id, count(speed) AS n_speeds, count(acc) AS n_accelerations,
           round(sum(speed), 6) AS speed_sum, round(sum(acc), 5) AS acceleration_sum,
           count(*) FILTER (acc > 0) AS n_throttle
    FROM a GROUP BY 1
    """
)
def vector_series(spark, folder):
    """The array layout: no shuffle at all."""
    predicted, _ = _trajectories(spark, folder)

    def total(values: str) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda so_far, x: so_far + x)

    series = tr.add_series(predicted.select("vec_id", "points"))
    return series.select(
        "vec_id",
        F.size("speeds").cast("bigint").alias("n_speeds"),
        F.size("accelerations").cast("bigint").alias("n_accelerations"),
        F.round(total("speeds"), 6).alias("speed_sum"),
        F.round(total("accelerations"), 5).alias("acceleration_sum"),
        F.size(F.filter("accelerations", lambda a: a > 0)).cast("bigint").alias("n_throttle"),
    )


_SQL_SERIES = """
    WITH d AS (
        SELECT user_id, event_id, row_number() OVER w - 1 AS position, value - lag(value) OVER w AS dx
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sqrt(dx * dx) AS distance, sqrt(dx * dx) / {dt} AS speed FROM d),
    a AS (
        SELECT *, (speed - lag(speed) OVER (PARTITION BY user_id ORDER BY position)) / {dt} AS acc
        FROM s),
    c AS (
        SELECT *, CASE WHEN acc > 0 THEN least(acc / 3.0, 1.0) ELSE 0.0 END AS throttle,
               CASE WHEN acc > 0 THEN 0.0 ELSE least(abs(acc) / 5.0, 1.0) END AS brake
        FROM a)
"""
_SQL_STEPS = _SQL_SERIES.format(dt="0.1::DOUBLE")
# Event values jump by hundreds; over a longer step the controls spread over their whole range.
_SLOW = 7.0
_SQL_SLOW_STEPS = _SQL_SERIES.format(dt="7.0::DOUBLE")


def _event_series(spark: SparkSession, folder: str, dt: float, **how) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "value")
    return tr.kinematics(events, ["user_id"], ["ts", "event_id"], ["value"], dt, **how)


@query(
    f"""
    {_SQL_STEPS}
    SELECT user_id, event_id, position, round(dx, 6) AS step, round(speed, 6) AS speed,
           round(acc, 5) AS acceleration
    FROM c WHERE position > 0
    """
)
def step_speed(spark, folder):
    return event_steps(_event_series(spark, folder, tr.STEP_SECONDS))


@query(SQL["step_speed"])
def step_speed_cut(spark, folder):
    """The same, with users of more than 75 events cut into ranges."""
    return event_steps(_event_series(spark, folder, tr.STEP_SECONDS, hot_rows=75))


def event_steps(series: DataFrame) -> DataFrame:
    return series.select(
        "user_id",
        "event_id",
        F.col("position").cast("bigint").alias("position"),
        F.round("dvalue", 6).alias("step"),
        F.round("speed", 6).alias("speed"),
        F.round("acceleration", 5).alias("acceleration"),
    )


@query(
    f"""
    {_SQL_SLOW_STEPS}
    SELECT user_id, count(*) AS n, round(sum(throttle), 6) AS throttle_sum,
           round(sum(brake), 6) AS brake_sum,
           count(*) FILTER (throttle > 0 AND throttle < 1) AS n_partial
    FROM c WHERE position > 1 GROUP BY 1
    """
)
def throttle_brake(spark, folder):
    series = _event_series(spark, folder, _SLOW).filter("position > 1")
    return series.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.round(F.sum("throttle"), 6).alias("throttle_sum"),
        F.round(F.sum("brake"), 6).alias("brake_sum"),
        F.count_if((F.col("throttle") > 0) & (F.col("throttle") < 1)).alias("n_partial"),
    )


_SQL_LISTS = f"""
    {_SQL_STEPS}
    SELECT user_id, (position - 2) // 10 * 10 AS start, count(*) AS n,
           string_agg(CAST(CAST(round(round_even(throttle, 2) * 100) AS INTEGER) AS VARCHAR), ',' ORDER BY position) AS speeds,
           string_agg(CAST(CAST(round(round_even(brake, 2) * 100) AS INTEGER) AS VARCHAR), ',' ORDER BY position) AS brakes
    FROM c WHERE position > 1 GROUP BY user_id, (position - 2) // 10
"""


def _control_lists(spark: SparkSession, folder: str, **how) -> DataFrame:
    """Lists of ten values each, as whole percents."""
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "value")
    lists = tr.control_lists(events, ["user_id"], ["ts", "event_id"], ["value"], list_rows=10, **how)

    def percents(values: str) -> Column:
        return F.array_join(F.transform(values, lambda v: F.round(v * 100).cast("int").cast("string")), ",")

    return lists.select(
        "user_id",
        F.col("start").cast("bigint").alias("start"),
        F.size("speed_control").cast("bigint").alias("n"),
        percents("speed_control").alias("speeds"),
        percents("brake_control").alias("brakes"),
    )


@query(_SQL_LISTS)
def control_lists(spark, folder):
    return _control_lists(spark, folder)


@query(_SQL_LISTS)
def control_lists_cut(spark, folder):
    """The same, with users of more than 75 events cut into ranges."""
    return _control_lists(spark, folder, hot_rows=75)


# ---- requests and answers in files --------------------------------------------


@query(
    f"""
    SELECT doc_id, 'json_schema' AS style, 'system' AS first_role, 2 AS n_messages,
           {_SQL_PROMPT} 'Return the parsed JSON.' AS content, 'ontology_parse' AS shape
    FROM documents
    UNION ALL
    SELECT doc_id, 'tool', 'user', 1,
           {_SQL_PROMPT} 'Call the submit_ontology_parse tool with the parsed result.', 'submit_ontology_parse'
    FROM documents
    """
)
def batch_requests(spark, folder):
    """The request files of both styles, written and read again by id."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = None
    for style in "json_schema", "tool":
        run = OfflineAnnotation(
            shared_folder(spark, "batch_requests"), "Label it.", "any-model", style, "doc_id", "text", DOCUMENT_VOCABULARY
        )
        lines = spark.read.schema(
            "custom_id string, body struct<messages: array<struct<role: string, content: string>>, "
            "response_format: struct<json_schema: struct<name: string>>, tool_choice: struct<name: string>>"
        ).json(run.requests(docs, "first"))
        messages = F.col("body.messages")
        read = lines.select(
            F.col("custom_id").cast("bigint").alias("doc_id"),
            F.lit(style).alias("style"),
            messages[0]["role"].alias("first_role"),
            F.size(messages).alias("n_messages"),
            F.element_at(messages, -1)["content"].alias("content"),
            F.coalesce("body.response_format.json_schema.name", "body.tool_choice.name").alias("shape"),
        )
        found = read if found is None else found.union(read)
    return found


def _answer_file(spark: SparkSession, docs: DataFrame, style: str, path: str, faulty: bool) -> str:
    """Answer lines as a service would write them; if ``faulty``, in every way that an answer can fail."""
    row = F.struct(
        F.upper("lang").alias("lang"),
        F.when(F.length("text") > 2000, "long").otherwise("Shor").alias("size"),
        F.lit("high").alias("confidence"),
        F.lit("").alias("confidence_notes"),
    )
    good = F.to_json(F.struct(F.array(row).alias("rows")))
    kind = F.pmod(F.col("doc_id"), F.lit(10))
    answer = good
    if faulty:
        for i, text in enumerate(['{"rows": []}', '{"rows": [null]}', '{"rows": [{"lang": 1}]}', "Sorry, I cannot."]):
            answer = F.when(kind == i + 1, text).otherwise(answer)
        if style == "json_schema":  # a tool's input is an object already, so a key cannot be there twice
            answer = F.when(kind == 6, F.replace(good, F.lit('"size"'), F.lit('"lang":"en","size"'))).otherwise(answer)
    if style == "json_schema":
        message = F.struct(F.struct(answer.alias("content")).alias("message"))
        body = F.to_json(F.struct(F.array(message).alias("choices")))
        body = F.when(kind == 5, '{"choices": []}').otherwise(body) if faulty else body
        wrapped = [F.lit('", "response": {"body": '), body, F.lit("}}")]
    else:
        tool = F.lit(f'{{"type": "text", "text": "Well."}}, {{"type": "tool_use", "name": "{TOOL_NAME}", "input": ')
        call = F.concat(tool, F.when(kind == 4, '"none"').otherwise(answer) if faulty else answer, F.lit("}"))
        other = '{"type": "tool_use", "name": "another_tool", "input": {}}'
        blocks = F.when(kind == 5, other).otherwise(call) if faulty else call
        wrapped = [F.lit('", "result": {"message": {"content": ['), blocks, F.lit("]}}}")]
    line = F.concat(F.lit('{"custom_id": "'), F.col("doc_id").cast("string"), *wrapped)
    told = docs.filter(kind != 7) if faulty else docs
    files.write_lines(told.select(line.alias("line")), "line", path)
    return path


_SQL_OFFLINE_GOOD = """
    CASE WHEN length(text) > 2000 THEN 'high' ELSE 'medium' END AS confidence,
    CASE WHEN length(text) > 2000 THEN '' ELSE 'VALIDATION: size: ''shor'' → fuzzy matched to ''short''' END
        AS confidence_notes
"""


@query(
    f"""
    WITH s AS (
        SELECT *, CASE doc_id % 10 WHEN 1 THEN 'no_rows' WHEN 2 THEN 'bad_type' WHEN 3 THEN 'bad_type'
                       WHEN 4 THEN 'bad_json' WHEN 5 THEN 'no_answer' WHEN 6 THEN 'bad_json'
                       WHEN 7 THEN 'no_answer' ELSE 'ok' END AS told
        FROM documents),
    g AS (SELECT style, doc_id, CASE WHEN style = 'tool' AND doc_id % 10 = 6 THEN 'ok' ELSE told END AS status, lang, CASE WHEN length(text) > 2000 THEN 'long' ELSE 'short' END AS size,
                 {_SQL_OFFLINE_GOOD} FROM s, (SELECT unnest(['json_schema', 'tool']) AS style)),
    f AS (SELECT style, doc_id, status, lang, size, confidence, confidence_notes FROM g WHERE status = 'ok'
          UNION ALL SELECT style, doc_id, status, 'PARSE_ERROR', 'PARSE_ERROR', 'low', 'Failed after 1 attempts'
          FROM g WHERE status <> 'ok')
    SELECT style, 'first' AS round, doc_id, status, lang, size, confidence, confidence_notes FROM f
    UNION ALL
    SELECT style, 'merged', doc_id, 'ok', lang, size, confidence, confidence_notes FROM g
    """
)
def offline_annotation(spark, folder):
    """Requests, answers with faults, a table with dead letters, a second round for those, the merged table."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = None
    for style in "json_schema", "tool":
        base = shared_folder(spark, "offline_annotation")
        run = OfflineAnnotation(base, "Label it.", "any-model", style, "doc_id", "text", DOCUMENT_VOCABULARY)
        run.requests(docs, "first")
        first_answers = _answer_file(spark, docs, style, f"{base}/first_answers", True)
        first = run.table(docs, run.answers(spark, first_answers), "first")
        again = run.failed_traces(first, docs)
        run.requests(again, "second")
        second_answers = _answer_file(spark, again, style, f"{base}/second_answers", False)
        merged = run.merge(first, run.table(again, run.answers(spark, second_answers), "second"))
        both = first.withColumn("round", F.lit("first")).unionByName(merged.withColumn("round", F.lit("merged")))
        styled = both.withColumn("style", F.lit(style))
        found = styled if found is None else found.unionByName(styled)
    return found


# ---- planted cases ------------------------------------------------------------


@query(
    """
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    t AS (SELECT label, min(vec_id) AS truth_id FROM v GROUP BY 1),
    p AS (SELECT v.vec_id, v.label, v.e, g.e AS ge, unnest(range(1, 33)) AS step
          FROM v JOIN t USING (label) JOIN v g ON g.vec_id = t.truth_id),
    s AS (SELECT * FROM p WHERE vec_id % 4 <> 1 OR step <= 8)
    SELECT label, vec_id, CASE WHEN vec_id % 4 NOT IN (1, 2) THEN
           round(avg(sqrt((e[step] - ge[step]) ** 2 + (e[step + 32] - ge[step + 32]) ** 2)), 6) END AS ade
    FROM s GROUP BY label, vec_id
    """
)
def ade_uneven(spark, folder):
    """Predictions that are too short or too long have no error value."""
    predicted, truth = _trajectories(spark, folder)
    steps = tr.to_steps(predicted).filter("vec_id % 4 <> 1 OR step < 8")
    late = tr.to_steps(predicted).filter("vec_id % 4 = 2 AND step = 0").withColumn("step", F.lit(32))
    errors = tr.ade(steps.unionByName(late), tr.to_steps(truth), ["label"], "vec_id")
    return errors.select("label", "vec_id", F.round("ade", 6).alias("ade"))


@query(
    """
    WITH t AS (SELECT doc_id, doc_id % 6 AS kind, replace(replace(text, '''', ''), '"', '') AS t FROM documents),
    w AS (SELECT *, replace(t, chr(10), '\\n') AS said FROM t)
    SELECT doc_id,
           CASE kind WHEN 0 THEN t WHEN 1 THEN 'it''s ' || t
                     WHEN 2 THEN '[[''' || said || ''', ''b'']]' WHEN 3 THEN '[[''' || said || '''], ["b"]]'
                     WHEN 4 THEN t || '''"\\' ELSE '[' || said || ']' END AS trace,
           CASE kind WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 1 END AS n_samples,
           CASE kind WHEN 1 THEN 'it''s ' || t WHEN 4 THEN t || '''"\\' WHEN 5 THEN NULL ELSE t END AS first_text
    FROM w
    """
)
def unwrap_samples(spark, folder):
    """One text is unwrapped, escapes undone; lists of several texts stay as they are and are parsed."""
    text = F.replace(F.replace("text", F.lit("'")), F.lit('"'))
    said, kind = F.replace(text, F.lit("\n"), F.lit("\\n")), F.pmod(F.col("doc_id"), F.lit(6))
    printed = {
        0: ("[['", said, "']]"),
        1: ('[["it\'s ', said, '"]]'),
        2: ("[['", said, "', 'b']]"),
        3: ("[['", said, "'], [\"b\"]]"),
        4: ("[['", said, "\\'\"\\\\']]"),
        5: ("[", said, "]"),
    }
    cell = F.lit(None)
    for i, (before, middle, after) in printed.items():
        cell = F.when(kind == i, F.concat(F.lit(before), middle, F.lit(after))).otherwise(cell)
    docs = table(spark, folder, "documents").select("doc_id", cell.alias("cell"))
    parsed = docs.select("doc_id", unwrapped("cell").alias("trace"), samples("cell").alias("lists"))
    return parsed.select(
        "doc_id",
        "trace",
        F.when(F.col("lists").isNotNull(), F.size("lists")).alias("n_samples"),
        F.col("lists")[0][0].alias("first_text"),
    )


DRIVING_PHRASES = [
    "Slow for a lead vehicle", "Keep distance to the lead car", "Slow for a red light", "Stop for the stop sign",
    "Slow for a pedestrian crossing", "Slow for a curve", "Slow to create a gap for lane change", "Nudge within lane",
    "Nudge over the line", "Change lane to the left", "Merge onto highway", "A yellow light at a crosswalk",
    "Rain, fog, night", "Construction zone behind a construction warning sign", "Slow for bumps and hills",
    "The lane is ending", "Lane merging, lane splitting", "Need to turn left ahead",
]
_SQL_PHRASES = ", ".join(f"'{p}'" for p in DRIVING_PHRASES)


def _sql_labels(field: str) -> str:
    hits = ", ".join(
        f"CASE WHEN regexp_matches(t, '{r[1]}') THEN '{r[2]}' END" for r in an.DRIVING_RULES if r[0] == field
    )
    return f"coalesce(nullif(concat_ws(',', {hits}), ''), 'none') AS {field}"


RULE_FIELDS = list(dict.fromkeys(r[0] for r in an.DRIVING_RULES))


def phrased_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, each with one driving phrase at its end."""
    phrase = F.expr(f"elt(CAST(doc_id % {len(DRIVING_PHRASES)} AS INT) + 1, {_SQL_PHRASES})")
    return table(spark, folder, "documents").select("doc_id", F.concat_ws(" ", "text", phrase).alias("text"))


@query(
    f"""
    SELECT doc_id, {", ".join(map(_sql_labels, RULE_FIELDS))}
    FROM (SELECT doc_id, lower(text || ' ' || [{_SQL_PHRASES}][CAST(doc_id % {len(DRIVING_PHRASES)} AS INTEGER) + 1]) AS t
          FROM documents)
    """
)
def driving_rule_labels(spark, folder):
    """The built-in rules over whole documents, each with one driving phrase at its end."""
    labelled = an.label_by_rules(phrased_documents(spark, folder), "text", an.DRIVING_RULES, lower=True)
    return labelled.select("doc_id", *[F.array_join(f, ",").alias(f) for f in RULE_FIELDS])


# More queries register themselves here; they take helpers from this module.
from tagwright.plans import catalog_streams, catalog_tables  # noqa: E402, F401
