import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Rows (doc_id, text, source) as a table like ``documents``, in three partitions."""

    def build(rows):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build


@pytest.fixture
def odd(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, clashing names."""
    long = "word %d and more of it. " * 4000
    rows = [
        (1, "Alpha beta gamma delta. Alpha beta gamma.", "a"),
        (1, "Alpha beta gamma delta. Alpha beta gamma.", "a"),
        (2, "ALPHA beta gamma delta. Alpha beta gamma.", "b"),
        (3, "", "b"),
        (4, None, "b"),
        (None, "nobody knows this one", "c"),
        (None, None, None),
        (5, long, None),
        (6, long, "a"),
        (7, " \t\n ", "c"),
        (8, "one", None),
        (9, "one two", "c"),
        (9, "another text under the same id", "c"),
        (10, "Grüße an alle ÄÖÜ Σ 😀", "d"),
    ]
    clash = {c: 1 for c in "h size key row part text_sha256 fp copies n_tokens score __score __row c0 guest at xx first".split()}
    schema = DOCS_SCHEMA + ", " + ", ".join(f"`{c}` int" for c in clash)
    full = [(i, t, None, s, None, *clash.values()) for i, t, s in rows]
    return spark.createDataFrame(full, schema).repartition(4)


DOCS_SCHEMA = DOCS


@pytest.fixture
def rows_of():
    def collect(df) -> list[Row]:
        return sorted(df.collect(), key=repr)

    return collect
