import pytest

import __spark_entry__ as entry
from compare import difference, spark_rows, sql_rows
from tagwright.plans.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, name):
    ours = spark_rows(QUERIES[name](spark, FOLDER))
    assert ours[1]
    assert difference(ours, sql_rows(FOLDER, SQL[name])) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["priority", "n"]
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()
