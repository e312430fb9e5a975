"""Every query with SQL against that SQL on the smallest tables."""

import pytest

from oracle import connection, rows_of
from tidemark.plans import catalogue

import __spark_entry__


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, small, name):
    columns, found = rows_of(catalogue.queries()[name](spark, small))
    sql_columns, expected = rows_of(connection(small).sql(catalogue.oracle_sql()[name]).df())
    assert columns == sql_columns
    assert found == expected


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_entry_gives_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
