"""Every registered query against its SQL twin at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import compare, duck

SQL = oracle_sql()
RUN = queries()


@pytest.fixture(scope="session")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", [n for n in RUN if n in SQL])
def test_query_matches_sql(spark, small, con, name):
    got = RUN[name](spark, small).toPandas()
    assert compare(got, con.execute(SQL[name]).df()) == ""


@pytest.mark.parametrize("name", [n for n in RUN if n not in SQL])
def test_query_without_sql_gives_rows(spark, small, name):
    assert RUN[name](spark, small).count() > 0


def test_entry(spark):
    found = entry(spark)
    assert found.count() > 0
    assert found.schema == entry(spark).schema


def test_every_sql_twin_belongs_to_a_query():
    assert set(SQL) <= set(RUN)
