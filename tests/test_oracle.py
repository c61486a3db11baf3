"""Every query with an oracle agrees with DuckDB (the driver's gate, run here
at sf0.001 to stay fast); every registered query runs."""

import pytest

from conftest import SF_SMALL
from shelfwise.plans.catalog import oracle_sql, queries
from shelfwise.plans.oracle import compare, duckdb_views

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    problems = compare(queries()[name](spark, SF_SMALL), ORACLE[name], con)
    assert not problems, problems


@pytest.mark.parametrize(
    "name", sorted(set(queries()) - set(ORACLE))
)
def test_model_queries_produce_rows(spark, name):
    assert queries()[name](spark, SF_SMALL).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(queries())
