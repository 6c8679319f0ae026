"""Every query of the text operators against its SQL on the smallest tables."""

import pytest

from callweave.llm import queries

from ..compare import rows_of, rows_of_sql


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, small, name):
    assert rows_of(queries.QUERIES[name](spark, small)) == rows_of_sql(queries.ORACLES[name], small)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_the_others_run(spark, small, name):
    assert queries.QUERIES[name](spark, small).count() >= (name != "p2_limits")  # few rows have no limits
