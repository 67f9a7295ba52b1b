"""Every query of the library against its SQL, or for rows where SQL can't say it."""

import pytest
from conftest import rows_of

from vacatia.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, sf, name):
    got, want = QUERIES[name](spark, sf).toPandas(), duck(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"posting_typed", "posting_features"}))
def test_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
