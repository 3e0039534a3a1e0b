"""Every registered query against its SQL counterpart on whole tables."""

import check
import pytest

from pageloom.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(tables):
    return check.connect(tables)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, duck, name):
    df = QUERIES[name](spark, tables)
    rows = [tuple(r) for r in df.collect()]
    _, problem = check.compare(df.columns, rows, duck, ORACLES[name])
    assert problem is None


def test_entry_returns_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= entry.queries().keys()
    assert set(ORACLES) <= entry.oracle_sql().keys() <= entry.queries().keys()
