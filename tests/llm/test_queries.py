import check
import pytest

from pageloom.llm.queries import ORACLES, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    _, problem = check.compare(df.columns, [tuple(r) for r in df.collect()], check.connect(sf), ORACLES[name])
    assert problem is None
