import pytest

import __spark_entry__ as E
from tracklens.plans.verify import compare, duckdb_views

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 5
    assert df.columns[:3] == ["rank", "mmsi_a", "mmsi_b"]


def test_every_query_has_an_oracle():
    core = set(E.queries()) - set(E.LLM_QUERIES)
    assert core == set(E.oracle_sql()) - set(E.LLM_ORACLES)


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF)


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) - set(E.LLM_ORACLES)))
def test_query_matches_oracle_sf0001(spark, con, key):
    ok, msg = compare(E.queries()[key](spark, SF), con, E.oracle_sql()[key])
    assert ok, msg
