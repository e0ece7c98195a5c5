"""The driver gate, locally: every query against its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from tidewater.plans import ORACLE, QUERIES
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["v2_id", "lg_id", "n_left", "n_right", "inter", "uni", "jaccard_dist"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("sf", [SF])
def test_queries_match_oracles(spark, sf):
    res = compare(spark, sf, sorted(QUERIES))
    bad = {k: v for k, v in res.items() if not v.startswith("OK")}
    assert not bad, bad
