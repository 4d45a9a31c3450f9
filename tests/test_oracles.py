"""Every query with an oracle, on whole tables."""

import pytest

from lodeplane.plans import registry
from tests.oracle import SF, from_duckdb, from_spark


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_oracle(spark, name):
    got, want = from_spark(registry.QUERIES[name](spark, SF)), from_duckdb(registry.ORACLES[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1]


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
