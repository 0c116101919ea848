"""Every registered query against its SQL oracle."""

import pytest
from compare import connect, differences

from brassledger.catalogue import oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(small_dir):
    return connect(small_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, small_dir, duck, name):
    assert differences(QUERIES[name](spark, small_dir), duck, ORACLES[name]) == []
