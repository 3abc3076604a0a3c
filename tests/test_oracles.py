"""Every named query against its SQL twin on the driver's tables."""

import pytest

from hazardgrid.plans.oracles import ORACLES
from hazardgrid.plans.queries import QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []
