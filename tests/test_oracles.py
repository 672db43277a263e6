"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import pytest

from faultline.plans import registry
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_oracle(spark, sf_dir, con, name):
    problem = difference(registry.QUERIES[name](spark, sf_dir), con, registry.ORACLES[name])
    assert problem is None, problem
