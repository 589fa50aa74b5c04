"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import catalogue  # noqa: F401
from catalogue.registry import ORACLES, QUERIES
from compare import connect, run_both

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    mine, oracle = run_both(spark, con, SF_DIR, name)
    assert mine == oracle
