"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from cdcflow.plans import oracles, registry
from check_oracles import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name) == ""


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(oracles.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
