"""The operators that SQL can express against their SQL."""

from __future__ import annotations

import pytest
from check_oracles import compare, connect

from cdcflow.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) == ""
