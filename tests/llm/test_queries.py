from __future__ import annotations

import pytest

from factloom.llm import queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF) is None
