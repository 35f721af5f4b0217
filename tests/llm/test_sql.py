"""The queries of this subpackage that SQL can express, against their SQL."""

from __future__ import annotations

import pytest

import compare
from demandloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), compare.oracle_connection(sf_dir), ORACLE_SQL[name]) is None
