"""Every query against its SQL, on the smallest sample."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import compare


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return compare.oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, oracle, name):
    assert compare.difference(entry.queries()[name](spark, sf_dir), oracle, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
