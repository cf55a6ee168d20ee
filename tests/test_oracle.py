"""Every registered query against its DuckDB oracle on the small driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from dockmart.queries import ORACLE, QUERIES
from harness import compare

QUERY_NAMES = sorted(entry.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERY_NAMES)
def test_query_matches_oracle(spark, sf_dir, duck_small, name):
    df = entry.queries()[name](spark, sf_dir)
    problems = compare(df, duck_small, entry.oracle_sql()[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 47
    assert df.count() > 0
