"""Queries that SQL can express against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from closebook.llm import registry
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = duck.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    frame = registry.QUERIES[name](spark, SMALL)
    assert sorted(frame.columns) == sorted(columns)
    got = sorted(tuple(r) for r in frame.select(columns).collect())
    assert got == sorted(result.fetchall()) and got
