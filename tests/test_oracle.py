"""Every registered query against its DuckDB oracle on sf0.001 (driver's check, small)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001
from eventide.plans import registry

TABLES = ["events", "part"]
NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["entity_id", "feature_name", "feature_value", "computed_at"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    got = df.collect()
    rel = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted((tuple(_norm(r[cols.index(c)]) for c in sorted(cols)) for r in rel.fetchall()), key=repr)
    have = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in got), key=repr)
    assert have == want
