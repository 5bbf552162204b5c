"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import collections
import math

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    """Of the reference's own operators; queries of optional parts are held to their own tests."""
    from bibspark import queries
    missing = sorted(set(queries.queries()) - set(queries.oracle_sql()))
    assert missing == [], missing


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _bag(cols, rows) == _bag(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "subj" in df.columns and "pred" in df.columns
