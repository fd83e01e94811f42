"""Every query of the library equals its SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from tapeloom.plans import registry
from tests.conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def _plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, bool) or v is None or isinstance(v, int):
        return v
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    got = registry.queries()[name](spark, SMALL)
    want = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    ours, theirs = _rows(got.columns, got.collect()), _rows(names, want.fetchall())
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs, strict=True):
        assert all(x == y or (isinstance(x, float) and y is not None and abs(x - y) <= 2e-6 * max(1.0, abs(x))) for x, y in zip(a, b, strict=True)), (a, b)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert registry.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
