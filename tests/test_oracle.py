"""Every registered job against its independent SQL oracle (sf0.001, exact values)."""
import collections
import datetime as dt
import math

import pytest

import __spark_entry__ as E
from oracle.registry import ORACLE
from rentalmart.registry import REGISTRY as QUERIES


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, dt.datetime) and v.time() == dt.time():
        return v.date()
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    from conftest import SF_SMALL
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _bag(got, df.columns) == _bag(want, cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["neighbourhood", "room_type"]
    assert df.count() > 0
