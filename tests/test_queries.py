"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry
from gavel.queries.registry import registered

FOLDER = "/root/testdata/sf0.001"
EVERY = registered()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(EVERY))
def test_query(spark, con, name):
    fn, sql = EVERY[name]
    df = fn(spark, FOLDER)
    if sql is None:
        assert df.count() >= 0
        return
    ok, message = oracle.compare(df, con, sql)
    assert ok, message


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
