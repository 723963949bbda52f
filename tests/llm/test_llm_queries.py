"""The registered queries of this package against their SQL on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(n for n in entry.queries() if n.startswith("op") and n.split("_")[0][2:].isdigit())


def test_all_are_registered():
    assert {int(n.split("_")[0][2:]) for n in NAMES} == set(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    df, sql = entry.queries()[name](spark, FOLDER), entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    else:
        ok, message = oracle.compare(df, oracle.connect(FOLDER), sql)
        assert ok, message
