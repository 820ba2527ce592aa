from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import check, connection

SF = "/root/testdata/sf0.001"
CORE = [m for m in entry.MODULES]
QUERIES = {k: v for m in CORE for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in CORE for k, v in m.ORACLE.items()}


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    check(spark, con, QUERIES[name], ORACLE.get(name), SF)


def test_entry_and_contract(spark):
    assert entry.entry(spark).columns == ["transcript_id", "period_kind", "start_ms", "end_ms"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
