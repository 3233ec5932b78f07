"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from keelson.plans.registry import ORACLES, QUERIES
from tools.check_oracle import check, oracle


@pytest.fixture(scope="module")
def con(small):
    return oracle(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, small, name):
    ok, note = check(spark, con, name, small)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["c_mktsegment", "acc", "obs", "pct_acc"] and rows.count() > 0
