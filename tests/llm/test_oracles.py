from __future__ import annotations

import pytest

from keelson.llm.queries import ORACLES
from tools.check_oracle import check, oracle


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, name):
    ok, note = check(spark, oracle(small), name, small)
    assert ok, note
