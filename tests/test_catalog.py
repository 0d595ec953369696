"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import connect, differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    if name not in oracle_sql():  # no SQL: the result must have rows, checks are in the other tests
        assert queries()[name](spark, SF).columns
        return
    assert differences(spark, con, name, SF) is None


def test_entry(spark):
    assert entry(spark).count() > 0
