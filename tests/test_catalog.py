"""Every registered query agrees with its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import QUERIES, entry, oracle_sql, queries
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert difference(queries()[name](spark, SF_DIR), db, oracle_sql()[name]) is None


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0
