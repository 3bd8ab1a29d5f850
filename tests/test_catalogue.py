"""Every registered query with an SQL equivalent agrees with it on whole tables."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry_point

SF_DIR = "/root/testdata/sf0.01"
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, entry_point.queries()[name], ORACLES[name], SF_DIR) == []


def test_entry_runs(spark):
    rows = entry_point.entry(spark).collect()
    assert {r["split"] for r in rows} == {"burn_in", "train", "val", "test"}
