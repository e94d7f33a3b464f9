"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from wordkin.suite.oracles import ORACLES
from wordkin.suite.queries import QUERIES
from compare import TABLES, connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_keys_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(ORACLES) == set(QUERIES)
    assert "conversations" in TABLES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF)
    assert differences(result, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["decade", "w1", "w2", "npmi"]
    assert result.limit(1).count() == 1
