from pathlib import Path

import pytest

import __spark_entry__ as contract
import check

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_names_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", contract.queries())
def test_query_gives_what_its_sql_gives(spark, con, name):
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert contract.queries()[name](spark, SF).count() >= 0
    else:
        assert check.differences(spark, con, contract.queries()[name], sql, SF) == ""
