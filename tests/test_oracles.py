"""Every registered query against its SQL; queries without SQL must run and return rows."""

import pytest
from check_oracles import compare, duck

from seriesloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    verdict, _, rows = compare(spark, con, QUERIES[name], ORACLES.get(name), SF)
    assert verdict in ("ok", "rows"), verdict
    assert rows > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["ticker", "month_end", "monthly_return"]
    assert set(e.oracle_sql()) <= set(e.queries())
