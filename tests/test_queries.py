import pytest

from cellframe.plans import catalog
from tests.oracle import connect, differences

ORACLES = catalog.oracle_sql()
#: Queries that train models or iterate have no SQL; they must give rows.
OTHERS = sorted(set(catalog.queries()) - set(ORACLES))


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, duck, name):
    assert differences(catalog.queries()[name](spark, sf).toPandas(), duck.sql(ORACLES[name]).df()) == []


@pytest.mark.parametrize("name", [n for n in OTHERS if n != "model_select"])
def test_gives_rows(spark, sf, name):
    assert catalog.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
