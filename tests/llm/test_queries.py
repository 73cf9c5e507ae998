import pytest

from cellframe.llm import catalog
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, sf, name):
    assert differences(catalog.QUERIES[name](spark, sf).toPandas(), connect(sf).sql(catalog.ORACLES[name]).df()) == []
