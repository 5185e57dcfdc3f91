import parity
import pytest

from tidemill.plans import oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_same_as_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in oracles.ORACLES:
        assert parity.difference(got, parity.connect(SF).sql(oracles.ORACLES[name]).df()) == ""
