import pytest

from checks import catalog
from checks.compare import connect, normal, oracle


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    got = catalog.QUERIES[name](spark, sf).toPandas()
    assert len(got) > 0
    if name in catalog.ORACLES:
        want = oracle(duck, catalog.ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
