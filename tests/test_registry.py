"""Every registered query against its SQL twin, and the driver contract."""

import pytest

import __spark_entry__ as driver
from beaconry.plans import REGISTRY
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, con, name):
    q = REGISTRY[name]
    df = q.run(spark, FOLDER)
    if q.sql is None:
        assert df.count() > 0
    else:
        assert difference(df, con, q.sql) is None


def test_every_inventory_row_is_registered():
    wanted = {f"{p}{i:02d}" for p, n in (("i", 15), ("c", 31), ("d", 10), ("f", 5), ("j", 9), ("a", 27), ("w", 12), ("o", 4), ("u", 3), ("b", 42), ("q", 36))
              for i in range(1, n + 1)}
    assert wanted == {n.split("_")[0] for n in REGISTRY}


def test_entry_runs(spark):
    assert driver.entry(spark).count() == 7
    assert set(driver.oracle_sql()) <= set(driver.queries())
