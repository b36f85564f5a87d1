"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import difference, oracle_connection, type_difference
from conftest import SF_SMALL

import __spark_entry__ as entry_module
from zoneflow.plans.oracles import CHECKED_DIR
from zoneflow.plans.queries import QUERIES as OWN

QUERIES = entry_module.queries()
ORACLES = {k: sql.replace(CHECKED_DIR, SF_SMALL) for k, sql in entry_module.oracle_sql().items()}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_SMALL)


# queries without SQL are held against plain versions in the tests of their own folder
@pytest.mark.parametrize("name", sorted(set(OWN) | set(ORACLES)))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert type_difference(df, ORACLES[name], con) is None
    assert difference(df, ORACLES[name], con) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(OWN) <= set(ORACLES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["zone", "n_trips", *("mean_fare", "mean_tip_ratio", "p90_distance", "fare_per_km")]
    assert df.count() == 10
