"""Every registered query against its SQL on the driver's tables."""

import pytest
from conftest import TESTDATA
from oracle import assert_same, connect

import __spark_entry__ as contract
from marketbars.plans import registry
from marketbars.plans.oracles import ORACLES
from marketbars.storage import scratch

SF = TESTDATA / "sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    expected = duck.execute(contract.oracle_sql()[name]).df()
    with scratch(spark):
        actual = contract.queries()[name](spark, str(SF)).toPandas()
    assert len(expected) > 0
    assert_same(actual, expected)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


UNUSUAL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.session.timeZone": "Asia/Tokyo",
    "spark.sql.ansi.enabled": "false",
    "spark.sql.shuffle.partitions": "3",
}


@pytest.mark.parametrize(
    "name",
    [
        "normalize_feed",
        "ingest_increment",
        "insert_if_absent",
        "upsert_by_key",
        "silver_tail",
        "gold",
        "day_index",
        "forecast_avg_close",
    ],
)
def test_results_do_not_depend_on_the_session(spark, name):
    """No broadcast, another time zone, no ANSI, an odd number of partitions."""
    small = TESTDATA / "sf0.001"
    before = {key: spark.conf.get(key) for key in UNUSUAL}
    try:
        for key, value in UNUSUAL.items():
            spark.conf.set(key, value)
        actual = contract.queries()[name](spark, str(small)).toPandas()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    con = connect(small)
    assert_same(actual, con.execute(contract.oracle_sql()[name]).df())
    con.close()
