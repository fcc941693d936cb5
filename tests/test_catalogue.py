import pytest
from compare import TABLES, connect, oracle_rows, spark_rows

import __spark_entry__ as driver
from stepstream.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def oracle():
    return connect(TABLES)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["event_id", "ts", "user_id", "value", "doubled", "redoubled"]
    assert result.count() == 10


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, folder, oracle, name):
    assert spark_rows(QUERIES[name](spark, folder)) == oracle_rows(oracle, ORACLES[name])


def test_late_rows_differ_by_mode(oracle):
    """The late-row queries would show nothing if no row of theirs were late."""
    totals = {
        mode: oracle.execute(f"SELECT sum(total) FROM ({ORACLES[f'late_rows_{mode}']})").fetchone()
        for mode in ("append", "update", "complete")
    }
    assert totals["append"] < totals["update"] < totals["complete"]
