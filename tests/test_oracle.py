"""Every registered key agrees with its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF0001
from oracle_check import compare, duck
from tapflow.plans.queries import queries

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    ok, msg = compare(spark, SF0001, key, entry.queries()[key], entry.oracle_sql().get(key), con)
    assert ok, msg


def test_every_key_has_oracle():
    assert set(queries()) <= set(entry.oracle_sql())
    assert set(queries()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["trade_date", "od_desc", "od_type", "station_name",
                          "station_longitude", "station_latitude", "passenger_flow"]
