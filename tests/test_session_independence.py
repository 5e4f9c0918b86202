"""Results do not depend on the session time zone or the ANSI setting."""

import pytest

from conftest import SF0001
from tapflow.plans.queries import queries

KEYS = ["od_records", "delimited_scan", "table_sink_partitioned"]


@pytest.mark.parametrize("key", KEYS)
def test_time_zone_and_ansi_independent(spark, key):
    q = queries()[key]
    base = q(spark, SF0001).collect()
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        other = q(spark, SF0001).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.unset("spark.sql.ansi.enabled")
    assert sorted(map(tuple, base), key=repr) == sorted(map(tuple, other), key=repr)
