"""The station join beyond the broadcast bound: taps of a hot station are salted."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tapflow.operators import sites
from tapflow.plans.queries import TapFlow

PER_SALT = 150


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def crowded(taps, line, name):
    """A third of all taps at one station, some of them as copies of one row."""
    hot = F.abs(F.hash(*taps.columns)) % 3 == 0
    return taps.withColumns({c: F.when(hot, F.lit(v)).otherwise(F.col(c)) for c, v in line.items()} | {
        c: F.when(hot, F.lit(name)).otherwise(F.col(c)) for c in ("mark_station", "trade_station", "station_id") if c in taps.columns})


@pytest.fixture(scope="module")
def tf(spark):
    return TapFlow(spark, SF001, hot_threshold=None)


def test_bus_rows_equal_the_broadcast_join(tf):
    rides = crowded(tf.bus_cleaned, {"mark_line_id": "3", "trade_line_id": "3"}, "NATION_3 ").repartition(6)
    stations = tf.inputs["bus_stations"]  # station 3 is listed twice
    want = sites.attach_bus_sites(rides, stations, broadcast=True)
    got = sites.attach_bus_sites(rides, stations, max_broadcast_rows=0, taps_per_salt=PER_SALT)
    assert same(want, got) and want.where("trim(station_name) = 'NATION_3'").count() > rides.count() // 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_tap_line" in plan and "_salt" in plan


def test_metro_rows_equal_the_broadcast_join(tf):
    taps = crowded(tf.metro_cleaned, {"line_id": "2"}, "NATION_7")
    want = sites.attach_metro_sites(taps, tf.inputs["metro_stations"], broadcast=True)
    assert same(want, sites.attach_metro_sites(taps, tf.inputs["metro_stations"], broadcast=False, taps_per_salt=PER_SALT))
    # without a hot key nothing is salted
    plain = sites.attach_metro_sites(taps, tf.inputs["metro_stations"], broadcast=False)
    assert same(want, plain)


def test_no_salt_holds_the_station(spark):
    taps = spark.range(0, 6_000, 1, 12).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 400).cast("string")).alias("_tap_line"),
        F.when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.lit("S")).alias("_tap_name"))
    side = spark.createDataFrame([("1", "S", "a"), ("1", "S", "b"), ("2", "S", "c")], "_site_line string, _site_name string, station_id string")

    def largest(taps):
        dealt, copied = sites.salted(taps, side, PER_SALT)
        assert dealt.count() == taps.count()
        return max(r["count"] for r in dealt.where("_tap_name is not null").groupBy("_tap_line", "_tap_name", "_salt").count().collect()), copied

    most, copied = largest(taps)
    assert most <= 2 * PER_SALT
    copies = {r["station_id"]: r["count"] for r in copied.groupBy("station_id").count().collect()}
    assert copies["a"] == copies["b"] == -(-1_960 // PER_SALT) and copies["c"] == 1
    # copies of one row are spread by the task that reads them
    most, _ = largest(taps.drop("id"))
    assert most < 2_000 / 3


def test_hot_keys_beyond_the_broadcast_bound(tf, monkeypatch):
    monkeypatch.setattr(sites, "MAX_BROADCAST_KEYS", 0)
    rides = crowded(tf.bus_cleaned, {"mark_line_id": "3", "trade_line_id": "3"}, "NATION_3")
    stations = tf.inputs["bus_stations"]
    assert same(sites.attach_bus_sites(rides, stations, broadcast=True),
                sites.attach_bus_sites(rides, stations, broadcast=False, taps_per_salt=PER_SALT))


def test_empty_sides(tf):
    rides, stations = tf.bus_cleaned, tf.inputs["bus_stations"]
    for a, b in ((rides.limit(0), stations), (rides, stations.limit(0))):
        assert sites.attach_bus_sites(a, b, broadcast=False, taps_per_salt=1).count() == 0
