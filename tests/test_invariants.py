"""Invariants over the driver's data (sf0.001) and agreement of alternative plans."""

from pyspark.sql import functions as F

from conftest import SF0001
from tapflow.operators import clean, merge, sites, trips
from tapflow.plans.queries import TapFlow


def test_bus_clean_keeps_rows(spark):
    tf = TapFlow(spark, SF0001)
    assert tf.bus_cleaned.count() == tf.inputs["bus_rides"].count()


def test_metro_clean_direction_alternates(spark):
    tf = TapFlow(spark, SF0001)
    assert tf.metro_cleaned.where(~(F.col("io_type") != F.col("last_io_type"))).count() == 0


def test_anti_join_form_equals_window_form(spark):
    taps = TapFlow(spark, SF0001).inputs["metro_taps"]
    b = clean.clean_metro(taps)
    a = clean.drop_repeated_direction(clean.anti_single_tap(clean.metro_trip_ids(taps))).select(*b.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_flow_sums_to_od_rows(spark):
    tf = TapFlow(spark, SF0001)
    total = tf.passenger_flow.agg(F.sum("passenger_flow")).first()[0]
    assert total == tf.od_records.count()


def test_all_taps_has_no_duplicates(spark):
    taps = TapFlow(spark, SF0001).all_taps
    assert taps.count() == taps.distinct().count()


def test_chunked_path_matches_windows(spark):
    plain = TapFlow(spark, SF0001, hot_threshold=None)
    # every card-day hot, ~20 rows per chunk: exercises every carry between chunks
    hot = TapFlow(spark, SF0001, hot_threshold=0, rows_per_chunk=20)
    for key in ("metro_trip_ids", "metro_cleaned", "all_taps", "tap_gaps", "trip_segments",
                "endpoint_marks", "od_records"):
        a, b = getattr(plain, key), getattr(hot, key)
        b = b.select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, key


def test_duplicate_site_keys(spark):
    s = spark.createDataFrame([("1", "A "), ("1", "A"), ("2", "B")], "line_no string, station_name string")
    rows = sites.duplicate_site_keys(s).collect()
    assert [(r.line_no, r.station_name, r.rows) for r in rows] == [("1", "A", 2)]


def test_station_join_is_broadcast(spark):
    plan = TapFlow(spark, SF0001).bus_with_site._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_station_join_by_shuffle_and_duplicate_stations(spark):
    """A station listed twice doubles its taps, by broadcast and by shuffle alike."""
    tf = TapFlow(spark, SF0001)
    stations = tf.inputs["bus_stations"]
    twice = stations.unionByName(stations.where("station_id = '3'").withColumn("station_id", F.lit("103")))
    plain = tf.bus_with_site
    double = sites.attach_bus_sites(tf.bus_cleaned, twice, broadcast=True)
    by_shuffle = sites.attach_bus_sites(tf.bus_cleaned, twice, broadcast=False)
    assert double.exceptAll(by_shuffle).count() == 0 and by_shuffle.exceptAll(double).count() == 0
    assert double.count() == plain.count() + plain.where("station_id = '3'").count() > plain.count()


def test_merge_drops_duplicate_taps(spark):
    tf = TapFlow(spark, SF0001)
    bus, metro = tf.bus_with_site, tf.metro_with_site
    once = tf.all_taps.count()
    for by_card_day in (True, False):
        taps = merge.merge_taps(bus.unionAll(bus), metro.unionAll(metro), by_card_day)
        assert taps.count() == once


def test_chain_exchanges(spark):
    """Metro cleaning, then the merged rows once: the OD cut adds no exchange."""
    plan = TapFlow(spark, SF0001).od_records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_hot_rows_are_scanned_once_per_pass(spark):
    hot = TapFlow(spark, SF0001, hot_threshold=0, rows_per_chunk=50)
    plan = hot.od_records._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in plan.splitlines() if "Scan ExistingRDD" in line and "mark_trade_time" in line]
    assert len(reads) == 1  # the final pass; three edge and station tables took one each
    metro = clean.clean_metro(hot.inputs["metro_taps"], hot_threshold=0, rows_per_chunk=50)
    plan = metro._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "Scan ExistingRDD" in x and "trade_time" in x]) == 1


def test_od_cut_single_exchange(spark):
    taps = spark.read.parquet(f"{SF0001}/events.parquet").select(
        F.col("user_id").cast("string").alias("card_id"), F.lit("d").alias("trade_date"),
        F.col("event_id").cast("string").alias("tms_id"), F.col("ts").alias("mark_trade_time"),
        *[F.lit(None).cast("string").alias(c) for c in
          ("IO_TYPE", "station_id", "line_no", "station_name", "mark_line_id", "mark_station",
           "mark_tms_id", "trade_line_id", "trade_station", "trade_tms_id")],
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("mark_time", "trade_time")],
        *[F.lit(None).cast("decimal(10,7)").alias(c) for c in ("station_longitude", "station_latitude")])
    plan = trips.od_records(taps)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_metro_clean_single_exchange_single_sort(spark):
    taps = spark.read.parquet(f"{SF0001}/events.parquet").select(
        F.col("user_id").cast("string").alias("card_id"),
        F.col("event_type").alias("card_type"), F.col("event_type").alias("line_id"),
        F.col("props").alias("station_id"), F.col("props").alias("device_id"),
        F.col("ts").alias("trade_time"), F.col("event_type").alias("io_type"),
        F.date_format("ts", "yyyyMMdd").alias("trade_date"))
    plan = clean.clean_metro(taps)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
