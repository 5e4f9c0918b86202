"""Bucketed tables between the steps: no card is shuffled twice."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tapflow.operators import merge, trips
from tapflow.plans.queries import TapFlow
from tapflow.plans.steps import StepOptions, run_step
from tapflow.sources import tables

BUCKETS = 5


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run_chain(spark, db, o):
    """The eight steps after the loads, over catalog tables of ``db``."""
    tf = TapFlow(spark, SF0001)
    spark.sql(f"CREATE DATABASE {db}")
    for name in ("bus_rides", "metro_taps", "bus_stations", "metro_stations"):
        tables.write_table(tf.inputs[name], name, db=db)
    run_step(spark, "bus-clean", ["bus_rides", "c_bus"], o)
    run_step(spark, "metro-clean", ["metro_taps", "c_metro"], o)
    run_step(spark, "bus-join-site", ["c_bus", "bus_stations", "w_bus"], o)
    run_step(spark, "metro-join-site", ["c_metro", "metro_stations", "w_metro"], o)
    run_step(spark, "merge", ["w_bus", "w_metro", "merged"], o)
    return tf, run_step(spark, "od-flow", ["merged", "flow"], o)


@pytest.fixture(scope="module")
def chain(spark):
    db = f"tf_{uuid.uuid4().hex}"
    return db, *run_chain(spark, db, StepOptions(db=db, buckets=BUCKETS))


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_flow_is_the_same(chain):
    _, tf, flow = chain
    assert same(tf.passenger_flow, flow) and flow.count() > 0


def test_every_table_keeps_the_buckets(spark, chain):
    db, tf, _ = chain
    assert [tables.buckets_of(spark, n, "card_id", db) for n in ("c_bus", "c_metro", "w_bus", "w_metro", "merged")] == [BUCKETS] * 5
    assert tables.buckets_of(spark, "flow", "card_id", db) == tables.buckets_of(spark, "metro_taps", "card_id", db) == 0
    assert same(tf.metro_cleaned, tables.read_table(spark, "c_metro", db))
    assert same(tf.all_taps, tables.read_table(spark, "merged", db))


def test_windows_read_in_place(spark, chain):
    db, _, _ = chain
    od = trips.od_records(tables.read_table(spark, "merged", db), hot_threshold=None)
    assert "Exchange" not in plan(od) and "Bucketed: true" in plan(od)
    merged = merge.merge_taps(tables.read_table(spark, "w_bus", db), tables.read_table(spark, "w_metro", db))
    assert "Exchange" not in plan(merged)
    # also with the hot card-days looked for: their count groups in place
    od = trips.od_records(tables.read_table(spark, "merged", db))
    assert "Exchange" not in plan(od)


def test_day_filter_prunes_before_the_windows(spark, chain):
    db, tf, _ = chain
    taps = tables.read_table(spark, "merged", db)
    day = taps.agg(F.max("trade_date")).first()[0]
    od = trips.od_records(taps, hot_threshold=None).where(F.col("trade_date") == day)
    assert "Exchange" not in plan(od) and "PartitionFilters: [isnotnull(trade_date" in plan(od)
    assert same(od, tf.od_records.where(F.col("trade_date") == day))


def test_a_hot_card_is_written_plain(spark):
    """One bucket would hold a third of all taps: tables are plain, and the flow is the same."""
    db = f"tf_{uuid.uuid4().hex}"
    tf, flow = run_chain(spark, db, StepOptions(db=db, buckets=BUCKETS, hot_threshold=10, rows_per_chunk=200))
    assert tables.buckets_of(spark, "c_bus", "card_id", db) == tables.buckets_of(spark, "merged", "card_id", db) == 0
    assert same(tf.passenger_flow, flow)


def test_refused_layouts(spark):
    df = spark.createDataFrame([("a", "20240101")], "card_id string, trade_date string")
    for bad in ({"table": "/tmp/x"}, {"bucket_by": None}, {"mode": "append"}):
        with pytest.raises(ValueError):
            tables.write_table(df, **{"table": "tf_x", "bucket_by": "card_id", "buckets": 2, **bad})


def test_one_file_per_bucket_and_day(spark, chain):
    db, _, _ = chain
    taps = tables.read_table(spark, "c_bus", db)
    files = taps.select(F.input_file_name().alias("f"), "trade_date").distinct()
    assert files.groupBy("trade_date").count().agg(F.max("count")).first()[0] <= BUCKETS
