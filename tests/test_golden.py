"""Golden rows per rule (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapflow.functions.columns import line_number
from tapflow.operators.clean import (anti_single_tap, clean_metro, drop_repeated_direction,
                                     metro_trip_ids)
from tapflow.operators.merge import merge_taps
from tapflow.operators.trips import endpoint_marks, od_records, tap_gaps, trip_segments
from tapflow.sources.schemas import MERGED_COLUMNS, metro_tap_schema

NTZ = T.TimestampNTZType()


def t(hour, minute=0, second=0):
    return dt.datetime(2024, 1, 1, hour, minute, second)


def metro_rows(spark, rows):
    schema = metro_tap_schema(NTZ)
    data = [(card, "01", "1", "S", "D1", t(8, minute), io, "d1") for card, minute, io in rows]
    return spark.createDataFrame(data, schema)


def kept(df):
    return sorted((r.card_id, r.trade_time.minute, r.io_type) for r in df.collect())


def test_metro_clean_golden(spark):
    taps = metro_rows(spark, [
        ("c1", 1, "I"), ("c1", 2, "O"), ("c1", 3, "O"), ("c1", 4, "I"),
        ("c2", 1, "O"), ("c2", 2, "O"), ("c2", 3, "I"), ("c2", 4, "O"),
        ("c3", 1, "O"),
        ("c4", 5, "I"), ("c4", 5, "O"),
        ("c5", 1, None), ("c5", 2, "I"),
        (None, 1, "I"),
    ])
    want = [("c1", 1, "I"), ("c1", 2, "O"), ("c2", 3, "I"), ("c2", 4, "O"),
            ("c4", 5, "I"), ("c4", 5, "O")]
    assert kept(clean_metro(taps)) == want
    # the same rules through the chunked path, every card-day hot, tiny chunks
    assert kept(clean_metro(taps, hot_threshold=0, rows_per_chunk=2)) == want
    peers = clean_metro(taps).where(F.col("card_id") == "c4").select("tms_id").collect()
    assert {r.tms_id for r in peers} == {1}


def test_one_tap_trips_by_key_string(spark):
    """The rule counts the printed key: card-days that print alike keep each other's taps."""
    rows = [("d1", "a_1", 1, "I"), ("d1_a", "1", 1, "I"),      # same key, one tap each: both stay
            ("d2_c", None, 1, "I"), ("d2", "c", 1, "I"), ("d2", "c", 2, "O"),  # named by a plain card-day
            ("d3_e", None, 1, "I"), ("d3", "e", 1, "I"),        # both alone, same key: both stay
            ("d4", None, 1, "I"), (None, "d5", 1, "I"), ("d6", "x_y", 1, "I"),  # alone, no namesake
            ("d7", None, 1, "I"), (None, "d7", 1, "I"),          # nulls print alike: both stay
            ("d8", "p", 1, "I"), ("d8", "q", 1, "I"), ("d8", "q", 2, "O")]
    schema = metro_tap_schema(NTZ)
    taps = spark.createDataFrame([(card, "01", "1", "S", "D1", t(8, m), io, day)
                                  for day, card, m, io in rows], schema)

    def what(df):
        return sorted(((r.trade_date, r.card_id, r.trade_time.minute) for r in df.collect()), key=str)

    want = what(drop_repeated_direction(anti_single_tap(metro_trip_ids(taps))))
    assert len(want) == 11 and ("d1", "a_1", 1) in want and ("d8", "p", 1) not in want
    assert what(clean_metro(taps)) == want
    assert what(clean_metro(taps, hot_threshold=0, rows_per_chunk=1)) == want
    assert what(clean_metro(taps, hot_threshold=1, rows_per_chunk=1)) == want


def merged(spark, rows):
    """rows: (card, trip, time, direction, station)."""
    schema = T.StructType([
        T.StructField(c, NTZ if c in ("mark_time", "trade_time", "mark_trade_time")
                      else T.DecimalType(10, 7) if c in ("station_longitude", "station_latitude")
                      else T.StringType())
        for c in MERGED_COLUMNS])
    data = []
    for card, trip, time, io, station in rows:
        rec = dict.fromkeys(MERGED_COLUMNS)
        rec.update(card_id=card, tms_id=trip, mark_trade_time=time, IO_TYPE=io,
                   station_name=station, station_id=station, line_no="1", trade_date="d1")
        if io == "I":
            rec.update(mark_time=time, mark_station=station, mark_tms_id=trip)
        else:
            rec.update(trade_time=time, trade_station=station, trade_tms_id=trip)
        data.append(tuple(rec[c] for c in MERGED_COLUMNS))
    return spark.createDataFrame(data, schema)


OD_ROWS = [
    ("A", "1", t(8), "I", "S1"), ("A", "1", t(8, 30), "O", "S2"),
    ("A", "2", t(9), "I", "S3"), ("A", "2", t(9, 40), "O", "S4"),
    ("A", "3", t(18), "I", "S4"), ("A", "3", t(18, 45), "O", "S1"),
    ("B", "7", t(10), "I", "S5"),
    ("C", "5", t(7), "O", "S6"), ("C", "5", t(9), "I", "S7"),
    ("D", "9", t(8), "I", "S1"), ("D", "10", t(12), "I", "S2"),
    ("E", "10", t(8), "I", "S1"), ("E", "9", t(9, 30), "I", "S2"),
]

# rank ties (T11) and null trip ids: several rows per endpoint
TIE_ROWS = [
    ("F", "1", t(8), "I", "S1"), ("F", "1", t(8), "O", "S2"), ("F", "1", t(8, 30), "O", "S3"),
    ("H", "1", t(8), "I", "S1"), ("H", "1", t(9), "O", "S2"), ("H", "1", t(9), "O", "S3"),
    ("G", None, t(8), "I", "S1"), ("G", None, t(8, 10), "O", "S2"), ("G", "1", t(9, 30), "I", "S3"),
]


def test_od_cut_rank_ties_and_null_trip_ids(spark):
    taps = merged(spark, TIE_ROWS)
    marks = endpoint_marks(trip_segments(tap_gaps(taps)))
    got = sorted((r.card_id, r.tms_id or "", r.mark_trade_time, r.station_name, r.marker)
                 for r in marks.collect())
    want = sorted([
        ("F", "1", t(8), "S1", 0), ("F", "1", t(8), "S2", 0), ("F", "1", t(8, 30), "S3", 999),
        ("H", "1", t(8), "S1", 0), ("H", "1", t(9), "S2", 999), ("H", "1", t(9), "S3", 999),
        ("G", "", t(8), "S1", 0), ("G", "", t(8, 10), "S2", 999), ("G", "1", t(9, 30), "S3", 999),
    ])
    assert got == want
    desc = {"F": "S1-S3", "H": "S1-S3", "G": "S1-S3"}
    for variant in (od_records(taps), od_records(taps, hot_threshold=0, rows_per_chunk=2)):
        rows = variant.collect()
        assert len(rows) == 9
        assert {r.card_id: r.od_desc for r in rows} == desc


def test_od_cut_golden(spark):
    taps = merged(spark, OD_ROWS)
    marks = endpoint_marks(trip_segments(tap_gaps(taps)))
    got = {(r.card_id, r.tms_id, r.mark_trade_time): (r.new_tms_id, r.marker)
           for r in marks.collect()}
    want = {
        ("A", "1", t(8)): (1, 0), ("A", "1", t(8, 30)): (1, 999),
        ("A", "2", t(9)): (1, 9), ("A", "2", t(9, 40)): (1, 9),
        ("A", "3", t(18)): (2, 0), ("A", "3", t(18, 45)): (2, 999),
        ("B", "7", t(10)): (1, 999),
        ("C", "5", t(7)): (0, 999), ("C", "5", t(9)): (1, 999),
        ("D", "9", t(8)): (1, 9), ("D", "10", t(12)): (1, 999),
        ("E", "10", t(8)): (1, 999), ("E", "9", t(9, 30)): (2, 999),
    }
    assert got == want
    gap = {(r.card_id, r.tms_id): r.duration for r in marks.collect()}
    assert gap[("D", "9")] == -14400

    desc = {"A": "S1-S1", "B": "S5-S5", "C": "S6-S7", "D": "S2-S2", "E": "S1-S2"}
    for variant in (od_records(taps), od_records(taps, hot_threshold=0, rows_per_chunk=3)):
        rows = variant.collect()
        assert {r.card_id: r.od_desc for r in rows} == desc
        assert len(rows) == 10  # marker-9 rows dropped
        b = [r for r in rows if r.card_id == "B"]
        assert [r.od_type for r in b] == [0]


def test_line_number(spark):
    df = spark.createDataFrame([("4-大兴线",), ("14号线（西段）",), ("八通线",), (None,)],
                               "line_name string")
    got = [r.n for r in df.select(line_number("line_name").alias("n")).collect()]
    assert got == ["4", "14", "", None]


def test_union_keeps_text_trip_ids(spark):
    bus = merged(spark, [("X", "T7", t(8), "I", "S1"), ("X", "10", t(9), "I", "S1")])
    metro = spark.createDataFrame(
        [Row(card_id="X", card_type="01", line_no="1", station_name="S1", trade_time=t(10),
             io_type="I", trade_date="d1", once_od=1, tms_id=3, tct="d1_X_3", last_io_type="O",
             station_id="S1", station_longitude=None, station_latitude=None),
         Row(card_id="X", card_type="01", line_no="1", station_name="S1", trade_time=t(11),
             io_type="O", trade_date="d1", once_od=0, tms_id=10, tct="d1_X_10",
             last_io_type="I", station_id="S1", station_longitude=None, station_latitude=None)],
        "card_id string, card_type string, line_no string, station_name string, "
        "trade_time timestamp_ntz, io_type string, trade_date string, once_od int, "
        "tms_id bigint, tct string, last_io_type string, station_id string, "
        "station_longitude decimal(10,7), station_latitude decimal(10,7)")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        out = merge_taps(bus, metro)
        assert out.schema["tms_id"].dataType == T.StringType()
        assert sorted({r.tms_id for r in out.collect()}) == ["10", "3", "T7"]
    spark.conf.unset("spark.sql.ansi.enabled")
