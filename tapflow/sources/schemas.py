"""Fixed schemas of the tap files and the column lists of derived tables.

Fixed values: field names, order and types must equal the reference's tap
file layout, or files written for it would be read wrongly.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(spec: list[tuple[str, str]], ts_type: T.DataType) -> T.StructType:
    kinds = {"str": T.StringType(), "ts": ts_type}
    return T.StructType([T.StructField(n, kinds[k], True) for n, k in spec])


# Bus ride file, tab separated, no header, 14 fields.
BUS_RIDE_FIELDS = [
    ("card_id", "str"), ("card_type", "str"), ("trade_type", "str"),
    ("mark_time", "ts"), ("mark_line_id", "str"), ("mark_station", "str"),
    ("mark_bus_id", "str"), ("mark_tms_id", "str"),
    ("trade_time", "ts"), ("trade_line_id", "str"), ("trade_station", "str"),
    ("trade_bus_id", "str"), ("trade_tms_id", "str"),
    ("trade_date", "str"),
]

# Metro tap file, tab separated, no header, 8 fields.
METRO_TAP_FIELDS = [
    ("card_id", "str"), ("card_type", "str"), ("line_id", "str"),
    ("station_id", "str"), ("device_id", "str"), ("trade_time", "ts"),
    ("io_type", "str"), ("trade_date", "str"),
]

# The 16 columns of a cleaned bus ride, in order.
BUS_CLEANED_COLUMNS = [
    "card_id", "trade_type",
    "mark_time", "mark_line_id", "mark_station", "mark_bus_id", "mark_tms_id",
    "trade_time", "trade_line_id", "trade_station", "trade_bus_id", "trade_tms_id",
    "trade_date", "tms_id", "mark_trade_time", "IO_TYPE",
]

# The 18 columns shared by both modes after the merge, in order.
MERGED_COLUMNS = [
    "card_id",
    "mark_time", "mark_line_id", "mark_station", "mark_tms_id",
    "trade_time", "trade_line_id", "trade_station", "trade_tms_id",
    "mark_trade_time",
    "tms_id", "IO_TYPE", "line_no", "station_name", "station_id",
    "station_longitude", "station_latitude", "trade_date",
]

# The 7 columns of the passenger-flow table; the first six are
# the grouping key.
FLOW_KEY = ["trade_date", "od_desc", "od_type", "station_name",
            "station_longitude", "station_latitude"]

# The 13 columns of an OD record (alias -> source column).
# The columns of the OD table, (name, source).
OD_COLUMNS = [
    ("card_id", "card_id"), ("trade_date", "trade_date"),
    ("o_time", "mark_time"), ("o_line", "mark_line_id"), ("o_station", "mark_station"),
    ("d_time", "trade_time"), ("d_line", "trade_line_id"), ("d_station", "trade_station"),
    ("od_desc", "od_desc"), ("od_type", "od_type"),
    ("station_name", "station_name"), ("station_longitude", "station_longitude"),
    ("station_latitude", "station_latitude"),
]


def bus_ride_schema(ts_type: T.DataType | None = None) -> T.StructType:
    """Schema of the bus ride file; timestamps default to ``TimestampType``."""
    return _fields(BUS_RIDE_FIELDS, ts_type or T.TimestampType())


def metro_tap_schema(ts_type: T.DataType | None = None) -> T.StructType:
    """Schema of the metro tap file; timestamps default to ``TimestampType``."""
    return _fields(METRO_TAP_FIELDS, ts_type or T.TimestampType())


BUS_RIDE = bus_ride_schema()
METRO_TAP = metro_tap_schema()
