"""Merge both modes into one tap table.

A metro tap is one row per gate pass; it is spread over the boarding
(``mark_*``) or alighting (``trade_*``) columns by its direction so that it
lines up with a bus ride.  Metro trip numbers are bigint and bus trip ids are
text; they are cast to text explicitly, so the union does not depend on the
session's ANSI setting and ids like ``T7`` survive.  Trip ids therefore sort
as text downstream.

The duplicate removal is a whole-row distinct.  Card-days of ordinary size
are clustered by (trade_date, card_id) first: the distinct, and every later
window of the card-day, then runs on that one exchange.  Rows of hot card-days
take the plain distinct, which aggregates map-side first, so even a row copied
a billion times leaves each map task once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.sources.schemas import MERGED_COLUMNS


def align_metro(metro: DataFrame) -> DataFrame:
    """Metro taps in the 18-column merged layout."""
    io = F.col("io_type")
    trip = F.col("tms_id").cast("string")
    entry = io == "I"
    leave = io == "O"
    aligned = (metro.withColumnRenamed("trade_time", "mark_trade_time")
               .withColumns({
                   "mark_time": F.when(entry, F.col("mark_trade_time")),
                   "mark_line_id": F.when(entry, F.col("line_no")),
                   "mark_station": F.when(entry, F.col("station_name")),
                   "mark_tms_id": F.when(entry, trip),
                   "trade_time": F.when(leave, F.col("mark_trade_time")),
                   "trade_line_id": F.when(leave, F.col("line_no")),
                   "trade_station": F.when(leave, F.col("station_name")),
                   "trade_tms_id": F.when(leave, trip),
                   "tms_id": trip,
               }))
    return _layout(aligned)


def _layout(df: DataFrame) -> DataFrame:
    # names resolve case-insensitively (``IO_TYPE`` picks ``io_type``); the
    # alias fixes the output spelling
    return df.select(*[F.col(c).alias(c) for c in MERGED_COLUMNS])


def align_bus(bus: DataFrame) -> DataFrame:
    """Bus rides (with station) in the merged layout."""
    return _layout(bus)


def merge_taps(bus: DataFrame, metro: DataFrame, by_card_day: bool = False) -> DataFrame:
    """X9 (U1, U2, A3): union of both modes without duplicate rows.

    ``by_card_day`` clusters the rows by card-day before the distinct; only for
    taps without hot card-days."""
    taps = align_bus(bus).unionByName(align_metro(metro))
    if by_card_day:
        taps = taps.repartition("trade_date", "card_id")
    return taps.distinct()
