"""Cleaning of bus rides (X5) and metro taps.

Bus cleaning is a 1:1 projection.  Metro cleaning numbers the trips of each
card-day, removes one-tap trips and removes taps that repeat the previous
direction.  All windows share the partitioning (trade_date, card_id) and
order by prefixes of one tap order, so the whole metro cleaning costs one
hash exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapflow.functions.columns import flag
from tapflow.operators import skew
from tapflow.session import shared_dir
from tapflow.sources.schemas import BUS_CLEANED_COLUMNS

CARD_DAY = ["trade_date", "card_id"]
# Tie-break among taps of one card-day with equal trade_time, used only where
# the order among peers changes the result (lag).  Entries before exits.
METRO_TIE = ["io_type", "line_id", "station_id", "device_id", "card_type"]
# Fixed value: the direction assumed before the first tap of a card-day.
FIRST_PREVIOUS_DIRECTION = "O"


def clean_bus(rides: DataFrame) -> DataFrame:
    """Event time, trip id and direction of each bus ride; keeps every row."""
    derived = {
        "tms_id": F.coalesce("mark_tms_id", "trade_tms_id"),
        "mark_trade_time": F.coalesce("mark_time", "trade_time"),
        "IO_TYPE": F.when(F.col("mark_time").isNotNull(), F.lit("I")).otherwise(F.lit("O")),
    }
    return rides.select(*[derived[c].alias(c) if c in derived else F.col(c)
                          for c in BUS_CLEANED_COLUMNS])


def _card_day_total_order() -> Window:
    return Window.partitionBy(*CARD_DAY).orderBy(
        F.col("trade_time"), *[F.col(c) for c in METRO_TIE])


def trip_key() -> Column:
    """``tct``: trade_date_card_trip; nulls are skipped, never null."""
    return F.concat_ws("_", F.col("trade_date"), F.col("card_id"),
                       F.col("tms_id").cast("string"))


def metro_trip_ids(taps: DataFrame) -> DataFrame:
    """Each entry starts a trip; ``tms_id`` = entries so far.

    The reference's running sum uses the default RANGE frame, so taps with
    equal ``trade_time`` share a trip number.  Here it is a ROWS running sum
    in the total tap order, then the largest value among taps with the same
    time (the count is non-decreasing, so that is the value at the last
    peer).  Both windows order by a prefix of one sort, which the later
    ``lag``/``lead`` windows reuse: the whole cleaning sorts once.
    """
    entry = flag(F.col("io_type") == "I")
    upto = _card_day_total_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peers = Window.partitionBy(*CARD_DAY, "trade_time")
    return (taps
            .withColumns({"once_od": entry, "_run": F.sum(entry).over(upto)})
            .withColumn("tms_id", F.max("_run").over(peers))
            .drop("_run")
            .withColumn("tct", trip_key()))


def single_tap_trips(with_ids: DataFrame) -> DataFrame:
    """A1, F1: trip keys that occur exactly once (``tct``, ``count``)."""
    return with_ids.groupBy("tct").count().where(F.col("count") == 1)


def anti_single_tap(with_ids: DataFrame) -> DataFrame:
    """Drop every tap whose trip key is a one-tap trip (left anti join)."""
    return with_ids.join(single_tap_trips(with_ids), on="tct", how="left_anti")


def with_alone(with_ids: DataFrame) -> DataFrame:
    """``_alone``: the tap is the only one of its trip in its card-day.

    Trip numbers never decrease in time order, so a trip's taps are
    neighbours: a trip has one tap exactly when the taps before and after
    it belong to other trips.  ``lag``/``lead`` on the existing sort decide
    that; no window per trip (and no sort by trip) is needed.
    """
    order = _card_day_total_order()
    trip = F.col("tms_id")
    before, after = F.lag(trip).over(order), F.lead(trip).over(order)
    return with_ids.withColumn("_alone", _is_alone(trip, before, after))


def _is_alone(trip: Column, before: Column, after: Column) -> Column:
    return (before.isNull() | (before != trip)) & (after.isNull() | (after != trip))


def ambiguous() -> Column:
    """Whether a card-day's trip keys may print like another card-day's: only a
    null date or card, or one that holds the separator, can cause that."""
    def odd(c: str) -> Column:
        return F.col(c).isNull() | F.contains(F.col(c), F.lit("_"))
    return odd("trade_date") | odd("card_id")


class TripKeys:
    """J3 by the string key, without a shuffle of all taps.

    The rule drops a tap when its ``tct`` string occurs once in the whole
    table.  A tap that has company in its own trip is kept.  One that is alone
    there is kept only if another card-day prints the same string, and then one
    of the two card-days is ``ambiguous``:

    * a plain tap's string must be among the strings of ambiguous taps;
    * an ambiguous tap's string must occur twice among ambiguous taps, or be
      that of a plain card-day, which the string itself names.

    ``numbered(taps)`` numbers the trips of a subset of whole card-days.  Where
    no ambiguous tap exists -- one narrow count says so, unless the caller knows it
    already (``any_odd`` False) -- nothing else runs.
    """

    def __init__(self, taps: DataFrame, numbered, any_odd: bool | None = None):
        self.strings = None
        odd = taps.where(ambiguous())
        if any_odd is False or odd.isEmpty():
            return
        shared_dir(taps.sparkSession)
        own = numbered(odd).groupBy("tct").agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
        # the plain card-days that an ambiguous string may also name: date_card_trip
        part = F.split("tct", "_")
        named = own.where((F.size(part) == 3)).select(
            part[0].alias("_d"), part[1].alias("_c")).distinct().checkpoint(eager=True)
        plain = taps.where(~ambiguous())
        plain = plain.join(_sized(named), (plain["trade_date"] == F.col("_d"))
                           & (plain["card_id"] == F.col("_c")), "left_semi")
        other = numbered(plain).select("tct").distinct().withColumn("_also", F.lit(True))
        self.strings = own.join(other, "tct", "left").select(
            F.col("tct").alias("_tct"), "_n", F.coalesce("_also", F.lit(False)).alias("_also")
        ).checkpoint(eager=True)

    def keep(self, rows: DataFrame) -> DataFrame:
        """Rows with ``_alone`` -> the rows that stay (clustering and order are kept)."""
        if self.strings is None:
            return rows.where(~F.col("_alone")).drop("_alone")
        joined = rows.join(_sized(self.strings), F.col("tct") == F.col("_tct"), "left")
        printed_twice = F.when(ambiguous(), (F.col("_n") > 1) | F.col("_also")).otherwise(
            F.col("_n").isNotNull())
        return (joined.where(~F.col("_alone") | F.coalesce(printed_twice, F.lit(False)))
                .drop("_alone", "_tct", "_n", "_also"))


def _sized(df: DataFrame) -> DataFrame:
    """``df`` broadcast when its counted rows allow, else joined by shuffle."""
    return F.broadcast(df) if df.count() <= skew.MAX_BROADCAST_ROWS else df.hint("merge")


def drop_repeated_direction(kept: DataFrame) -> DataFrame:
    """Keep taps whose direction differs from the previous tap.

    ``lag`` sees the neighbour before this filter (one pass); a null
    direction, and the tap right after it, drop out as the comparison is
    null.
    """
    last = F.lag("io_type", 1, FIRST_PREVIOUS_DIRECTION).over(_card_day_total_order())
    cols = [c for c in kept.columns if c != "device_id"]
    return (kept.withColumn("last_io_type", last)
            .where(F.col("io_type") != F.col("last_io_type"))
            .select(*cols, "last_io_type"))


def _id_columns(taps: DataFrame) -> list[str]:
    return [c for c in taps.columns if c != skew.KID] + ["once_od", "tms_id", "tct"]


def _cleaned_columns(taps: DataFrame) -> list[str]:
    # raw tap columns minus device_id, then the derived ones (reference order)
    return [c for c in _id_columns(taps) if c != "device_id"] + ["last_io_type"]


def _numbered_chunks(hot: DataFrame, cut: skew.Cut) -> DataFrame:
    """Hot taps with trip number, key and ``_alone``: one edge table.

    The RANGE sum inside a chunk, plus the entries of earlier chunks, plus -- for
    the taps with the chunk's last time -- the entries that later chunks hold of
    that time, numbers the trips; the numbers of the neighbouring chunks' edge
    taps follow from the same table.
    """
    order = ["trade_time"]
    total = order + METRO_TIE
    chunked = skew.assign_chunks(hot.withColumn("once_od", flag(F.col("io_type") == "I")), order, cut.chunks, METRO_TIE, cut.tasks)
    w = skew.in_chunk(total)
    rows = skew.heads(chunked.withColumn("_inner", F.sum("once_od").over(skew.in_chunk(order))), order, total)
    rows = rows.withColumn("_head_od", F.when(F.col("_head"), F.col("once_od")).otherwise(F.lit(0)))
    edge = skew.edges(rows, total, [*order, "_inner"], [*order, "_inner"], ["once_od", "_head_od"])
    across = skew.across_chunks()
    offset = F.coalesce(F.sum("once_od").over(across.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    edge = edge.withColumns({"_offset": offset, "_more": skew.continued("_head_od", order)})
    one_time = F.col("first.trade_time").eqNullSafe(F.col("last.trade_time"))
    edge = edge.select(
        skew.KID, skew.CHUNK, "_offset", "_more", F.col("last.trade_time").alias("_last_time"),
        F.lag(F.col("_offset") + F.col("last._inner") + F.col("_more")).over(across).alias("_edge_before"),
        F.lead(F.col("_offset") + F.col("first._inner") + F.when(one_time, F.col("_more")).otherwise(F.lit(0))
               ).over(across).alias("_edge_after"))
    rows = skew.attach(rows, edge).withColumn("tms_id", F.col("_inner") + F.col("_offset") + F.when(
        F.col("trade_time").eqNullSafe(F.col("_last_time")), F.col("_more")).otherwise(F.lit(0)))
    trip = F.col("tms_id")
    before = F.when(F.row_number().over(w) == 1, F.col("_edge_before")).otherwise(F.lag(trip).over(w))
    after = F.when(F.lead(F.lit(1)).over(w).isNull(), F.col("_edge_after")).otherwise(
        F.lead(trip).over(w))
    return (rows.withColumn("tct", trip_key())
            .withColumns({"_before": before, "_after": after})
            .withColumn("_alone", _is_alone(trip, F.col("_before"), F.col("_after")))
            .select(*_id_columns(hot), "_alone", skew.KID, skew.CHUNK))


def _clean_chunks(hot: DataFrame, cut: skew.Cut, keys: TripKeys) -> DataFrame:
    """X6 for hot card-days: the window plan's rules as ordered chunk scans, with
    two edge tables (three reads of the checkpoint)."""
    total = ["trade_time"] + METRO_TIE
    kept = keys.keep(_numbered_chunks(hot, cut))
    edge = skew.edges(kept, total, [], ["io_type"])
    across = skew.across_chunks()
    carry = F.when(F.row_number().over(across) == 1, F.lit(FIRST_PREVIOUS_DIRECTION)).otherwise(
        F.lag("last.io_type").over(across))
    rows = skew.attach(kept, edge.select(skew.KID, skew.CHUNK, carry.alias("_carry")))
    w = skew.in_chunk(total)
    last = F.when(F.row_number().over(w) == 1, F.col("_carry")).otherwise(F.lag("io_type").over(w))
    return (rows.withColumn("last_io_type", last)
            .where(F.col("io_type") != F.col("last_io_type"))
            .select(*_cleaned_columns(hot)))


def _split(taps: DataFrame, hot_threshold: int | None,
           hot_keys: skew.HotKeys | None) -> skew.HotSplit:
    if hot_keys is None and hot_threshold is not None:
        hot_keys = skew.find_hot_keys(taps, CARD_DAY, hot_threshold)
    return skew.split_hot(taps, hot_keys)


def number_trips(taps: DataFrame, hot_threshold: int | None = skew.HOT_ROWS_PER_KEY,
                 rows_per_chunk: int = skew.ROWS_PER_CHUNK,
                 hot_keys: skew.HotKeys | None = None) -> DataFrame:
    """``metro_trip_ids`` with hot card-days numbered in ordered chunks."""
    split = _split(taps, hot_threshold, hot_keys)
    cold = metro_trip_ids(split.cold)
    if split.hot is None:
        return cold
    hot = _numbered_chunks(split.hot, skew.cut(taps.sparkSession, split.hot_rows, rows_per_chunk))
    return cold.unionByName(hot.select(*cold.columns))


def trip_keys(taps: DataFrame, hot_threshold: int | None, rows_per_chunk: int,
              hot_keys: skew.HotKeys | None, any_odd: bool | None = None) -> TripKeys:
    """``TripKeys`` of all taps, numbering their subsets with the same hot split."""
    return TripKeys(taps, lambda part: number_trips(part, hot_threshold, rows_per_chunk, hot_keys), any_odd)


def clean_part(taps: DataFrame, keys: TripKeys, cut: skew.Cut | None = None) -> DataFrame:
    """X6 of taps that are all of hot card-days (``cut`` given, with key ids) or none."""
    if cut is None:
        return drop_repeated_direction(keys.keep(with_alone(metro_trip_ids(taps))))
    return _clean_chunks(taps, cut, keys)


def clean_metro(taps: DataFrame, hot_threshold: int | None = skew.HOT_ROWS_PER_KEY,
                rows_per_chunk: int = skew.ROWS_PER_CHUNK,
                hot_keys: skew.HotKeys | None = None) -> DataFrame:
    """Number trips, drop one-tap trips by their key, drop repeated directions.

    Card-days above ``hot_threshold`` taps are split out and cleaned in ordered
    chunks (``tapflow.operators.skew``); the rest take the one-exchange window
    plan.  The rule is the same for both (``TripKeys``), and so is the result.
    A caller that already knows a superset of the hot card-days passes
    ``hot_keys``; ``hot_threshold=None`` without them means no split.
    """
    split = _split(taps, hot_threshold, hot_keys)
    keys = trip_keys(taps, hot_threshold, rows_per_chunk, hot_keys)
    cold = clean_part(split.cold, keys)
    if split.hot is None:
        return cold
    return cold.unionByName(
        clean_part(split.hot, keys, skew.cut(taps.sparkSession, split.hot_rows, rows_per_chunk)))
