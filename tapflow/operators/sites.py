"""Attach station rows to taps.

The join is an inner equi-join on the trimmed (line, station name) pair.
Station tables are small and bounded, so they are broadcast after a size
check: the tap side is then never shuffled, and a station that takes a third
of all taps cannot skew a task.  Beyond the bound the join is a shuffle join:
taps are counted per key, those of a hot key get a salt, and that key's station
rows are copied once per salt, so no task holds a hot station's taps.

Station rows are projected to the three carried columns plus the trimmed
keys *before* the broadcast, so only what the join needs is shipped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.functions.columns import line_number
from tapflow.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS
from tapflow.session import shared_dir

#: Taps of one (line, station) that a task of the shuffle join may hold, about.
HOT_STATION_TAPS = 2_000_000
#: Hot keys that are broadcast to be marked; beyond, they are joined by shuffle.
MAX_BROADCAST_KEYS = 100_000

SITE_COLUMNS = ["station_id", "station_longitude", "station_latitude"]


def site_line_no(metro_sites: DataFrame) -> DataFrame:
    """Metro station table plus ``line_no`` = first digit run of ``line_name``."""
    return metro_sites.withColumn("line_no", line_number("line_name"))


def _site_side(sites: DataFrame) -> DataFrame:
    # a station row with a null key never matches the inner join
    return (sites.where(F.col("line_no").isNotNull() & F.col("station_name").isNotNull())
            .select(F.trim("line_no").alias("_site_line"),
                    F.trim("station_name").alias("_site_name"),
                    *SITE_COLUMNS))


def salted(taps: DataFrame, sites: DataFrame, taps_per_salt: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the shuffle join with ``_salt``: taps of a key with more than
    ``taps_per_salt`` of them are dealt over as many salts as that makes, and the
    key's station rows stand once for each; other keys have the salt 0.

    One map-side-combined count over the taps' keys; there are at most (taps /
    ``taps_per_salt``) hot keys, and twice as many copies of station rows.
    """
    counts = (taps.where(F.col("_tap_line").isNotNull() & F.col("_tap_name").isNotNull())
              .groupBy(F.col("_tap_line").alias("_hot_line"), F.col("_tap_name").alias("_hot_name"))
              .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > taps_per_salt))
    shared_dir(taps.sparkSession)
    hot = counts.select("_hot_line", "_hot_name", F.ceil(F.col("_n") / taps_per_salt).alias("_salts")).checkpoint(eager=True)
    n = hot.count()
    if not n:
        return taps.withColumn("_salt", F.lit(0).cast("long")), sites.withColumn("_salt", F.lit(0).cast("long"))
    hot = F.broadcast(hot) if n <= MAX_BROADCAST_KEYS else hot.hint("merge")
    # the task's number spreads copies of one row; it is the same when a task runs again
    place = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in taps.columns])
    dealt = (taps.join(hot, (F.col("_tap_line") == F.col("_hot_line")) & (F.col("_tap_name") == F.col("_hot_name")), "left")
             .withColumn("_salt", F.coalesce(F.pmod(place, F.col("_salts")), F.lit(0).cast("long")))
             .drop("_hot_line", "_hot_name", "_salts"))
    copied = (sites.join(hot, (F.col("_site_line") == F.col("_hot_line")) & (F.col("_site_name") == F.col("_hot_name")), "left")
              .withColumn("_salt", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.coalesce(F.col("_salts"), F.lit(1).cast("long")) - 1)))
              .drop("_hot_line", "_hot_name", "_salts"))
    return dealt, copied


def _attach(taps: DataFrame, sites: DataFrame, max_broadcast_rows: int,
            broadcast: bool | None, taps_per_salt: int) -> DataFrame:
    side = _site_side(sites)
    if broadcast is None:  # prove the bound here
        broadcast = side.count() <= max_broadcast_rows
    left_cols = taps.columns
    # keys are computed once per tap row; trimmed site keys were computed
    # before the broadcast
    left = (taps.withColumn("_tap_line", F.trim("line_no"))
            .withColumn("_tap_name", F.trim("station_name")))
    if broadcast:
        right = F.broadcast(side)
    else:
        left, right = salted(left, side, taps_per_salt)
        right = right.hint("merge")
    cond = ((left["_tap_line"] == right["_site_line"])
            & (left["_tap_name"] == right["_site_name"]))
    if not broadcast:
        cond = cond & (left["_salt"] == right["_salt"])
    joined = left.join(right, cond, "inner")
    return joined.select(*[left[c] for c in left_cols], *[right[c] for c in SITE_COLUMNS])


def attach_bus_sites(rides: DataFrame, sites: DataFrame,
                     max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                     broadcast: bool | None = None,
                     taps_per_salt: int = HOT_STATION_TAPS) -> DataFrame:
    """Cleaned bus rides with station id and coordinates; unmatched rides drop.

    The ride's line and station are the boarding values, else the alighting
    values (P8).  ``broadcast`` is the caller's proven decision (see
    ``site_facts``); by default the bound is checked here.
    """
    rides = (rides.withColumn("line_no", F.coalesce("mark_line_id", "trade_line_id"))
             .withColumn("station_name", F.coalesce("mark_station", "trade_station")))
    return _attach(rides, sites, max_broadcast_rows, broadcast, taps_per_salt)


def attach_metro_sites(taps: DataFrame, sites: DataFrame,
                       max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       broadcast: bool | None = None,
                       taps_per_salt: int = HOT_STATION_TAPS) -> DataFrame:
    """Cleaned metro taps with station id and coordinates.

    In metro taps ``line_id``/``station_id`` hold the line number and the
    station *name*; they are renamed before the join (P10).  The station's
    ``line_no`` comes from its line name (P9).
    """
    taps = taps.withColumnsRenamed({"line_id": "line_no", "station_id": "station_name"})
    return _attach(taps, site_line_no(sites), max_broadcast_rows, broadcast, taps_per_salt)


def duplicate_site_keys(sites: DataFrame) -> DataFrame:
    """Trimmed (line_no, station_name) keys held by more than one station row.

    Each such key multiplies the taps that match it (a loop line listing a
    station twice); run this on a station table before trusting counts.
    """
    return (sites.groupBy(F.trim("line_no").alias("line_no"),
                          F.trim("station_name").alias("station_name"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1))


@dataclass
class SiteFacts:
    """Proven facts about both station tables (one job)."""

    bus_rows: int        # rows that can match (non-null keys)
    metro_rows: int
    multiplicity: int    # most station rows sharing one join key


def _key_rows(sites: DataFrame, name: str) -> DataFrame:
    side = _site_side(sites)
    per_key = side.groupBy("_site_line", "_site_name").agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(F.lit(name).alias("table"),
                       F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                       F.coalesce(F.max("rows"), F.lit(0)).alias("multiplicity"))


def site_fact_rows(bus_sites: DataFrame, metro_sites: DataFrame) -> DataFrame:
    """(table, rows, multiplicity) for both station tables, as a DataFrame, so
    a caller can compute it in one job together with other counts."""
    return (_key_rows(bus_sites, "bus")
            .unionByName(_key_rows(site_line_no(metro_sites), "metro")))


def facts_from_rows(rows: dict) -> SiteFacts:
    return SiteFacts(int(rows["bus"]["rows"]), int(rows["metro"]["rows"]),
                     int(max(rows["bus"]["multiplicity"], rows["metro"]["multiplicity"])))


def site_facts(bus_sites: DataFrame, metro_sites: DataFrame) -> SiteFacts:
    """Row counts and the largest key multiplicity of both station tables.

    The counts decide the broadcasts; the multiplicity bounds how often a
    station join can repeat one tap.  One job with a map-side-combined count
    per key, two result rows.
    """
    return facts_from_rows({r["table"]: r for r in
                            site_fact_rows(bus_sites, metro_sites).collect()})
