"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query starts from the driver's tables under ``sf_dir`` (``events`` and
the matching DuckDB SQL lives in ``tapflow.plans.oracle``.

Sink keys write to a fresh folder under the shared scratch root
(``spark.checkpoint.dir``) and return the table as read back from the catalog.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapflow.operators import clean, flow, merge, sites, skew, trips
from tapflow.session import shared_dir
from tapflow.sources import delimited, fixtures, schemas, tables

Query = Callable[[SparkSession, str], DataFrame]
CARD_DAY = ["trade_date", "card_id"]


class TapFlow:
    """The chain of derived tables for one input folder (all lazy).

    Raw taps are split once, before anything else, into those of hot card-days
    and the rest; every operator keeps the card-day, so the chain runs on each
    part by itself, with plain windows on the one and ordered chunks on the
    other.
    """

    def __init__(self, spark: SparkSession, sf_dir: str,
                 hot_threshold: int | None = skew.HOT_ROWS_PER_KEY,
                 rows_per_chunk: int = skew.ROWS_PER_CHUNK):
        self.spark = spark
        self.sf_dir = sf_dir
        self.inputs = fixtures.domain_tables(spark, sf_dir)
        # card-days above hot_threshold rows take the chunked path
        self.hot_threshold = hot_threshold
        self.rows_per_chunk = rows_per_chunk

    @property
    def _card_days(self) -> DataFrame:
        """Raw taps of both modes per card-day."""
        raw = (self.inputs["bus_rides"].select(*CARD_DAY)
               .unionByName(self.inputs["metro_taps"].select(*CARD_DAY)))
        return raw.groupBy(*CARD_DAY).agg(F.count(F.lit(1)).alias("_n"))

    @cached_property
    def _facts(self) -> dict:
        """What the plans depend on, in one job of narrow counts: station rows and key
        multiplicity per mode; and the most raw taps of a card-day, with the number of
        card-days whose trip keys may print like another's."""
        stations = sites.site_fact_rows(self.inputs["bus_stations"], self.inputs["metro_stations"])
        cards = self._card_days.agg(
            F.lit("cards").alias("table"), F.coalesce(F.max("_n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(clean.ambiguous().cast("long")), F.lit(0)).alias("multiplicity"))
        return {r["table"]: r for r in stations.unionByName(cards).collect()}

    @cached_property
    def site_facts(self) -> sites.SiteFacts:
        """Station row counts (broadcast proofs) and key multiplicity."""
        if self.hot_threshold is None and "_facts" not in self.__dict__:
            return sites.site_facts(self.inputs["bus_stations"], self.inputs["metro_stations"])
        return sites.facts_from_rows(self._facts)

    @cached_property
    def hot(self) -> skew.HotKeys | None:
        """Hot card-days of both windowed stages from one count over raw taps.

        Metro cleaning sees exactly the metro taps.  The OD stage's rows per
        card-day are bounded without computing them: cleaning only drops rows,
        the union's distinct only drops rows, and a station join repeats a tap
        at most ``k`` times (the largest station-key multiplicity), so merged
        rows are at most ``k`` times the raw taps of that card-day.  The bound
        may flag a card-day that is not hot; the chunked path is exact for any
        key.
        """
        if self.hot_threshold is None:
            return None
        k = max(1, self.site_facts.multiplicity)
        if self._facts["cards"]["rows"] * k <= self.hot_threshold:
            return None  # the usual case: one job for all facts
        return skew.hot_keys_by(self._card_days, CARD_DAY, F.col("_n") * k, self.hot_threshold)

    def _cut(self) -> skew.Cut:
        return skew.cut(self.spark, self.hot.rows, self.rows_per_chunk)

    @property
    def _parts(self) -> list[bool]:
        return [False] if self.hot is None else [False, True]

    def _union(self, part) -> DataFrame:
        frames = [part(hot) for hot in self._parts]
        return reduce(lambda a, b: a.unionByName(b), frames)

    def _raw(self, name: str, hot: bool) -> DataFrame:
        """The raw taps of hot card-days (with their key id), or of the others."""
        split = skew.split_hot(self.inputs[name], self.hot)
        return split.hot if hot else split.cold

    @cached_property
    def bus_cleaned(self) -> DataFrame:
        return clean.clean_bus(self.inputs["bus_rides"])

    @cached_property
    def metro_trip_ids(self) -> DataFrame:
        return clean.number_trips(self.inputs["metro_taps"], None, self.rows_per_chunk, self.hot)

    @cached_property
    def _trip_keys(self) -> clean.TripKeys:
        any_odd = None if self.hot_threshold is None else self._facts["cards"]["multiplicity"] > 0
        return clean.trip_keys(self.inputs["metro_taps"], None, self.rows_per_chunk, self.hot, any_odd)

    def _metro_cleaned(self, hot: bool) -> DataFrame:
        cut = self._cut() if hot else None
        return clean.clean_part(self._raw("metro_taps", hot), self._trip_keys, cut)

    @cached_property
    def metro_cleaned(self) -> DataFrame:
        return self._union(self._metro_cleaned)

    def _with_bus_site(self, rides: DataFrame) -> DataFrame:
        ok = self.site_facts.bus_rows <= sites.DEFAULT_MAX_BROADCAST_ROWS
        return sites.attach_bus_sites(rides, self.inputs["bus_stations"], broadcast=ok)

    def _with_metro_site(self, taps: DataFrame) -> DataFrame:
        ok = self.site_facts.metro_rows <= sites.DEFAULT_MAX_BROADCAST_ROWS
        return sites.attach_metro_sites(taps, self.inputs["metro_stations"], broadcast=ok)

    @cached_property
    def bus_with_site(self) -> DataFrame:
        return self._with_bus_site(self.bus_cleaned)

    @cached_property
    def metro_with_site(self) -> DataFrame:
        return self._with_metro_site(self.metro_cleaned)

    def _all_taps(self, hot: bool) -> DataFrame:
        bus = self._with_bus_site(clean.clean_bus(self._raw("bus_rides", hot)))
        metro = self._with_metro_site(self._metro_cleaned(hot))
        return merge.merge_taps(bus, metro, by_card_day=not hot)

    @cached_property
    def all_taps(self) -> DataFrame:
        return self._union(self._all_taps)

    def _od(self, step: str) -> DataFrame:
        return self._union(lambda hot: trips.od_part(
            self._all_taps(hot), step, self.hot if hot else None,
            rows_per_chunk=self.rows_per_chunk))

    @cached_property
    def tap_gaps(self) -> DataFrame:
        return self._od("gaps")

    @cached_property
    def trip_segments(self) -> DataFrame:
        return self._od("segments")

    @cached_property
    def endpoint_marks(self) -> DataFrame:
        return self._od("marks")

    @cached_property
    def od_records(self) -> DataFrame:
        return self._od("records")

    @cached_property
    def passenger_flow(self) -> DataFrame:
        return flow.passenger_flow(self.od_records)


def _scratch(spark: SparkSession, key: str) -> str:
    """A fresh folder in the shared scratch root, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/tapflow-out/{key}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def _table_name(key: str) -> str:
    # unique, so that runs that share a catalog leave each other's tables alone
    return f"tapflow_{key}_{uuid.uuid4().hex}"


# --- sources and sinks -------------------------------------------------------

def q_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the events file exposed as a catalog table and scanned by name."""
    name = _table_name("events")
    tables.register_parquet(spark, name, f"{sf_dir.rstrip('/')}/events.parquet")
    return tables.read_table(spark, name)


def q_delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus rides written as a tab-separated file and read back by schema."""
    path = _scratch(spark, "bus_rides_tsv")
    delimited.write_delimited(TapFlow(spark, sf_dir).inputs["bus_rides"], path)
    return delimited.read_delimited(spark, path, schemas.bus_ride_schema(T.TimestampNTZType()))


def q_file_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metro taps file -> table partitioned by trade_date."""
    path = _scratch(spark, "metro_taps_tsv")
    delimited.write_delimited(TapFlow(spark, sf_dir).inputs["metro_taps"], path)
    return delimited.load_file_to_table(
        spark, path, schemas.metro_tap_schema(T.TimestampNTZType()),
        _table_name("s_ods_metro"), table_path=_scratch(spark, "s_ods_metro"))


def q_file_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8, X2 with reject routing: the good taps, and the lines set aside with their reason."""
    path, root = _scratch(spark, "metro_lines"), _scratch(spark, "s_ods_metro_checked")
    fixtures.metro_lines(fixtures.load_events(spark, sf_dir)).write.text(path)
    delimited.load_with_rejects(spark, path, schemas.metro_tap_schema(T.TimestampNTZType()),
                                f"{root}/good", f"{root}/rejects")
    rejects = tables.read_table(spark, f"{root}/rejects").select("line", "reason")
    return tables.read_table(spark, f"{root}/good").unionByName(rejects, allowMissingColumns=True)


def q_table_sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned bus rides saved partitioned by trade_date, read back."""
    name = _table_name("f_bus_cleaned")
    tables.write_table(TapFlow(spark, sf_dir).bus_cleaned, name, partition_by="trade_date",
                       path=_scratch(spark, "f_bus_cleaned"))
    return tables.read_table(spark, name)


def q_table_sink_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bus station table saved unpartitioned, read back."""
    name = _table_name("bus_station_tb")
    tables.write_table(TapFlow(spark, sf_dir).inputs["bus_stations"], name,
                       path=_scratch(spark, "bus_station_tb"))
    return tables.read_table(spark, name)


#: What a rerun of the first day writes in place of its rows (see ``q_table_sink_day``).
RERUN_TRADE_TYPE = "99"


def q_table_sink_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of all days, of which the first day is run again: its rows
    become the rerun's (boarded rides only, with another trade type), others stay."""
    name = _table_name("f_bus_cleaned_day")
    cleaned = TapFlow(spark, sf_dir).bus_cleaned
    tables.write_table(cleaned, name, partition_by="trade_date", path=_scratch(spark, "f_bus_cleaned_day"))
    day = cleaned.agg(F.min("trade_date")).first()[0]
    rerun = cleaned.where((F.col("trade_date") == day) & F.col("mark_time").isNotNull()).withColumn(
        "trade_type", F.lit(RERUN_TRADE_TYPE))
    tables.write_table(rerun, name, partition_by="trade_date", mode="partitions")
    return tables.read_table(spark, name)


# --- operators ----------------------------------------------------------------

def _chain(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(TapFlow(spark, sf_dir), attr)
    run.__name__ = f"q_{attr}"
    return run


def q_single_tap_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.single_tap_trips(TapFlow(spark, sf_dir).metro_trip_ids)


def q_anti_single_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.anti_single_tap(TapFlow(spark, sf_dir).metro_trip_ids)


def q_site_line_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.site_line_no(TapFlow(spark, sf_dir).inputs["metro_stations"])


def q_duplicate_site_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.duplicate_site_keys(TapFlow(spark, sf_dir).inputs["bus_stations"])


def q_metro_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.align_metro(TapFlow(spark, sf_dir).metro_with_site)


def q_flow_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow.flow_preview(flow.passenger_flow(TapFlow(spark, sf_dir).od_records, sort=False))


# Chunked-path keys: every card-day is treated as hot and cut into chunks of
# CHECK_ROWS_PER_CHUNK rows, so the skew path runs on the whole tables and is
# checked against the same oracle as the window path.
CHECK_ROWS_PER_CHUNK = 1000


def q_metro_cleaned_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TapFlow(spark, sf_dir, hot_threshold=0,
                   rows_per_chunk=CHECK_ROWS_PER_CHUNK).metro_cleaned


def q_od_records_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TapFlow(spark, sf_dir, hot_threshold=0,
                   rows_per_chunk=CHECK_ROWS_PER_CHUNK).od_records


def queries() -> dict[str, Query]:
    return {
        "table_scan": q_table_scan,
        "delimited_scan": q_delimited_scan,
        "file_to_table": q_file_to_table,
        "file_rejects": q_file_rejects,
        "table_sink_partitioned": q_table_sink_partitioned,
        "table_sink_plain": q_table_sink_plain,
        "table_sink_day": q_table_sink_day,
        "bus_cleaned": _chain("bus_cleaned"),
        "metro_trip_ids": _chain("metro_trip_ids"),
        "single_tap_trips": q_single_tap_trips,
        "anti_single_tap": q_anti_single_tap,
        "metro_cleaned": _chain("metro_cleaned"),
        "site_line_no": q_site_line_no,
        "bus_with_site": _chain("bus_with_site"),
        "metro_with_site": _chain("metro_with_site"),
        "metro_aligned": q_metro_aligned,
        "duplicate_site_keys": q_duplicate_site_keys,
        "all_taps": _chain("all_taps"),
        "tap_gaps": _chain("tap_gaps"),
        "trip_segments": _chain("trip_segments"),
        "endpoint_marks": _chain("endpoint_marks"),
        "od_records": _chain("od_records"),
        "passenger_flow": _chain("passenger_flow"),
        "flow_preview": q_flow_preview,
        "metro_cleaned_chunked": q_metro_cleaned_chunked,
        "od_records_chunked": q_od_records_chunked,
    }
