"""Map the driver's generated tables onto the domain tables.

The reference ships no tap files, so the test inputs are derived from the
``events`` and ``nation`` tables with a fixed rule (FIXTURES.md section 3).
Everything here is a narrow projection of one scan: no shuffle, and the
derived tables grow with ``events``.

Fixed values (the derivation rule):
  card_id    = string(user_id % 25)
  trade_date = yyyyMMdd of ts
  line       = string(event_id % 5); '' if event_id % 33 = 0, null if event_id % 34 = 0
  station    = 'NATION_99' if event_id % 7 = 0 else 'NATION_' || event_id % 25,
               plus one trailing blank if event_id % 3 = 0
  metro taps = even event_id; io_type I for click/view, O for purchase/signup,
               null for error; card_type '01'; device_id 'D1'
  bus rides  = odd event_id; card_type '01'; trade_type '06';
               boarding (mark_*) null for error events, alighting (trade_*)
               null for signup events; alighting time = ts + floor(value)
               minutes; alighting station 'NATION_' || (event_id + 5) % 25;
               trip id string(event_id % 12); bus id 'B' || event_id % 12
  tap lines  = the metro taps as lines of a tap file; of every 20 ids, one has a
               time that is none (2), one its first five fields only (4), and
               one a ninth field (6)
  repeats    = a tap whose event_id % 40 is 22 (metro) or 1 (bus) stands twice; one
               where it is 2 (metro) or 21 (bus) has a twin at the same time whose
               stations are 7 further on (no blank), a metro twin with I for O and
               O for I
  stations   = one per nation row: line_no string(n_regionkey),
               line_name line_no || '号线', station_id string(n_nationkey),
               station_name n_name, longitude 116 + n_nationkey / 100,
               latitude 39 + n_nationkey / 100, both decimal(10,7); further rows for
               n_nationkey % 8 = 3 (station_id + 100), % 12 = 5 (the same row), % 10 = 7
               (line '', name '八通线', station_id + 200), % 10 = 9 (null line and line
               name, station_id + 300)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CARDS = 25
LINES = 5
STATIONS = 25
BUS_TRIPS = 12
UNKNOWN_STATION = "NATION_99"
LINE_SUFFIX = "号线"
DIGITLESS_LINE = "八通线"
#: How a repeated tap or station row comes about.
OWN, COPY, TWIN = 0, 1, 2
TWIN_STEP = 7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _card() -> Column:
    return (F.col("user_id") % CARDS).cast("string")


def _trade_date() -> Column:
    # date -> 'yyyy-MM-dd' -> 'yyyyMMdd'; independent of the session time zone
    return F.regexp_replace(F.col("ts").cast("date").cast("string"), "-", "")


def _line() -> Column:
    eid = F.col("event_id")
    return F.when(eid % 33 == 0, F.lit("")).when(eid % 34 == 0, F.lit(None)).otherwise((eid % LINES).cast("string"))


def _station() -> Column:
    eid = F.col("event_id")
    base = F.when(eid % 7 == 0, F.lit(UNKNOWN_STATION)).otherwise(
        F.concat(F.lit("NATION_"), (eid % STATIONS).cast("string")))
    own = F.concat(base, F.when(eid % 3 == 0, F.lit(" ")).otherwise(F.lit("")))
    return F.when(F.col("_kind") == TWIN, _station_no(TWIN_STEP)).otherwise(own)


def _station_no(step: int) -> Column:
    return F.concat(F.lit("NATION_"), ((F.col("event_id") + step) % STATIONS).cast("string"))


def _repeated(events: DataFrame, copy: int, twin: int) -> DataFrame:
    """``events`` with ``_kind``: a second row for the copied and the twin taps."""
    at = F.col("event_id") % 40
    kinds = F.when(at == copy, F.array(F.lit(OWN), F.lit(COPY))).when(at == twin, F.array(F.lit(OWN), F.lit(TWIN))).otherwise(
        F.array(F.lit(OWN)))
    return events.withColumn("_kind", F.explode(kinds))


def metro_taps(events: DataFrame, *more: str) -> DataFrame:
    """Metro gate taps (8 fields of the metro tap file) from ``events``, and its columns ``more``."""
    et = F.col("event_type")
    same, other = F.col("_kind") != TWIN, F.col("_kind") == TWIN
    io = (F.when(et.isin("click", "view") & same | et.isin("purchase", "signup") & other, F.lit("I"))
          .when(et.isin("purchase", "signup", "click", "view"), F.lit("O")))
    return _repeated(events.where(F.col("event_id") % 2 == 0), copy=22, twin=2).select(
        _card().alias("card_id"),
        F.lit("01").alias("card_type"),
        _line().alias("line_id"),
        _station().alias("station_id"),
        F.lit("D1").alias("device_id"),
        F.col("ts").alias("trade_time"),
        io.alias("io_type"),
        _trade_date().alias("trade_date"),
        *more,
    )


BAD_TIME, SHORT, LONG, OF_IDS = 2, 4, 6, 20


def metro_lines(events: DataFrame) -> DataFrame:
    """Lines (``value``) of a metro tap file, some of which do not parse."""
    taps = metro_taps(events.withColumn("_flaw", F.col("event_id") % OF_IDS), "_flaw")
    flaw = F.col("_flaw")
    time = F.when(flaw == BAD_TIME, F.lit("no time")).otherwise(F.col("trade_time").cast("string"))
    line_id = F.when(F.col("line_id") == "", F.lit('""')).otherwise(F.coalesce("line_id", F.lit("")))
    head = [F.col("card_id"), F.col("card_type"), line_id, F.col("station_id"), F.col("device_id")]
    rest = [time, F.coalesce("io_type", F.lit("")), F.col("trade_date")]
    line = F.concat_ws("\t", *head, *rest)
    return taps.select(F.when(flaw == SHORT, F.concat_ws("\t", *head))
                       .when(flaw == LONG, F.concat(line, F.lit("\textra"))).otherwise(line).alias("value"))


def bus_rides(events: DataFrame) -> DataFrame:
    """Bus rides (14 fields of the bus ride file) from ``events``."""
    eid = F.col("event_id")
    et = F.col("event_type")

    def board(c: Column) -> Column:
        return F.when(et == "error", F.lit(None)).otherwise(c)

    def alight(c: Column) -> Column:
        return F.when(et == "signup", F.lit(None)).otherwise(c)

    trip = (eid % BUS_TRIPS).cast("string")
    bus = F.concat(F.lit("B"), trip)
    alight_time = F.col("ts") + F.make_dt_interval(
        mins=F.floor("value").cast("int"))
    alight_station = F.when(F.col("_kind") == TWIN, _station_no(5 + TWIN_STEP)).otherwise(_station_no(5))
    return _repeated(events.where(eid % 2 == 1), copy=1, twin=21).select(
        _card().alias("card_id"),
        F.lit("01").alias("card_type"),
        F.lit("06").alias("trade_type"),
        board(F.col("ts")).alias("mark_time"),
        board(_line()).alias("mark_line_id"),
        board(_station()).alias("mark_station"),
        board(bus).alias("mark_bus_id"),
        board(trip).alias("mark_tms_id"),
        alight(alight_time).alias("trade_time"),
        alight(_line()).alias("trade_line_id"),
        alight(alight_station).alias("trade_station"),
        alight(bus).alias("trade_bus_id"),
        alight(trip).alias("trade_tms_id"),
        _trade_date().alias("trade_date"),
    )


def _coordinate(base: int) -> Column:
    # exact decimal arithmetic: (base * 100 + key) * 0.01
    cents = (F.lit(base * 100) + F.col("n_nationkey")).cast("decimal(10,0)")
    return (cents * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(10,7)")


def bus_stations(nation: DataFrame) -> DataFrame:
    """Bus station table (JDBC layout) from ``nation``."""
    key = F.col("n_nationkey")
    more = [F.when(key % 8 == 3, F.lit(100)), F.when(key % 12 == 5, F.lit(0)),
            F.when(key % 10 == 7, F.lit(200)), F.when(key % 10 == 9, F.lit(300))]
    rows = nation.withColumn("_more", F.explode(F.filter(F.array(F.lit(0), *more), lambda x: x.isNotNull())))
    plain = F.col("_more") < 200
    line_no = F.col("n_regionkey").cast("string")
    digitless = F.col("_more") == 200
    return rows.select(
        F.when(plain, line_no).when(digitless, F.lit("")).alias("line_no"),
        F.when(plain, F.concat(line_no, F.lit(LINE_SUFFIX))).when(digitless, F.lit(DIGITLESS_LINE)).alias("line_name"),
        (key + F.col("_more")).cast("string").alias("station_id"),
        F.col("n_name").alias("station_name"),
        _coordinate(116).alias("station_longitude"),
        _coordinate(39).alias("station_latitude"),
    )


def metro_stations(nation: DataFrame) -> DataFrame:
    """Metro station table (JDBC layout; no ``line_no``) from ``nation``."""
    return bus_stations(nation).drop("line_no")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def load_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation")


def domain_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four input tables of the pipeline, derived from ``sf_dir``."""
    events = load_events(spark, sf_dir)
    nation = load_nation(spark, sf_dir)
    return {
        "bus_rides": bus_rides(events),
        "metro_taps": metro_taps(events),
        "bus_stations": bus_stations(nation),
        "metro_stations": metro_stations(nation),
    }
