"""DuckDB oracle: the reference semantics written once more as plain SQL.

Each key of ``tapflow.plans.queries`` has an SQL text that DuckDB runs on the
driver's tables (views ``events`` and ``nation``).  The SQL is written from
the rules, not from the Spark code: the metro cleaning uses the reference's
string trip key with an anti join, the OD cut uses ``rank`` windows.

Matching rules: Spark sorts nulls first ascending and last descending, so
every ORDER BY says so; sums and ranks are cast to Spark's result types.
"""

from __future__ import annotations

from tapflow.operators.clean import METRO_TIE
from tapflow.operators.trips import GAP_TIE, STATION_TIE
from tapflow.sources.schemas import MERGED_COLUMNS


def _asc(cols: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


def _desc(cols: list[str]) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


_STATION = ("CASE WHEN twin = 2 THEN 'NATION_' || CAST((event_id + 7) % 25 AS VARCHAR) "
            "ELSE (CASE WHEN event_id % 7 = 0 THEN 'NATION_99' "
            "ELSE 'NATION_' || CAST(event_id % 25 AS VARCHAR) END) "
            "|| (CASE WHEN event_id % 3 = 0 THEN ' ' ELSE '' END) END")
_DATE = "strftime(ts, '%Y%m%d')"
_CARD = "CAST(user_id % 25 AS VARCHAR)"
_LINE = ("CASE WHEN event_id % 33 = 0 THEN '' WHEN event_id % 34 = 0 THEN NULL "
         "ELSE CAST(event_id % 5 AS VARCHAR) END")
_TRIP = "CAST(event_id % 12 AS VARCHAR)"


def _board(expr: str) -> str:
    return f"CASE WHEN event_type = 'error' THEN NULL ELSE {expr} END"


def _alight(expr: str) -> str:
    return f"CASE WHEN event_type = 'signup' THEN NULL ELSE {expr} END"


def _coord(base: int) -> str:
    return (f"CAST(CAST({base * 100} + n_nationkey AS DECIMAL(10,0)) "
            f"* CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,7))")


_TAP = f"""{_CARD} AS card_id, '01' AS card_type, {_LINE} AS line_id,
               {_STATION} AS station_id, 'D1' AS device_id, ts AS trade_time,
               CASE WHEN event_type IN ('click', 'view') THEN (CASE WHEN twin = 2 THEN 'O' ELSE 'I' END)
                    WHEN event_type IN ('purchase', 'signup') THEN (CASE WHEN twin = 2 THEN 'I' ELSE 'O' END)
               END AS io_type,
               {_DATE} AS trade_date"""
# a second row for copied (1) and twin (2) taps
_METRO = """(SELECT *, unnest(CASE event_id % 40 WHEN 22 THEN [0, 1] WHEN 2 THEN [0, 2] ELSE [0] END) AS twin
             FROM events WHERE event_id % 2 = 0)"""
_BUS = """(SELECT *, unnest(CASE event_id % 40 WHEN 1 THEN [0, 1] WHEN 21 THEN [0, 2] ELSE [0] END) AS twin
           FROM events WHERE event_id % 2 = 1)"""

_MERGED = ", ".join(MERGED_COLUMNS)

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {
    "metro_taps": ([], f"""
        SELECT {_TAP} FROM {_METRO} e"""),
    "metro_lines": ([], f"""
        SELECT *, event_id % 20 AS kind, concat_ws(chr(9), card_id, card_type,
               CASE WHEN line_id = '' THEN '""' ELSE coalesce(line_id, '') END, station_id, device_id) AS head
        FROM (SELECT event_id, {_TAP} FROM {_METRO} e) t"""),
    "bus_rides": ([], f"""
        SELECT {_CARD} AS card_id, '01' AS card_type, '06' AS trade_type,
               {_board('ts')} AS mark_time,
               {_board(_LINE)} AS mark_line_id,
               {_board(_STATION)} AS mark_station,
               {_board("'B' || " + _TRIP)} AS mark_bus_id,
               {_board(_TRIP)} AS mark_tms_id,
               {_alight('ts + to_minutes(CAST(floor(value) AS BIGINT))')} AS trade_time,
               {_alight(_LINE)} AS trade_line_id,
               {_alight("'NATION_' || CAST((event_id + 5 + (CASE WHEN twin = 2 THEN 7 ELSE 0 END)) % 25 AS VARCHAR)")} AS trade_station,
               {_alight("'B' || " + _TRIP)} AS trade_bus_id,
               {_alight(_TRIP)} AS trade_tms_id,
               {_DATE} AS trade_date
        FROM {_BUS} e"""),
    "bus_stations": ([], f"""
        SELECT CASE WHEN more < 200 THEN CAST(n_regionkey AS VARCHAR) WHEN more = 200 THEN '' END AS line_no,
               CASE WHEN more < 200 THEN CAST(n_regionkey AS VARCHAR) || '号线' WHEN more = 200 THEN '八通线' END AS line_name,
               CAST(n_nationkey + more AS VARCHAR) AS station_id, n_name AS station_name,
               {_coord(116)} AS station_longitude, {_coord(39)} AS station_latitude
        FROM (SELECT *, 0 AS more FROM nation
              UNION ALL SELECT *, 100 FROM nation WHERE n_nationkey % 8 = 3
              UNION ALL SELECT *, 0 FROM nation WHERE n_nationkey % 12 = 5
              UNION ALL SELECT *, 200 FROM nation WHERE n_nationkey % 10 = 7
              UNION ALL SELECT *, 300 FROM nation WHERE n_nationkey % 10 = 9) n"""),
    "duplicate_site_keys": (["bus_stations"], """
        SELECT trim(line_no) AS line_no, trim(station_name) AS station_name, count(*) AS "rows"
        FROM bus_stations GROUP BY ALL HAVING count(*) > 1"""),
    "metro_stations": (["bus_stations"], """
        SELECT line_name, station_id, station_name, station_longitude, station_latitude
        FROM bus_stations"""),
    "bus_cleaned": (["bus_rides"], """
        SELECT card_id, trade_type, mark_time, mark_line_id, mark_station, mark_bus_id,
               mark_tms_id, trade_time, trade_line_id, trade_station, trade_bus_id,
               trade_tms_id, trade_date,
               coalesce(mark_tms_id, trade_tms_id) AS tms_id,
               coalesce(mark_time, trade_time) AS mark_trade_time,
               CASE WHEN mark_time IS NOT NULL THEN 'I' ELSE 'O' END AS IO_TYPE
        FROM bus_rides"""),
    "metro_trip_ids": (["metro_taps"], """
        SELECT *, concat_ws('_', trade_date, card_id, CAST(tms_id AS VARCHAR)) AS tct
        FROM (SELECT *, CAST(sum(once_od) OVER (PARTITION BY trade_date, card_id
                                 ORDER BY trade_time ASC NULLS FIRST) AS BIGINT) AS tms_id
              FROM (SELECT *, CASE WHEN io_type = 'I' THEN 1 ELSE 0 END AS once_od
                    FROM metro_taps) t) u"""),
    "single_tap_trips": (["metro_trip_ids"], """
        SELECT tct, count(*) AS "count" FROM metro_trip_ids GROUP BY tct HAVING count(*) = 1"""),
    "anti_single_tap": (["metro_trip_ids", "single_tap_trips"], """
        SELECT * FROM metro_trip_ids m
        WHERE NOT EXISTS (SELECT 1 FROM single_tap_trips s WHERE s.tct = m.tct)"""),
    "metro_cleaned": (["anti_single_tap"], f"""
        SELECT card_id, card_type, line_id, station_id, trade_time, io_type, trade_date,
               once_od, tms_id, tct, last_io_type
        FROM (SELECT *, lag(io_type, 1, 'O') OVER (PARTITION BY trade_date, card_id
                  ORDER BY {_asc(['trade_time'] + METRO_TIE)}) AS last_io_type
              FROM anti_single_tap) t
        WHERE io_type <> last_io_type"""),
    "site_line_no": (["metro_stations"], r"""
        SELECT *, regexp_extract(line_name, '(\d+).*', 1) AS line_no FROM metro_stations"""),
    "bus_with_site": (["bus_cleaned", "bus_stations"], """
        SELECT b.*, s.station_id, s.station_longitude, s.station_latitude
        FROM (SELECT *, coalesce(mark_line_id, trade_line_id) AS line_no,
                     coalesce(mark_station, trade_station) AS station_name
              FROM bus_cleaned) b
        JOIN bus_stations s
          ON trim(b.line_no) = trim(s.line_no) AND trim(b.station_name) = trim(s.station_name)"""),
    "metro_with_site": (["metro_cleaned", "site_line_no"], """
        SELECT m.*, s.station_id, s.station_longitude, s.station_latitude
        FROM (SELECT card_id, card_type, line_id AS line_no, station_id AS station_name,
                     trade_time, io_type, trade_date, once_od, tms_id, tct, last_io_type
              FROM metro_cleaned) m
        JOIN site_line_no s
          ON trim(m.line_no) = trim(s.line_no) AND trim(m.station_name) = trim(s.station_name)"""),
    "metro_aligned": (["metro_with_site"], """
        SELECT card_id,
               CASE WHEN io_type = 'I' THEN trade_time END AS mark_time,
               CASE WHEN io_type = 'I' THEN line_no END AS mark_line_id,
               CASE WHEN io_type = 'I' THEN station_name END AS mark_station,
               CASE WHEN io_type = 'I' THEN CAST(tms_id AS VARCHAR) END AS mark_tms_id,
               CASE WHEN io_type = 'O' THEN trade_time END AS trade_time,
               CASE WHEN io_type = 'O' THEN line_no END AS trade_line_id,
               CASE WHEN io_type = 'O' THEN station_name END AS trade_station,
               CASE WHEN io_type = 'O' THEN CAST(tms_id AS VARCHAR) END AS trade_tms_id,
               trade_time AS mark_trade_time, CAST(tms_id AS VARCHAR) AS tms_id,
               io_type AS IO_TYPE, line_no, station_name, station_id,
               station_longitude, station_latitude, trade_date
        FROM metro_with_site"""),
    "all_taps": (["bus_with_site", "metro_aligned"], f"""
        SELECT {_MERGED} FROM bus_with_site
        UNION
        SELECT {_MERGED} FROM metro_aligned"""),
    "tap_gaps": (["all_taps"], f"""
        SELECT *, mark_trade_timestamp - lag(mark_trade_timestamp, 1, 0) OVER (
                  PARTITION BY trade_date, card_id
                  ORDER BY {_asc(['tms_id', 'mark_trade_timestamp'] + GAP_TIE)}) AS duration
        FROM (SELECT *, epoch_us(mark_trade_time) // 1000000 AS mark_trade_timestamp,
                     CASE WHEN IO_TYPE = 'I' THEN 1 ELSE 0 END AS mask
              FROM all_taps) t"""),
    "trip_segments": (["tap_gaps"], """
        SELECT *, CASE WHEN new_mask = 1 THEN 'I' ELSE 'O' END AS new_io_type
        FROM (SELECT *, CAST(sum(new_mask) OVER (PARTITION BY trade_date, card_id
                  ORDER BY tms_id ASC NULLS FIRST, mark_trade_timestamp ASC NULLS FIRST)
                  AS BIGINT) AS new_tms_id
              FROM (SELECT *, CASE WHEN duration * mask > 3600 THEN 1 ELSE 0 END AS new_mask
                    FROM tap_gaps) t) u"""),
    "endpoint_marks": (["trip_segments"], """
        SELECT * EXCLUDE (r_first, r_last),
               CASE WHEN r_last = 1 THEN 999 WHEN r_first = 1 THEN 0 ELSE 9 END AS marker
        FROM (SELECT *,
                rank() OVER (PARTITION BY trade_date, card_id, new_tms_id
                             ORDER BY tms_id ASC NULLS FIRST,
                                      mark_trade_timestamp ASC NULLS FIRST) AS r_first,
                rank() OVER (PARTITION BY trade_date, card_id, new_tms_id
                             ORDER BY tms_id ASC NULLS FIRST,
                                      mark_trade_timestamp DESC NULLS LAST) AS r_last
              FROM trip_segments) t"""),
    "od_records": (["endpoint_marks"], f"""
        SELECT card_id, trade_date, mark_time AS o_time, mark_line_id AS o_line,
               mark_station AS o_station, trade_time AS d_time, trade_line_id AS d_line,
               trade_station AS d_station,
               first_value(station_name) OVER (PARTITION BY trade_date, card_id
                   ORDER BY {_asc(['mark_trade_time'] + STATION_TIE)})
               || '-' ||
               first_value(station_name) OVER (PARTITION BY trade_date, card_id
                   ORDER BY {_desc(['mark_trade_time'] + STATION_TIE)}) AS od_desc,
               CASE WHEN IO_TYPE = 'I' THEN 0 ELSE 1 END AS od_type,
               station_name, station_longitude, station_latitude
        FROM endpoint_marks WHERE marker = 0 OR marker = 999"""),
    "passenger_flow": (["od_records"], """
        SELECT trade_date, od_desc, od_type, station_name, station_longitude,
               station_latitude, count(*) AS passenger_flow
        FROM od_records
        GROUP BY trade_date, od_desc, od_type, station_name, station_longitude,
                 station_latitude"""),
}


def _closure(name: str) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in CTES[n][0]:
            visit(d)
        if n not in order:
            order.append(n)
    visit(name)
    return order


def sql_for(name: str, select: str | None = None) -> str:
    """WITH-query that defines ``name`` and everything it depends on."""
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in _closure(name)]
    body = select or f"SELECT * FROM {name}"
    return "WITH " + ",\n".join(parts) + "\n" + body


_FLOW_KEY = "trade_date, od_desc, od_type, station_name, station_longitude, station_latitude"


def oracle_sql() -> dict[str, str]:
    keys = ["bus_cleaned", "metro_trip_ids", "single_tap_trips", "anti_single_tap",
            "metro_cleaned", "site_line_no", "bus_with_site", "metro_with_site",
            "metro_aligned", "duplicate_site_keys", "all_taps", "tap_gaps", "trip_segments", "endpoint_marks",
            "od_records", "passenger_flow"]
    out = {k: sql_for(k) for k in keys}
    out["metro_cleaned_chunked"] = out["metro_cleaned"]
    out["od_records_chunked"] = out["od_records"]
    out["table_scan"] = "SELECT * FROM events"
    # an empty field of a file is read as null, quoted or not
    out["delimited_scan"] = sql_for("bus_rides", """
        SELECT * REPLACE (nullif(mark_line_id, '') AS mark_line_id, nullif(trade_line_id, '') AS trade_line_id) FROM bus_rides""")
    out["file_to_table"] = sql_for("metro_taps", "SELECT * REPLACE (nullif(line_id, '') AS line_id) FROM metro_taps")
    out["file_rejects"] = sql_for("metro_lines", r"""
        SELECT * EXCLUDE (event_id, kind, head) REPLACE (nullif(line_id, '') AS line_id), NULL AS line, NULL AS reason
        FROM metro_lines WHERE kind NOT IN (2, 4, 6)
        UNION ALL BY NAME
        SELECT CASE kind WHEN 2 THEN concat_ws(chr(9), head, 'no time', coalesce(io_type, ''), trade_date)
                         WHEN 4 THEN head
                         ELSE concat_ws(chr(9), head, regexp_replace(
                              strftime(trade_time, '%Y-%m-%d %H:%M:%S.%f'), '\.?0+$', ''),
                              coalesce(io_type, ''), trade_date, 'extra') END AS line,
               CASE kind WHEN 2 THEN 'value' WHEN 4 THEN 'short' ELSE 'long' END AS reason
        FROM metro_lines WHERE kind IN (2, 4, 6)""")
    out["table_sink_partitioned"] = sql_for("bus_cleaned")
    out["table_sink_day"] = sql_for("bus_cleaned", """
        SELECT * REPLACE (CASE WHEN trade_date = (SELECT min(trade_date) FROM bus_cleaned) THEN '99'
                               ELSE trade_type END AS trade_type)
        FROM bus_cleaned
        WHERE mark_time IS NOT NULL OR trade_date <> (SELECT min(trade_date) FROM bus_cleaned)""")
    out["table_sink_plain"] = sql_for("bus_stations")
    out["flow_preview"] = sql_for(
        "passenger_flow",
        "SELECT * FROM passenger_flow ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in _FLOW_KEY.split(", "))
        + " LIMIT 20")
    return out
