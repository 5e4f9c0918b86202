"""The ten batch steps: table(s) in, table out.

Each step reads tables (or a file / JDBC source), applies the operators and
overwrites its output table, partitioned by ``trade_date`` except for the
station tables.  Every step takes its table names as arguments: catalog names,
which need a catalog that outlives the process, or Parquet folders (a name with
a slash).  Connection options for JDBC come from the caller.

Order: (bus-load -> bus-clean), (metro-load -> metro-clean),
(bus-sites-load, bus-clean -> bus-join-site),
(metro-sites-load, metro-clean -> metro-join-site),
(bus-join-site, metro-join-site -> merge), (merge -> od-flow).

With ``buckets`` the two clean steps write tables bucketed by card and partitioned by
day: one shuffle each.  The join steps keep the buckets of their input (a broadcast
join moves no tap), the merge's distinct and every window of the OD cut read them in
place, so no card is shuffled again until the flow is counted.  A bucket is read by one
task, so a step whose input has a hot card writes a plain table instead, and the steps
after it shuffle and split that card as they do without buckets.

With ``restartable`` a step can be killed at any time and run again: it writes a
version of its table beside the one that readers see, publishes it in one catalog
step together with a record of the inputs it was made from, and is skipped when that
record says that it is done (``tapflow.sources.versions``).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tapflow.operators import clean, flow, merge, sites, skew, trips
from tapflow.sources import delimited, jdbc, schemas, tables, versions

log = logging.getLogger("tapflow")

PARTITION = tables.PARTITION
BUCKET = "card_id"


@dataclass
class StepOptions:
    db: str | None = None
    jdbc: dict[str, str] = field(default_factory=dict)
    hot_threshold: int | None = skew.HOT_ROWS_PER_KEY
    rows_per_chunk: int = skew.ROWS_PER_CHUNK
    path: str | None = None  # optional external location of the output table
    restartable: bool = False  # publish versions, skip finished work (catalog names only)
    rejects: str | None = None  # table for the lines of a tap file that do not parse
    buckets: int = 0  # of card_id, for the tables between the clean steps and the OD cut
    mode: str = "overwrite"  # or "partitions": replace only the days that the input holds


@dataclass
class Step:
    inputs: int
    run: Callable[[SparkSession, list[str], StepOptions], str]
    preview_order: list[str] = field(default_factory=list)  # only for small tables
    preview_rows: int = 5
    help: str = ""


def _read(spark: SparkSession, name: str, o: StepOptions) -> DataFrame:
    return tables.read_table(spark, name, o.db)


def _write(df: DataFrame, name: str, o: StepOptions, sort_by: Sequence[str] = (), buckets: int = 0) -> str:
    """``buckets``: the rows are dealt out by card over so many tasks, and stay so."""
    tables.write_table(df, name, db=o.db, partition_by=PARTITION, path=o.path, mode=o.mode, sort_by=sort_by,
                       bucket_by=BUCKET, buckets=buckets, cluster=not buckets)
    return name


def _buckets_for(taps: DataFrame, name: str, o: StepOptions) -> int:
    """``o.buckets`` where the output can be bucketed and no card is hot, else 0."""
    if not o.buckets or tables.is_path(name) or o.mode != "overwrite":
        return 0
    hot = o.hot_threshold is not None and skew.find_hot_keys(taps, [BUCKET], o.hot_threshold)
    return 0 if hot else o.buckets


def _buckets_of(spark: SparkSession, names: list[str], output: str, o: StepOptions) -> int:
    """The buckets that all tables ``names`` have in common, for an output like them."""
    have = {tables.buckets_of(spark, n, BUCKET, o.db) for n in names}
    return have.pop() if len(have) == 1 and not tables.is_path(output) and o.mode == "overwrite" else 0


def _file_load(schema):
    def run(spark: SparkSession, a: list[str], o: StepOptions) -> str:
        if o.rejects:
            counts = delimited.load_with_rejects(spark, a[0], schema, a[1], o.rejects, db=o.db, partition_by=PARTITION,
                                                 table_path=o.path, mode=o.mode)
            log.info("%s: %s", a[1], counts)
            return a[1]
        delimited.load_file_to_table(spark, a[0], schema, a[1], db=o.db,
                                     partition_by=PARTITION, table_path=o.path, mode=o.mode)
        return a[1]
    return run


def _jdbc_load(spark: SparkSession, a: list[str], o: StepOptions) -> str:
    options = dict(o.jdbc)
    options.setdefault("dbtable", a[0])
    jdbc.load_jdbc_to_table(spark, options, a[1], db=o.db, table_path=o.path)
    return a[1]


def _dealt(taps: DataFrame, buckets: int) -> DataFrame:
    return taps.repartition(buckets, BUCKET) if buckets else taps


def _bus_clean(spark, a, o):
    rides = _read(spark, a[0], o)
    buckets = _buckets_for(rides, a[1], o)
    return _write(clean.clean_bus(_dealt(rides, buckets)), a[1], o, buckets=buckets)


def _metro_clean(spark, a, o):
    taps = _read(spark, a[0], o)
    buckets = _buckets_for(taps, a[1], o)
    # no card is hot then, so no card-day is
    cleaned = clean.clean_metro(_dealt(taps, buckets), hot_threshold=None if buckets else o.hot_threshold,
                                rows_per_chunk=o.rows_per_chunk)
    return _write(cleaned, a[1], o, buckets=buckets)


def _bus_join(spark, a, o):
    joined = sites.attach_bus_sites(_read(spark, a[0], o), _read(spark, a[1], o))
    return _write(joined, a[2], o, buckets=_buckets_of(spark, a[:1], a[2], o))


def _metro_join(spark, a, o):
    joined = sites.attach_metro_sites(_read(spark, a[0], o), _read(spark, a[1], o))
    return _write(joined, a[2], o, buckets=_buckets_of(spark, a[:1], a[2], o))


def _merge(spark, a, o):
    merged = merge.merge_taps(_read(spark, a[0], o), _read(spark, a[1], o))
    return _write(merged, a[2], o, buckets=_buckets_of(spark, a[:2], a[2], o))


def _od_flow(spark, a, o):
    od = trips.od_records(_read(spark, a[0], o), hot_threshold=o.hot_threshold,
                          rows_per_chunk=o.rows_per_chunk)
    # the stored order is not part of the table's contract: sort inside each
    # task instead of a global range sort before a partitioned write
    return _write(flow.passenger_flow(od, sort=False), a[1], o, sort_by=flow.FLOW_ORDER)


STEPS: dict[str, Step] = {
    "bus-load": Step(2, _file_load(schemas.BUS_RIDE),
                     help="<bus file> <table>: tab-separated bus rides -> table"),
    "metro-load": Step(2, _file_load(schemas.METRO_TAP),
                       help="<metro file> <table>: tab-separated metro taps -> table"),
    "bus-sites-load": Step(2, _jdbc_load,
                           help="<jdbc table> <table>: bus stations over JDBC -> table"),
    "metro-sites-load": Step(2, _jdbc_load,
                             help="<jdbc table> <table>: metro stations over JDBC -> table"),
    "bus-clean": Step(2, _bus_clean, help="<raw bus table> <cleaned table>"),
    "metro-clean": Step(2, _metro_clean, help="<raw metro table> <cleaned table>"),
    "bus-join-site": Step(3, _bus_join,
                          help="<cleaned bus table> <bus station table> <output table>"),
    "metro-join-site": Step(3, _metro_join,
                            help="<cleaned metro table> <metro station table> <output table>"),
    "merge": Step(3, _merge, help="<bus with site> <metro with site> <merged table>"),
    "od-flow": Step(2, _od_flow, flow.FLOW_ORDER + ["station_name"], preview_rows=20,
                    help="<merged table> <flow table>"),
}


def run_step(spark: SparkSession, name: str, args: list[str],
             options: StepOptions | None = None) -> DataFrame:
    """Run step ``name``; returns the written table (as read back)."""
    step = STEPS[name]
    if len(args) != step.inputs:
        raise ValueError(f"{name} takes {step.inputs} table names: {step.help}")
    o = options or StepOptions()
    if o.restartable:
        return _versioned(spark, name, step, args, o)
    out = step.run(spark, args, o)
    return tables.read_table(spark, out, o.db)


def _versioned(spark: SparkSession, name: str, step: Step, args: list[str], o: StepOptions) -> DataFrame:
    """The step into a version of its own, published when it is whole."""
    if o.path or o.mode != "overwrite":
        raise ValueError("a restartable step writes whole managed tables")
    *inputs, target = args
    made_from = versions.record(spark, name, inputs, o.db)
    if versions.published_record(spark, target, o.db) == made_from:
        log.info("%s: %s is up to date", name, target)
        return tables.read_table(spark, target, o.db)
    version = versions.new_version(spark, target, o.db)
    step.run(spark, [*inputs, version], o)
    versions.publish(spark, target, version, made_from, o.db)
    return tables.read_table(spark, target, o.db)
