"""Cut each card-day into origin-destination trips.

Taps of a card-day are ordered by (trip id as text, epoch second).  An entry
whose distance to the previous tap exceeds the gap opens a new OD trip; the
first and last taps of each OD trip are kept and labelled with the first and
last station of the whole card-day.  The rules follow the reference exactly,
including its quirks:

* trip ids sort as text (``"10" < "9"``), so ``duration`` can be negative;
* the first tap of a card-day measures its distance from epoch 0, so an
  entry there opens trip 1 and an exit there stays in trip 0;
* only entries can open a trip (``duration * mask``);
* the trip end is the latest tap *of the smallest trip id* in the OD trip;
* rank ties keep several endpoint rows; a one-row trip gets marker 999 only;
* ``od_desc`` spans the whole card-day and is computed after the endpoint
  filter.

Every window is partitioned by (trade_date, card_id) or a refinement of it,
so the whole cut runs on a single hash exchange.  Where the order among peers
changes a result (``lag``, ``first``) a total tie-break is appended; running
sums and ranks keep their peer semantics untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapflow.functions.columns import epoch_seconds, flag
from tapflow.operators import skew
from tapflow.session import shared_dir
from tapflow.sources.schemas import OD_COLUMNS

CARD_DAY = ["trade_date", "card_id"]
# Fixed value: a gap longer than one hour before an entry starts a new OD trip.
GAP_SECONDS = 3600
# Endpoint markers (origin, inner tap, destination).
ORIGIN, INNER, DESTINATION = 0, 9, 999

EPOCH = "mark_trade_timestamp"
# Columns after the order keys that make the order of merged taps total.
_REST = ["IO_TYPE", "station_id", "line_no", "station_name", "mark_time", "trade_time",
         "mark_line_id", "mark_station", "mark_tms_id", "trade_line_id", "trade_station",
         "trade_tms_id", "station_longitude", "station_latitude"]
GAP_TIE = ["mark_trade_time"] + _REST
STATION_TIE = ["tms_id"] + _REST


def _gap_order() -> Window:
    return Window.partitionBy(*CARD_DAY).orderBy("tms_id", EPOCH)


def tap_gaps(taps: DataFrame) -> DataFrame:
    """Epoch second, entry mask and distance to the previous tap."""
    order = Window.partitionBy(*CARD_DAY).orderBy("tms_id", EPOCH, *GAP_TIE)
    return (taps
            .withColumns({EPOCH: epoch_seconds(taps, "mark_trade_time"),
                          "mask": flag(F.col("IO_TYPE") == "I")})
            .withColumn("duration", F.col(EPOCH) - F.lag(EPOCH, 1, 0).over(order)))


def trip_segments(gaps: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """``new_mask`` opens a trip; ``new_tms_id`` numbers trips.

    The running sum orders by a prefix of the ``lag`` order, so it reuses
    that sort.
    """
    opens = flag(F.col("duration") * F.col("mask") > gap_seconds)
    return gaps.withColumns({
        "new_mask": opens,
        "new_tms_id": F.sum(opens).over(_gap_order()),
        "new_io_type": F.when(opens == 1, F.lit("I")).otherwise(F.lit("O")),
    })


def endpoint_marks(segments: DataFrame) -> DataFrame:
    """0 for a trip's first tap, 999 for its end, 9 otherwise.

    ``rank() == 1`` in (trip id, epoch) order holds for the taps equal to
    the OD trip's first key; in (trip id, epoch desc) order for the taps
    equal to the last key among the trip's smallest trip id.  OD trips are
    contiguous in the gap order, so both come from the sort the gaps already
    made: the first key is carried forward from each trip's first tap, and
    the end of the smallest-trip-id run is found with ``lead`` and spread to
    its equal-key peers by a window over (trip id, epoch) -- a prefix of the
    same order.  No second sort.
    """
    order = Window.partitionBy(*CARD_DAY).orderBy("tms_id", EPOCH, *GAP_TIE)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peers = Window.partitionBy(*CARD_DAY, "tms_id", EPOCH)
    seg, tms, epoch = F.col("new_tms_id"), F.col("tms_id"), F.col(EPOCH)
    prev_seg = F.lag(seg).over(order)
    step1 = segments.withColumns({
        "_start": prev_seg.isNull() | (prev_seg != seg),
        "_next_seg": F.lead(seg).over(order),
        "_next_tms": F.lead(tms).over(order),
    })
    step2 = step1.withColumn("_first", F.last(
        F.when(F.col("_start"), F.struct(tms.alias("t"), epoch.alias("e"))),
        ignorenulls=True).over(upto))
    return _marked(step2, peers).drop("_start", "_next_seg", "_next_tms", "_first")


def _run_ends() -> Column:
    """Whether the next tap is of another OD trip or trip id, or there is none."""
    return (F.col("_next_seg").isNull() | (F.col("_next_seg") != F.col("new_tms_id"))
            | ~F.col("_next_tms").eqNullSafe(F.col("tms_id")))


def _marked(rows: DataFrame, peers: Window) -> DataFrame:
    """``marker`` from each tap's ``_first`` key of its trip and its successor's
    ``_next_seg`` and ``_next_tms``; ``peers`` are the taps with an equal key, and
    ``_ends_later`` says whether one that is not among them ends the run."""
    tms, epoch = F.col("tms_id"), F.col(EPOCH)
    in_run = tms.eqNullSafe(F.col("_first.t"))
    is_first = in_run & epoch.eqNullSafe(F.col("_first.e"))
    # peers are of one trip, so they are in its first run together
    ended = F.max(flag(_run_ends())).over(peers) == 1
    if "_ends_later" in rows.columns:
        ended = ended | F.col("_ends_later")
    is_last = in_run & ended
    return rows.withColumn("marker", F.when(is_last, F.lit(DESTINATION))
                           .when(is_first, F.lit(ORIGIN)).otherwise(F.lit(INNER)))


def station_order() -> Column:
    """Order of taps for the first/last station: time, then a total tie-break."""
    return F.struct("mark_trade_time", *STATION_TIE)


def od_from_marks(marks: DataFrame) -> DataFrame:
    """Keep endpoints, label them, project 13 columns.

    ``first(station) over (order by time)`` is the station of the earliest
    tap: ``min_by`` over the unordered card-day window, which needs no sort
    of its own (the previous sort already clusters card-days).
    """
    day = Window.partitionBy(*CARD_DAY)
    derived = {
        "od_desc": F.concat(F.min_by("station_name", station_order()).over(day), F.lit("-"),
                            F.max_by("station_name", station_order()).over(day)),
        "od_type": F.when(F.col("IO_TYPE") == "I", F.lit(0)).otherwise(F.lit(1)),
    }
    return (marks.where(F.col("marker").isin(ORIGIN, DESTINATION))
            .select(*[(derived[src] if src in derived else F.col(src)).alias(name)
                      for name, src in OD_COLUMNS]))


class _Chunks:
    """X10 for hot card-days: the window plan's steps as ordered chunk scans.

    ``lag`` of the epoch, the trip numbering, the carried first key and the
    ``lead`` that finds the end of the smallest-trip-id run all continue
    across chunk edges.  Taps with an equal (trip id, epoch) key may straddle
    chunks: their gaps are 0, so only the first of them can open a trip and the
    running sum needs no more than the total order; the end of a run is their last
    tap, which later chunks report to the earlier ones.  Two edge tables and one station table per
    card-day: four reads of the checkpoint for the OD records.
    """

    def __init__(self, hot: DataFrame, cut: skew.Cut, gap_seconds: int = GAP_SECONDS,
                 hot_keys: int = 1):
        if gap_seconds < 0:
            raise ValueError("a gap below 0 would open trips among taps of one second")
        self.order = ["tms_id", EPOCH]
        self.total = self.order + GAP_TIE
        self.gap_seconds, self.hot_keys = gap_seconds, hot_keys
        base = (hot.withColumn(EPOCH, epoch_seconds(hot, "mark_trade_time"))
                .withColumn("mask", flag(F.col("IO_TYPE") == "I")))
        self.chunked = skew.assign_chunks(base, self.order, cut.chunks, GAP_TIE, cut.tasks)
        self.columns = [c for c in hot.columns if c != skew.KID]

    def segments(self) -> DataFrame:
        """Gaps and trip numbers, and the neighbours' trip numbers and ids.

        A chunk's first tap is the only one whose gap needs another chunk.  Its
        opening counts for every tap of the chunk, so the sums inside leave it
        out, and the edge table adds it with the openings of earlier chunks.
        """
        w, across = skew.in_chunk(self.total), skew.across_chunks()
        epoch = F.col(EPOCH)
        rows = self.chunked.withColumns({
            "_is_first": F.row_number().over(w) == 1,
            "_is_end": F.lead(F.lit(1)).over(w).isNull(),
            "_prev": F.lag(EPOCH).over(w)})
        rows = rows.withColumn("_opens", F.when(F.col("_is_first"), F.lit(0)).otherwise(
            flag((epoch - F.col("_prev")) * F.col("mask") > self.gap_seconds)))
        rows = rows.withColumn("_inner", F.sum("_opens").over(skew.in_chunk(self.order)))
        edge = skew.edges(rows, self.total, [EPOCH, "mask", "tms_id", "_inner"], [EPOCH, "_inner"],
                          ["_opens"])
        edge = edge.withColumn("_edge_epoch", F.when(
            F.row_number().over(across) == 1, F.lit(0)).otherwise(F.lag(f"last.{EPOCH}").over(across)))
        edge = edge.withColumn("_edge_opens", flag(
            (F.col(f"first.{EPOCH}") - F.col("_edge_epoch")) * F.col("first.mask") > self.gap_seconds))
        opened = F.sum(F.col("_opens") + F.col("_edge_opens")).over(
            across.rowsBetween(Window.unboundedPreceding, -1))
        edge = edge.withColumn("_offset", F.coalesce(opened, F.lit(0)) + F.col("_edge_opens"))
        edge = edge.select(
            skew.KID, skew.CHUNK, "_edge_epoch", "_edge_opens", "_offset",
            F.lag(F.col("_offset") + F.col("last._inner")).over(across).alias("_edge_prev_seg"),
            F.lead(F.col("_offset") + F.col("first._inner")).over(across).alias("_edge_next_seg"),
            F.lead("first.tms_id").over(across).alias("_edge_next_tms"))
        first = F.col("_is_first")
        rows = skew.attach(rows, edge).withColumns({
            "duration": epoch - F.when(first, F.col("_edge_epoch")).otherwise(F.col("_prev")),
            "new_mask": F.when(first, F.col("_edge_opens")).otherwise(F.col("_opens")),
            "new_tms_id": F.col("_inner") + F.col("_offset")})
        return rows.withColumn("new_io_type", F.when(F.col("new_mask") == 1, F.lit("I")).otherwise(
            F.lit("O")))

    def marks(self) -> DataFrame:
        """Every tap with its marker; one more edge table carries each trip's first key."""
        w, across = skew.in_chunk(self.total), skew.across_chunks()
        seg, tms, epoch = F.col("new_tms_id"), F.col("tms_id"), F.col(EPOCH)
        rows = self.segments()
        rows = rows.withColumns({
            "_prev_seg": F.when(F.col("_is_first"), F.col("_edge_prev_seg")).otherwise(
                F.lag(seg).over(w)),
            "_next_seg": F.when(F.col("_is_end"), F.col("_edge_next_seg")).otherwise(
                F.lead(seg).over(w)),
            "_next_tms": F.when(F.col("_is_end"), F.col("_edge_next_tms")).otherwise(
                F.lead(tms).over(w))})
        starts = F.col("_prev_seg").isNull() | (F.col("_prev_seg") != seg)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("_fill", F.last(
            F.when(starts, F.struct(tms.alias("t"), epoch.alias("e"))), ignorenulls=True).over(upto))
        rows = skew.heads(rows, self.order, self.total)
        rows = rows.withColumn("_head_ends", flag(F.col("_head") & _run_ends()))
        edge = skew.edges(rows, self.total, self.order, [*self.order, "_fill"], ["_head_ends"])
        prior = F.last("last._fill", ignorenulls=True).over(
            across.rowsBetween(Window.unboundedPreceding, -1))
        rows = skew.attach(rows, edge.select(
            skew.KID, skew.CHUNK, prior.alias("_prior"), skew.order_key("last", self.order).alias("_end_key"),
            (skew.continued("_head_ends", self.order) > 0).alias("_more_ends")))
        rows = rows.withColumns({"_first": F.coalesce("_fill", "_prior"), "_ends_later":
                                 F.col("_more_ends") & F.struct(*self.order).eqNullSafe(F.col("_end_key"))})
        peers = Window.partitionBy(skew.KID, skew.CHUNK, "tms_id", EPOCH)
        return _marked(rows, peers)

    def od(self) -> DataFrame:
        marks = self.marks().where(F.col("marker").isin(ORIGIN, DESTINATION))
        shared_dir(marks.sparkSession)
        stations = marks.groupBy(skew.KID).agg(
            F.min(station_order()).alias("_first_key"), F.max(station_order()).alias("_last_key")
        ).checkpoint(eager=True)
        # one row per hot card-day
        stations = (F.broadcast(stations) if self.hot_keys <= skew.MAX_HOT_KEYS
                    else stations.hint("merge"))
        od = (marks.join(stations, [skew.KID], "inner")
              .withColumn("od_desc", F.concat(F.col("_first_key.station_name"), F.lit("-"),
                                              F.col("_last_key.station_name")))
              .withColumn("od_type", F.when(F.col("IO_TYPE") == "I", F.lit(0)).otherwise(F.lit(1))))
        return od.select(*[F.col(src).alias(name) for name, src in OD_COLUMNS])


def _windows(taps: DataFrame, step: str, gap_seconds: int) -> DataFrame:
    out = tap_gaps(taps)
    if step != "gaps":
        out = trip_segments(out, gap_seconds)
    if step in ("marks", "records"):
        out = endpoint_marks(out)
    return od_from_marks(out) if step == "records" else out


_STEP_COLUMNS = {"gaps": [EPOCH, "mask", "duration"],
                 "segments": [EPOCH, "mask", "duration", "new_mask", "new_tms_id", "new_io_type"]}
_STEP_COLUMNS["marks"] = [*_STEP_COLUMNS["segments"], "marker"]


def od_part(taps: DataFrame, step: str = "records", hot: skew.HotKeys | None = None,
            gap_seconds: int = GAP_SECONDS, rows_per_chunk: int = skew.ROWS_PER_CHUNK) -> DataFrame:
    """One step of the cut (``gaps``, ``segments``, ``marks`` or ``records``) for taps
    that are all of the hot card-days ``hot``, or (``hot`` None) of none."""
    if hot is None:
        return _windows(taps, step, gap_seconds)
    chunks = _Chunks(skew.split_hot(taps, hot).hot, skew.cut(taps.sparkSession, hot.rows, rows_per_chunk),
                     gap_seconds, hot.count)
    if step == "records":
        return chunks.od()
    rows = chunks.marks() if step == "marks" else chunks.segments()
    return rows.select(*taps.columns, *_STEP_COLUMNS[step])


def od_records(taps: DataFrame, gap_seconds: int = GAP_SECONDS,
               hot_threshold: int | None = skew.HOT_ROWS_PER_KEY,
               rows_per_chunk: int = skew.ROWS_PER_CHUNK,
               hot_keys: skew.HotKeys | None = None) -> DataFrame:
    """Merged taps -> OD records (13 columns).

    Card-days above ``hot_threshold`` taps are cut in ordered chunks
    (``tapflow.operators.skew``); the rest take the one-exchange window plan.
    Results are identical.  A caller that already knows a superset of the hot
    card-days passes ``hot_keys``; ``hot_threshold=None`` without them means
    no split.
    """
    if hot_keys is None and hot_threshold is not None:
        hot_keys = skew.find_hot_keys(taps, CARD_DAY, hot_threshold)
    split = skew.split_hot(taps, hot_keys)
    cold = _windows(split.cold, "records", gap_seconds)
    if split.hot is None:
        return cold
    cut = skew.cut(taps.sparkSession, split.hot_rows, rows_per_chunk)
    return cold.unionByName(_Chunks(split.hot, cut, gap_seconds, split.hot_keys).od())
