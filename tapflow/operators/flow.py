"""Passenger flow (X11) and its preview.

The flow counts OD rows (not distinct cards) per day, OD pair, direction and
station.  The count is aggregated map-side first, so a hot OD pair never
reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapflow.sources.schemas import FLOW_KEY

# Fixed value: the order of the flow table.
FLOW_ORDER = ["trade_date", "od_desc", "od_type"]
# Fixed value: the preview length of the flow table.
PREVIEW_ROWS = 20


def passenger_flow(od: DataFrame, sort: bool = True) -> DataFrame:
    """X11: rows per (date, OD pair, type, station, coordinates)."""
    flow = (od.select(*FLOW_KEY)
            .groupBy(*FLOW_KEY)
            .agg(F.count(F.lit(1)).alias("passenger_flow")))
    return flow.orderBy(*FLOW_ORDER) if sort else flow


def preview(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows under a total order (a top-k: one global sort + limit)."""
    return df.orderBy(*order).limit(n)


def flow_preview(flow: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` flow rows; the full flow key makes it deterministic."""
    return preview(flow, FLOW_KEY, n)
