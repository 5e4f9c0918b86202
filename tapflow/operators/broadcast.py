"""Broadcast only behind a size check.

``F.broadcast`` ships a whole table to every executor, so it is only safe for
a side whose size is *known* to be small.  ``broadcast_if_small`` counts the
side first (a partial count per task and a sum of the counts).  Beyond the
bound the plain DataFrame is returned and the join becomes a shuffle join,
where adaptive execution splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Station tables hold a few hundred rows; 200k narrow rows stay well under
# the broadcast budget of a default executor.
DEFAULT_MAX_BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when it has at most ``max_rows`` rows."""
    return F.broadcast(df) if df.count() <= max_rows else df
