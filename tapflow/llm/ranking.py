"""Ranks over whole tables without a one-task window.

A plain ``row_number() OVER (ORDER BY ...)`` sorts everything in one task, and
one per group puts a hot group in one task.  Here the order key is first cut
into many buckets of near-equal size (the key is uniform by construction); the
window runs per (group, bucket), and a running sum over the small table of
bucket counts gives each bucket's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows per bucket aimed at; a window task holds a few such buckets.
ROWS_PER_BUCKET = 4_000
#: Most rows of the bucket-count table that are broadcast; beyond, it is joined by shuffle.
BROADCAST_ROWS = 200_000


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, -(-rows // per_bucket))


def ranked(df: DataFrame, group: list[str], bucket: Column, order: list[Column], out: str,
           n_groups: int, n_buckets: int, weight: str | None = None) -> DataFrame:
    """``df`` with ``out`` = 0-based rank in its group (or, with ``weight``, the
    sum of that column over the rows before it).

    ``bucket`` must not decrease along ``order`` within a group, and spread its
    rows evenly over ``n_buckets`` values.  Null groups rank as one group.
    """
    keyed = df.withColumn("_bucket", bucket)
    size = F.sum(weight) if weight else F.count(F.lit(1))
    counts = keyed.groupBy(*group, "_bucket").agg(size.alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    local = (F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
             if weight else F.row_number().over(inside) - 1)
    placed = keyed.withColumn("_local", local)
    same = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    if n_groups * n_buckets <= BROADCAST_ROWS:  # bound of the count table
        offsets = F.broadcast(offsets)
    return (placed.join(offsets, same)
            .withColumn(out, (F.col("_offset") + F.col("_local")).cast("long"))
            .drop("_bucket", "_b", "_offset", "_local", *[f"_g{i}" for i in range(len(group))]))
