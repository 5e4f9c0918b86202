"""Connected components by alternating stars (union-find as Spark jobs).

Every round replaces a node's links by links to the smallest neighbour, first
towards the larger neighbours, then towards the smaller ones; at the fixed
point every node is linked to the smallest node of its component alone.  A
round is a handful of partially aggregated minima and joins on node ids; its
links are cut to the shared checkpoint folder.  Nothing reaches the driver but
a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import cut


#: A group of a link table of at most so many rows (pairs of longs) fits any task.
SMALL = 2_000_000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _lowest(df: DataFrame, by: str, of: str, small: bool) -> DataFrame:
    """``df`` with ``m``, the smallest ``of`` of each ``by``: by a window when the
    whole table is small, else by a partially aggregated minimum and a join whose
    hot keys adaptive execution can split."""
    if small:
        return df.withColumn("m", F.min(of).over(Window.partitionBy(by)))
    return df.join(cut(df.groupBy(by).agg(F.min(of).alias("m"))), by)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b), where
    component is the smallest node reachable.  Links may repeat, point either
    way or to themselves."""
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = cut(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(edges)
    while mark[0]:
        small = mark[0] <= SMALL
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        large = _lowest(both, "x", "y", small).withColumn("m", F.least("x", "m")).where(
            "y > x and y <> m").select(F.col("y").alias("u"), F.col("m").alias("v"))
        star = _lowest(large, "u", "v", small).select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        edges = cut(star.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
