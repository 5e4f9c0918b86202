"""Hot card-days: split them out and scan them in ordered chunks.

Every ordered computation here (trip numbering, ``lag``, running sums) is a
window partitioned by card-day.  A window partition runs in one task, so one
card-day holding a large share of all rows (a placeholder or null card id)
would put that share into a single task.  The remedy is the usual one for an
ordered scan in Spark:

1. **Detect** hot keys with a map-side-combined count per key.  Only keys
   above ``threshold`` rows are kept; should they be more than 100,000, the
   threshold rises to their mean size, so the key table is bounded by
   construction.  It is checkpointed once and broadcast.
2. **Split** rows into a cold part (plain windows, one exchange) and a hot
   part, which carries a small integer key id ``_kid`` (null-safe match on
   the original key, so a null card id can be hot too).
3. **Chunk** the hot rows with ``repartitionByRange`` on (key, order, tie-break):
   the range partitioner samples the keys, so a hot key is cut into contiguous,
   balanced ranges of its order, one task each.  A task sorts its range and cuts it
   into chunks by row count, so chunks may be far smaller than what a task takes:
   tasks, files, shuffle blocks and the sample that the partitioner takes to the
   driver follow the number of tasks (``Cut``), not that of chunks.  Also
   rows with an equal order key (peers of a RANGE frame) are cut, by the total
   order that the tie-break makes; copies of one row are cut by the task they
   come from.  The ranged rows are written to the
   shared checkpoint folder, then clustered by (key, chunk), sorted and
   checkpointed there, so chunk ids stay stable if an executor is lost.
4. **Carry** between chunks through edge tables (one row per key and chunk:
   first row, last row, totals), each written to the checkpoint folder before
   the next pass reads the rows again.  A scan with ``p`` edge tables reads the
   checkpoint ``p + 1`` times: the windows of every pass read it in place.

A peer group that several chunks hold is put together through the same edge
tables: each chunk reports what its first order key's rows add up to (``heads``),
and ``continued`` gives every chunk the sum over the later chunks that begin with
its last order key.

Residual limit: copies of one whole row that one task reads are never split between
tasks when ranged; a task reads no more rows than a file split holds.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapflow.session import shared_dir

# A card-day above this many rows is processed in chunks.
HOT_ROWS_PER_KEY = 2_000_000
# Target rows per chunk of a hot key; also what a task takes of smaller chunks.
ROWS_PER_CHUNK = 1_000_000
# Chunks smaller than that share at most this many tasks, however many shuffle partitions the
# session has: the range partitioner takes 300 rows of each task's range to the driver.
MAX_SHARED_TASKS = 1_000
# At most this many keys can be hot (beyond, the threshold rises to their mean size),
# and edge tables up to this many rows are broadcast.
MAX_HOT_KEYS = 100_000
MAX_BROADCAST_ROWS = 200_000

KID = "_kid"
CHUNK = "_chunk"


@dataclass
class HotKeys:
    """Keys taking the chunked path: ``ids`` holds the key columns (prefixed
    ``_hk_``) and a stable integer ``_kid``; ``rows`` bounds their row total."""

    ids: DataFrame
    keys: list[str]
    count: int
    rows: int


@dataclass(frozen=True)
class Cut:
    """Hot rows are cut into ``chunks`` chunks by ``tasks`` tasks."""

    chunks: int
    tasks: int


@dataclass
class HotSplit:
    """Result of ``split_hot``: ``hot`` is None when no key is hot."""

    cold: DataFrame
    hot: DataFrame | None
    hot_rows: int
    hot_keys: int = 0


_PREFIX = "_hk_"


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def hot_keys_by(counts: DataFrame, keys: list[str], rows: Column,
                threshold: int) -> HotKeys | None:
    """Hot keys of a table of per-key counts: those with ``rows`` > threshold.

    One aggregate job says whether there are any; only then are the flagged keys
    checkpointed, and their number and row total taken from that.
    """
    flagged = counts.where(rows > threshold)
    if flagged.isEmpty():
        return None
    shared_dir(counts.sparkSession)
    flagged = flagged.select(*[F.col(k).alias(_PREFIX + k) for k in keys], rows.alias("_rows")).checkpoint(eager=True)
    stats = flagged.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("r")).first()
    if stats["n"] > MAX_HOT_KEYS:  # no more than that many keys have more than the mean
        flagged = flagged.where(F.col("_rows") > stats["r"] // MAX_HOT_KEYS)
        stats = flagged.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("r")).first()
    ids = flagged.drop("_rows").withColumn(KID, F.monotonically_increasing_id())
    return HotKeys(ids, list(keys), int(stats["n"]), int(stats["r"]))


def find_hot_keys(df: DataFrame, keys: list[str],
                  threshold: int = HOT_ROWS_PER_KEY) -> HotKeys | None:
    """Keys of ``df`` with more than ``threshold`` rows (map-side-combined count)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return hot_keys_by(counts, keys, F.col("_n"), threshold)


def split_hot(df: DataFrame, hot: HotKeys | None,
              max_broadcast_keys: int = MAX_HOT_KEYS) -> HotSplit:
    """Rows of cold keys, and rows of hot keys tagged with ``_kid``.

    The key match is null-safe, so a null card id can be hot too.  The key
    table is broadcast when its counted size allows; a caller that asked for
    more hot keys gets a shuffle join.
    """
    if hot is None:
        return HotSplit(df, None, 0)
    ids = F.broadcast(hot.ids) if hot.count <= max_broadcast_keys else hot.ids.hint("merge")
    cond = _null_safe(df, ids, hot.keys, _PREFIX)
    tagged = df.join(ids, cond, "inner").drop(*[_PREFIX + k for k in hot.keys])
    cold = df.join(ids, cond, "left_anti")
    return HotSplit(cold, tagged, hot.rows, hot.count)


def chunk_count(hot_rows: int, rows_per_chunk: int = ROWS_PER_CHUNK) -> int:
    """Chunks for ``hot_rows``: as many as keep ``rows_per_chunk``."""
    return max(1, math.ceil(hot_rows / max(1, rows_per_chunk)))


def shared_tasks(spark: SparkSession) -> int:
    """The session's shuffle partitions, at most ``MAX_SHARED_TASKS``."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_SHARED_TASKS)


def cut(spark: SparkSession, hot_rows: int, rows_per_chunk: int = ROWS_PER_CHUNK) -> Cut:
    """Chunks for ``hot_rows``, and tasks for them: the session's shuffle partitions, at most
    ``MAX_SHARED_TASKS``, or more where a task would get over ``ROWS_PER_CHUNK`` rows, but
    not more than chunks."""
    chunks = chunk_count(hot_rows, rows_per_chunk)
    tasks = max(shared_tasks(spark), chunk_count(hot_rows))
    return Cut(chunks, min(chunks, tasks))


def assign_chunks(hot: DataFrame, order: list[str], chunks: int,
                  tie: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Cut hot rows into about ``chunks`` contiguous ranges of (``_kid``, order, tie).

    Each of ``tasks`` tasks (as many as chunks, if not given) sorts a range and cuts it
    every so many rows.  A chunk's number is the place of its first row: the task's
    number above 33 bits, then the row's in the task.

    Rows with an equal (key, order) may fall into neighbouring chunks; ``tie`` is
    what the rows are ordered by among them.  The result is a checkpoint in
    the shared folder that Spark knows to be hash-clustered by (key, chunk) and
    sorted in scan order.  A checkpoint taken under adaptive execution forgets
    its partitioning, so that last short job (read, shuffle, sort, write) runs
    in a session of its own with adaptive execution off; the caller's session
    is not touched.  Edge tables are shuffled in that session, where nothing joins
    small partitions, so their tasks are bounded as those of the rows are.
    """
    spark = hot.sparkSession
    path = f"{shared_dir(spark)}/tapflow-chunks/{uuid.uuid4().hex}"
    tasks = tasks or chunks
    # the task's number is the same when the task runs again, so a chunk is too
    place = [F.col(c).asc() for c in (KID, *order, *(tie or []), "_from")]
    ranged = (hot.withColumn("_from", F.xxhash64(F.spark_partition_id()))
              .repartitionByRange(tasks, *place).sortWithinPartitions(*place)
              .drop("_from").withColumn(CHUNK, F.monotonically_increasing_id()))
    ranged.write.parquet(path)
    try:
        static = spark.newSession()
        static.conf.set("spark.sql.adaptive.enabled", "false")
        static.conf.set("spark.sql.shuffle.partitions", str(max(tasks, shared_tasks(spark))))
        rows = static.read.schema(ranged.schema).parquet(path)
        size = max(1, math.ceil(rows.count() / chunks))  # from the files' footers
        in_task = F.col(CHUNK).bitwiseAND(F.lit((1 << 33) - 1))
        return (rows.withColumn(CHUNK, F.col(CHUNK) - in_task % size).repartition(tasks, KID, CHUNK)
                .sortWithinPartitions(KID, CHUNK, *order, *(tie or []))
                .checkpoint(eager=True))
    finally:  # the checkpoint holds the rows now
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def in_chunk(order: list[str]) -> Window:
    return Window.partitionBy(KID, CHUNK).orderBy(*order)


def across_chunks() -> Window:
    """Window over an edge table: the chunks of a key in order."""
    return Window.partitionBy(KID).orderBy(CHUNK)


def heads(rows: DataFrame, order: list[str], total: list[str]) -> DataFrame:
    """``_head``: the row has the first ``order`` key of its chunk."""
    key = F.struct(*order)
    return rows.withColumn("_head", key.eqNullSafe(F.first(key).over(in_chunk(total))))


def order_key(side: str, order: list[str]) -> Column:
    """The order key of an edge table's ``first`` or ``last`` rows."""
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in order])


def continued(heads_sum: str, order: list[str]) -> Column:
    """For an edge table: the sum of ``heads_sum`` over the later chunks that begin
    with this chunk's last ``order`` key, which holds that key's further rows."""
    first, last = order_key("first", order), order_key("last", order)
    on = Window.partitionBy(KID, first).orderBy(CHUNK).rowsBetween(0, Window.unboundedFollowing)
    after = F.lead(F.struct(first.alias("key"), F.sum(heads_sum).over(on).alias("sum"))).over(across_chunks())
    return F.when(after["key"].eqNullSafe(last), after["sum"]).otherwise(F.lit(0))


def edges(rows: DataFrame, order: list[str], first: list[str], last: list[str],
          totals: list[str] = ()) -> DataFrame:
    """One row per key and chunk: ``first`` and ``last`` (structs of those columns
    of the chunk's first and last row in ``order``) and the sums of ``totals``.

    One pass over the rows, which are clustered by (key, chunk) already."""
    place = F.struct(*order)
    aggs = [F.sum(c).alias(c) for c in totals]
    if first:
        aggs.append(F.min_by(F.struct(*first), place).alias("first"))
    if last:
        aggs.append(F.max_by(F.struct(*last), place).alias("last"))
    return rows.groupBy(KID, CHUNK).agg(*aggs)


def attach(rows: DataFrame, per_chunk: DataFrame,
           max_broadcast_rows: int | None = None) -> DataFrame:
    """Join an edge table onto the rows it was made from.

    The table is written to the checkpoint folder first, so that what reads it
    does not compute it again; it is broadcast when its counted rows allow, and
    joined by (key, chunk) -- the rows' own clustering -- otherwise."""
    shared_dir(rows.sparkSession)
    table = per_chunk.checkpoint(eager=True)
    limit = MAX_BROADCAST_ROWS if max_broadcast_rows is None else max_broadcast_rows
    right = F.broadcast(table) if table.count() <= limit else table.hint("merge")
    return rows.join(right, [KID, CHUNK], "inner")
