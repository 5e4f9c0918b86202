"""Operator 6, sharding: proportional stratified interleaving.

Every source's rows are shuffled by a seeded hash and ranked; row ``r`` of a
source of ``n`` rows gets the fractional rank ``(r + 1/2) / n``.  All rows
sorted by that fraction interleave the sources in proportion, so any run of
consecutive rows holds every source at its share of the corpus; the sorted
order is cut into shards whose row counts differ by one at most.  A source
with fewer rows than shards simply misses some shards.

Scale: both orders are ranked per bucket (``ranking.ranked``): the shuffle
hash and the fraction are uniform, so a source with a third of all rows is
spread over as many buckets as its rows need.  Many small sources share a
fraction (1/2 of all with one row): rows of one fraction are ordered by a hash
of their source, and a fraction with many rows is split by ranges of it.  Texts are reduced to size,
checksum and a 128-bit row key in the scan; ``shard`` never shuffles them, and
``shard_documents`` joins them back by that key (one shuffle of the texts).

Defined cases: null source is a source of its own; null text has size 1 and
checksum 0; empty and very long texts count like any row; repeated rows are
ranked one after the other; ids may be null or repeated; an empty table gives
no rows; extra columns of the input are dropped by ``shard`` and kept by
``shard_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ranking
from .tables import cut, keyed, table, with_rows

SHARDS = 8
SEED = 17


def _split_buckets(part: DataFrame, n: int, per_bucket: int) -> tuple[DataFrame, int]:
    """``part`` with ``_cell``, a bucket that does not decrease along (``_fraction``,
    ``_s``), and the number of its values, about: the fraction cut into ``n``, and
    in overfull buckets each fraction of many rows apart, by ranges of ``_s``."""
    part = part.withColumn("_coarse", F.floor(F.col("_fraction") * n))
    full = part.groupBy("_coarse").agg(F.count(F.lit(1)).alias("_c")).where(
        F.col("_c") > 2 * per_bucket).select("_coarse")
    hot = cut(part.join(full, "_coarse").groupBy("_coarse", "_fraction").agg(F.count(F.lit(1)).alias("_c"))
              .where(F.col("_c") > per_bucket)
              .select("_coarse", "_fraction", F.ceil(F.col("_c") / per_bucket).alias("_k")))
    n_hot, cells = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("_k"), F.lit(0))).first()
    if n_hot == 0:
        return part.withColumn("_cell", F.struct("_coarse")).drop("_coarse"), n
    spots = hot.groupBy("_coarse").agg(F.sort_array(F.collect_list(F.struct("_fraction", "_k"))).alias("_hot"))
    if n_hot <= ranking.BROADCAST_ROWS:
        spots = F.broadcast(spots)
    part = part.join(spots, "_coarse", "left")
    below = F.coalesce(F.size(F.filter("_hot", lambda x: x["_fraction"] < F.col("_fraction"))), F.lit(0))
    k = F.get(F.filter("_hot", lambda x: x["_fraction"] == F.col("_fraction")), F.lit(0))["_k"]
    # between the hot fractions of a bucket, and at each of them
    place = 2 * F.greatest(below, F.lit(0)) + k.isNotNull().cast("int")
    cell = F.coalesce(F.floor(F.col("_s") / F.ceil(F.lit(float(1 << 62)) / k)), F.lit(0))
    return part.withColumn("_cell", F.struct(
        F.col("_coarse").alias("a"), place.alias("b"), cell.alias("c"))).drop("_coarse", "_hot"), n + 2 * n_hot + cells


def _placed(keys: DataFrame, shards: int, seed: int, per_bucket: int) -> DataFrame:
    """``shard`` and ``slot`` for rows (doc_id, source, size, text_crc32, _k1, _k2)."""
    keys = cut(keys.withColumn("_h", F.shiftrightunsigned(
        F.xxhash64(F.lit(seed), "_k1", "_k2"), 2)))
    sources = keys.groupBy("source").agg(F.count(F.lit(1)).alias("_rows"))
    total, n_sources = sources.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.count(F.lit(1))).first()
    n = ranking.buckets_for(total, per_bucket)
    step = -(-(1 << 62) // n)  # width of a bucket of the 62-bit hash
    tie = [F.col("_h"), F.col("doc_id"), F.col("_k1"), F.col("_k2")]
    own = ranking.ranked(keys, ["source"], F.expr(f"_h div {step}"), tie, "_rank", n_sources, n)
    sizes = sources.withColumnRenamed("source", "_source")
    if n_sources <= ranking.BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    part = own.join(sizes, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    part = cut(part.withColumns({
        "_fraction": (2 * F.col("_rank") + 1) / (2 * F.col("_rows")), "_all": F.lit(0),
        "_s": F.shiftrightunsigned(F.xxhash64(F.lit(seed), "source"), 2)}))
    part, cells = _split_buckets(part, n, per_bucket)
    merged = ranking.ranked(part, ["_all"], F.col("_cell"),
                            [F.col("_fraction"), F.col("_s"), F.col("source"), *tie], "_place", 1, cells)
    # the first (total mod shards) shards hold one row more
    low, more = divmod(total, shards)
    edge = more * (low + 1)
    place = F.col("_place")
    early = place < edge
    shard = F.when(early, F.floor(place / (low + 1))).otherwise(
        more + F.floor((place - edge) / max(low, 1)))
    slot = F.when(early, place % (low + 1)).otherwise((place - edge) % max(low, 1))
    return merged.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")}).drop(
        "_h", "_rank", "_rows", "_fraction", "_all", "_s", "_cell", "_place")


def _keys(docs: DataFrame) -> DataFrame:
    text = F.col("_row.text")
    return keyed(docs).select(
        F.col("_row.doc_id").cast("long").alias("doc_id"), F.col("_row.source").alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        "_k1", "_k2")


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
          per_bucket: int = ranking.ROWS_PER_BUCKET) -> DataFrame:
    """One row per document: doc_id, source, size (UTF-8 bytes + 1), text_crc32,
    shard, slot (0-based place in the shard, gapless)."""
    return _placed(_keys(docs), shards, seed, per_bucket).drop("_k1", "_k2")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
                    per_bucket: int = ranking.ROWS_PER_BUCKET) -> DataFrame:
    """Every document row with all its columns, plus ``shard`` and ``slot``
    (columns of the input with those names are replaced)."""
    docs = docs.drop("shard", "slot")
    placed = _placed(_keys(docs), shards, seed, per_bucket).select("_k1", "_k2", "shard", "slot")
    return with_rows(placed, docs).select("_row.*", "shard", "slot")


def op6_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
