"""Operator 10, mixing sources to target weights by fixed-length blocks.

1. Every source's documents are laid end to end in a seeded order and the
   stream of words is cut into blocks of ``block_words`` words.
2. A source of weight w gets its share of ``share`` times all words, at most
   ``cap`` times its own size; the excess goes to the others by weight.  That
   target is a whole number of block slots.
3. For each output shard, source counts are drawn from a multinomial over the
   slots still to be dealt (so all shards together meet the targets exactly).
4. Slot ``j`` of a source takes block ``p(j mod n)``, where ``p`` is a
   pseudorandom permutation of the source's ``n`` blocks, another one in each
   round ``j div n``: no block comes again before all others came as often.
5. Slots join blocks by (source, block index).

``taken`` of a document counts its words in the mix, repeats included; as no
block is drawn more than ``cap`` times, no document exceeds ``cap`` times its
size.  Each source's taken words differ from its target by less than two
blocks.

Scale: word offsets come from bucketed prefix sums (``ranking.ranked``), so a
source with a third of all rows is spread over many tasks; a document is
exploded only into the blocks it touches; the slot table is generated in
parallel from (shard, source, count) rows, in chunks.  Up to ``MAX_SOURCES``
sources (counted) are planned on the driver.  Beyond, a source table stays on
Spark: it is numbered by range buckets, the excess is reshared by one aggregate
a round, and it meets the documents by shuffle.  Slots are dealt to the shards in
two steps on both ways, so both give the same mix: groups of ``SOURCE_GROUP``
sources draw from the group totals (at most ``MAX_GROUPS`` rows, on the driver),
and each group's sources from the group's counts, in a task of its own.

Defined cases: null source is one more source, last in order; null and empty
texts have size 0 and nothing taken; a long text covers many blocks; repeated
rows are laid one after the other; an empty table gives no rows; other
columns are ignored by ``mix`` and kept by ``mix_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ranking
from .tables import cut, key_groups, keyed, table, with_rows
from .textkernel import mix64

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 128
OUT_SHARDS = 8
SEED = 29
#: Sources that are planned on the driver at most, sources that draw together, and groups of them.
MAX_SOURCES, SOURCE_GROUP, MAX_GROUPS = 10_000, 1_000, 10_000
#: Slots that one row of the slot plan expands to.
SLOT_CHUNK = 20_000


def targets(sizes: list[int], weights: list[float], share: float = SHARE,
            cap: float = CAP) -> list[float]:
    """Words wanted of each source: ``share`` of all words by weight, none above
    ``cap`` times its size, the excess reshared by weight among the others."""
    want = [0.0] * len(sizes)
    open_ = [i for i, n in enumerate(sizes) if n > 0]
    left = share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                want[i] = left * weights[i] / total
            break
        for i in over:
            want[i] = float(cap * sizes[i])
        left -= sum(want[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return want


def shard_counts(slots: list[int], out_shards: int, seed: int, needs: list[int] | None = None) -> np.ndarray:
    """(out_shards, sources) slot counts: each shard's row is a multinomial draw
    over the slots that are left, cut at what is left; column sums equal ``slots``.
    ``needs``: the slots of each shard; else all shards get about as many."""
    rng = np.random.default_rng(seed)
    left = np.array(slots, dtype=np.int64)
    out = np.zeros((out_shards, len(slots)), dtype=np.int64)
    for s in range(out_shards):
        need = int(left.sum()) // (out_shards - s) if needs is None else int(needs[s])
        while need > 0:
            draw = np.minimum(rng.multinomial(need, left / left.sum()), left)
            out[s] += draw
            left -= draw
            need -= int(draw.sum())
    return out


def group_size(sources: int) -> int:
    return max(SOURCE_GROUP, -(-sources // MAX_GROUPS))


def group_needs(totals: list[int], out_shards: int, seed: int) -> list[list[int]]:
    """Slots of every shard (inner) that each group of sources (outer) fills."""
    if len(totals) == 1:
        left, out = totals[0], []
        for s in range(out_shards):
            out.append(left // (out_shards - s))
            left -= out[-1]
        return [out]
    return shard_counts(totals, out_shards, seed).T.tolist()


def plan_rows(src: list[int], slots: list[int], blocks: list[int], needs: list[int], seed: int) -> list[tuple]:
    """Rows (src, low, k, n, out_shard) of one group of sources: k slots from ``low`` on."""
    out, done = [], [0] * len(src)
    for s, counts in enumerate(shard_counts(slots, len(needs), seed, needs) if sum(slots) else []):
        for i, k in enumerate(counts):
            if k:
                out.append((src[i], done[i], int(k), blocks[i], s))
                done[i] += int(k)
    return out


_PLAN = "src int, low long, k long, n long, out_shard int"


def _group_plans(needs, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in key_groups(batches, 1):
            g = t.column(0)[0].as_py()
            t = t.sort_by("src")
            rows = plan_rows(*(t.column(i).to_pylist() for i in (1, 2, 3)), needs.value[g], seed + g)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["src", "low", "k", "n", "out_shard"])
    return run


def _numbered(sources: DataFrame, n: int) -> DataFrame:
    """``sources`` with ``src``: the place of each by code point, null last."""
    none, parts = F.col("source").isNull(), ranking.buckets_for(n)
    ranged = cut(sources.repartitionByRange(parts, none, "source").withColumn("_part", F.spark_partition_id()))
    return cut(ranking.ranked(ranged, [], F.col("_part"), [none, F.col("source")], "src", 1, parts).drop("_part"))


def source_table(sources: DataFrame, n: int, weights, share: float, cap: float, block_words: int) -> DataFrame:
    """``targets`` and slots of any number of sources (source, size), on Spark: rows
    (src, source, size, target, blocks, slots)."""
    rows = _numbered(sources, n)
    every = F.array(*[F.lit(float(w)) for w in weights])
    rows = rows.withColumn("w", F.get(every, (F.col("src") % len(weights)).cast("int")))
    some = F.col("size") > 0
    total, words = rows.agg(F.coalesce(F.sum(F.when(some, F.col("w"))), F.lit(0.0)),
                            F.coalesce(F.sum("size"), F.lit(0))).first()
    left, most, full = share * words, (cap * F.col("size")).cast("double"), F.lit(False)
    while total:
        # one aggregate a round; a source that is full stays so, as shares only rise
        over = some & ~full & (F.lit(left) * F.col("w") / F.lit(total) > most)
        k, gone, their = rows.where(over).agg(F.count(F.lit(1)), F.sum(most), F.sum("w")).first()
        if not k:
            break
        left, total, full = left - gone, total - their, full | over
    want = F.when(~some, 0.0).when(full, most).otherwise(
        F.lit(left) * F.col("w") / F.lit(total or 1.0))
    rows = rows.select("src", "source", "size", want.alias("target"), F.ceil(F.col("size") / block_words).alias("blocks"))
    slots = F.least((cap * F.col("blocks")).cast("long"), F.rint(F.col("target") * F.col("blocks") / F.col("size")).cast("long"))
    return cut(rows.withColumn("slots", F.when(some, slots).otherwise(F.lit(0)).cast("long")))


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A keyed pseudorandom permutation of ``range(n)`` at ``index``, elementwise:
    a Feistel network over the next even power of two, walked until inside."""
    bits = np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64)
    half = np.maximum((bits + np.uint64(1)) // np.uint64(2), np.uint64(1))
    mask = (np.uint64(1) << half) - np.uint64(1)
    x = index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = x[todo] >> h, x[todo] & m
        for r in range(rounds):
            left, right = right, left ^ (mix64(right + k * np.uint64(0x9E3779B97F4A7C15)
                                               + np.uint64(r)) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo].astype(np.uint64)]
    return x.astype(np.int64)


def _slot_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        src, slot, n, out = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if len(src):
            turn = slot // n
            key = mix64((src.astype(np.uint64) << np.uint64(20)) + turn.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out), pa.array(slot), pa.array(src), pa.array(permute(slot % n, n, key))],
                names=["out_shard", "slot", "src", "block"])


class Plan:
    """Sources, targets and the two block tables of one mix."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP,
                 block_words: int = BLOCK_WORDS, out_shards: int = OUT_SHARDS, seed: int = SEED,
                 per_bucket: int = ranking.ROWS_PER_BUCKET):
        spark = docs.sparkSession
        words = F.regexp_extract_all(F.coalesce("_row.text", F.lit("")), F.lit(WORD), F.lit(0))
        keys = keyed(docs).select(
            F.col("_row.doc_id").cast("long").alias("doc_id"),
            F.col("_row.source").cast("string").alias("source"),
            F.size(words).cast("long").alias("size"), "_k1", "_k2")
        keys = cut(keys.withColumn("_h", F.shiftrightunsigned(
            F.xxhash64(F.lit(seed), "_k1", "_k2"), 2)))
        sources = cut(keys.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")))
        n_sources, n_rows = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
        make = self._small if n_sources <= MAX_SOURCES else self._large
        named, ranges, n_slots = make(sources, n_sources, weights, share, cap, block_words, out_shards, seed)
        keys = keys.join(named, F.col("source").eqNullSafe(F.col("_source")))
        n = ranking.buckets_for(n_rows, per_bucket)
        step = -(-(1 << 62) // n)
        self.docs = ranking.ranked(
            keys, ["src"], F.expr(f"_h div {step}"),
            [F.col("_h"), F.col("doc_id"), F.col("_k1"), F.col("_k2")], "start", n_sources, n,
            weight="size").drop("_h", "_source")
        first, last = F.col("start"), F.col("start") + F.col("size") - 1
        block = F.col("block") * block_words
        self.pieces = (
            self.docs.where("size > 0")
            .withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"),
                                                      F.expr(f"(start + size - 1) div {block_words}"))))
            .withColumn("_from", F.greatest(first, block) - first)
            .withColumn("_n", F.least(last + 1, block + block_words) - first - F.col("_from")))
        chunk = (ranges.withColumn("_c", F.explode(F.expr(f"sequence(0, (k - 1) div {SLOT_CHUNK})")))
                 .repartition(max(1, n_slots // (5 * SLOT_CHUNK)), "src", "low", "_c"))
        low = F.col("low") + F.col("_c") * SLOT_CHUNK
        slot = F.explode(F.sequence(low, F.least(low + SLOT_CHUNK, F.col("low") + F.col("k")) - 1))
        self.slots = chunk.select(F.col("src").cast("long"), slot.alias("slot"), "n",
                                  F.col("out_shard").cast("long")).mapInArrow(
            _slot_blocks, "out_shard long, slot long, src long, block long")

    @staticmethod
    def _small(sources, n, weights, share, cap, block_words, out_shards, seed):
        """The plan of a counted number of sources, on the driver."""
        spark = sources.sparkSession
        rows = sources.collect()
        rows.sort(key=lambda r: (r[0] is None, r[0] or ""))
        sizes = [int(r[1]) for r in rows]
        want = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share, cap)
        blocks = [-(-n // block_words) for n in sizes]
        slots = [min(cap * b, round(t * b / n)) if n else 0 for t, b, n in zip(want, blocks, sizes)]
        step = group_size(n)
        groups = [range(i, min(i + step, n)) for i in range(0, n, step)]
        needs = group_needs([sum(slots[i] for i in g) for g in groups], out_shards, seed) if groups else []
        plan = [row for at, g in enumerate(groups) for row in plan_rows(
            list(g), [slots[i] for i in g], [blocks[i] for i in g], needs[at], seed + at)]
        named = spark.createDataFrame([(i, r[0], n, t) for i, (r, n, t) in enumerate(zip(rows, sizes, want))],
                                      "src int, _source string, source_size long, target double")
        # one row per source, as many as were just collected
        return F.broadcast(named), spark.createDataFrame(plan, _PLAN), sum(slots)

    @staticmethod
    def _large(sources, n, weights, share, cap, block_words, out_shards, seed):
        """The same plan with the source table on Spark; only group totals are collected."""
        rows = source_table(sources.select("source", "size"), n, weights, share, cap, block_words)
        rows = rows.withColumn("grp", F.expr(f"src div {group_size(n)}"))
        totals = [r[0] for r in rows.groupBy("grp").agg(F.sum("slots").alias("t"), F.col("grp").alias("g")).orderBy("g").select("t").collect()]
        needs = sources.sparkSession.sparkContext.broadcast(group_needs(totals, out_shards, seed))
        ranges = (rows.where("slots > 0").select("grp", "src", "slots", "blocks").repartition("grp").sortWithinPartitions("grp", "src")
                  .mapInArrow(_group_plans(needs, seed), _PLAN))
        named = rows.select(F.col("src").cast("int").alias("src"), F.col("source").alias("_source"),
                            F.col("size").alias("source_size"), "target")
        return named.hint("merge"), cut(ranges), sum(totals)

    def drawn(self) -> DataFrame:
        """Pieces of documents with ``times`` > 0, the number of slots that hold their block."""
        times = self.slots.groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
        pieces = self.pieces.withColumn("src", F.col("src").cast("long"))
        # the slots' size is unknown to the planner, which takes them for a small table
        return pieces.join(times.hint("merge"), ["src", "block"])


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target (its
    source's words wanted), taken (words of it in the mix, repeats counted)."""
    plan = Plan(docs, **options)
    row = ["doc_id", "source", "size", "source_size", "target"]
    # a document with words is the only one at its place in its source
    got = plan.drawn().select(*row, "src", "start", (F.col("_n") * F.col("times")).alias("_w"))
    every = plan.docs.select(*row, F.col("src").cast("long"), "start", F.lit(0).cast("long").alias("_w"))
    some = every.where("size > 0").unionByName(got).groupBy(*row, "src", "start").agg(
        F.sum("_w").alias("taken")).drop("src", "start")
    none = every.where("size = 0").select(*row, F.col("_w").alias("taken"))
    return some.unionByName(none)


def mix_blocks(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per slot and document piece, with out_shard,
    slot, source, block, doc_id, first_word, n_words (the piece's words)."""
    plan = Plan(docs, **options)
    pieces = plan.pieces.withColumn("src", F.col("src").cast("long"))
    return pieces.join(plan.slots.hint("merge"), ["src", "block"]).select(
        "out_shard", "slot", "source", "block", "doc_id", F.col("_from").alias("first_word"),
        F.col("_n").alias("n_words"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: copy c of a document holds the words whose block
    was drawn at least c times; a copy with all words keeps the text as it is,
    another has its taken words joined by one space.  ``n_chars``, if present,
    is recounted for texts that changed; all other columns are kept."""
    plan = Plan(docs, **options)
    piece = F.struct(F.col("_from").alias("f"), F.col("_n").alias("n"), F.col("times").alias("t"))
    taken = plan.drawn().groupBy("_k1", "_k2", "src", "start", "size").agg(
        F.sort_array(F.collect_list(piece)).alias("_pieces"))
    copies = taken.withColumn("_c", F.explode(F.sequence(
        F.lit(1).cast("long"), F.array_max(F.transform("_pieces", lambda p: p["t"])))))
    copies = copies.withColumn("_pieces", F.filter("_pieces", lambda p: p["t"] >= F.col("_c")))
    whole = F.aggregate("_pieces", F.lit(0).cast("long"), lambda a, p: a + p["n"]) == F.col("size")
    full = with_rows(copies.drop("src", "start"), docs).withColumn("_whole", whole)
    words = F.regexp_extract_all("_row.text", F.lit(WORD), F.lit(0))
    full = full.withColumn("_words", F.when(~F.col("_whole"), words))
    part = F.expr("array_join(flatten(transform(_pieces, p -> "
                  "slice(_words, cast(p.f as int) + 1, cast(p.n as int)))), ' ')")
    full = full.withColumn("_text", F.when(F.col("_whole"), F.col("_row.text")).otherwise(part))
    changed = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_whole"), F.col("_row.n_chars")).otherwise(F.length("_text")).cast(
            docs.schema["n_chars"].dataType)
    return full.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def op10_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")
