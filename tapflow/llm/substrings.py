"""Operator 5, substring dedup with an FM-index per shard.

A window is ``WINDOW`` consecutive words of one document; words covered by a
window that also starts in a document with a smaller id are removed.

1. Documents with one word sequence are one class; its smallest id stands for
   it.  A class with copies is cut into pieces of ``PIECE`` windows.
2. Candidates: each window's minimizer (smallest hash of its ``KMER``-word
   runs) is dealt out by hash with its class; a minimizer seen in one class
   only cannot lie in a repeated window.  Minimizers that a task itself sees in
   several classes are settled there and send two rows at most, so a passage
   that a third of all documents hold is never gathered in one task.
3. Segments: consecutive candidate windows with one minimizer.  Equal segments
   are one, with the smallest and the largest id that has it (combined before
   the shuffle).
   A minimizer of more than ``HOT`` classes is split: its windows are single
   segments, sharded by their own hash.
4. Per shard of segments (and of pieces) a compressed FM-index (``fmindex``) is
   built, and they are streamed through it: matching statistics by backward
   search over the wavelet matrix give the windows that stand in an earlier
   document.  A segment is asked for its first owner and, where it has a later
   one, once more for the last: what the index reports then holds for every
   later owner.  A class's copies go where the index reports all its windows.
5. The reported windows return to the documents, whose words are cut there.
   Equality of words by hash only groups: nothing goes that no index reported.

Scale: texts are shuffled twice (for candidates and for the cut); what else
moves are 12 bytes per minimizer (48 bits of its hash, which may only make a
candidate too many, and 48 of its class's) and the candidate segments.  Shards and
buckets have bounded sizes, as their number grows with the words.  Segments,
minimizers and classes with very many owners meet them by broadcast: those
above one in ``HOT_KEYS`` of all rows are fewer than ``HOT_KEYS`` by count.

Defined cases: null and empty texts have no words; texts under ``WINDOW``
words keep all; very long texts are read whole; rows with one id do not count
as earlier than each other; a null id is earlier than none and later than
none (its words stay); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fmindex import FMIndex, repeated_windows
from .tables import cut, key_groups, table, written
from .textkernel import Words, chunks, minimizers, mix64, runs_of, sequence_hashes

WINDOW = 13
KMER = 5
#: Classes from which on a minimizer is split; minimizers per bucket, and words
#: per shard, aimed at; minimizers that a task settles at once.
HOT, PER_BUCKET, PER_SHARD, AT_ONCE = 2_000, 400_000, 250_000, 1_500_000
#: Windows per piece of a class with copies; hot keys broadcast at most.
PIECE, HOT_KEYS = 128, 10_000


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (doc_id, n_words, h1, h2)."""
    for b in batches:
        for c in chunks(b):
            words = Words(c.column(1))
            h1, h2 = sequence_hashes(words, words.hashes())
            yield pa.RecordBatch.from_arrays(
                [c.column(0), pa.array(words.counts.astype(np.int64)), pa.array(h1), pa.array(h2)],
                names=["doc_id", "n_words", "h1", "h2"])


def _pack(x: np.ndarray) -> bytes:
    """The upper 48 bits of 64-bit values, 6 bytes each."""
    x = x.view(np.uint64) >> np.uint64(16)
    return (x & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (x >> np.uint64(32)).astype("<u2").tobytes()


def _unpack(parts: list[bytes]) -> np.ndarray:
    out = []
    for raw in parts:
        n = len(raw) // 6
        low = np.frombuffer(raw, "<u4", n).astype(np.uint64)
        out.append(low | (np.frombuffer(raw, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32)))
    return np.concatenate(out)


def _runs(value: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (value, of) pairs sorted by value, and whether the value has several ``of``."""
    order = np.lexsort((of, value))
    value, of = value[order], of[order]
    if len(value):
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
        value, of = value[new], of[new]
    same = np.zeros(len(value), dtype=bool)
    if len(value) > 1:
        pair = value[1:] == value[:-1]
        same[1:] |= pair
        same[:-1] |= pair
    return value, of, same


def _deal(buckets: int):
    """(doc_id, text) -> (bucket, minimizers, classes): bucket >= 0 gathers what
    other tasks must see, bucket < 0 passes on what is settled here."""
    def flush(value: list[np.ndarray], of: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        v, c, several = _runs(np.concatenate(value), np.concatenate(of))
        edge = np.ones(len(v), dtype=bool)  # first or last class of its minimizer
        if len(v) > 2:
            edge[1:-1] = (v[1:-1] != v[:-2]) | (v[1:-1] != v[2:])
        bucket = ((v >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # ascending with v
        rows = [], [], []

        def put(key: int, mz: np.ndarray, cl: np.ndarray) -> None:
            rows[0].append(key)
            rows[1].append(_pack(mz))
            rows[2].append(_pack(cl))

        sv, sc, sb = v[edge], c[edge], bucket[edge]
        cuts = np.flatnonzero(np.diff(sb)) + 1
        for mz, cl, bk in zip(np.split(sv, cuts), np.split(sc, cuts), np.split(sb, cuts)):
            if len(mz):
                put(int(bk[0]), mz, cl)
        inner = several & ~edge
        for low in range(0, int(inner.sum()), 50_000):
            mz, cl = v[inner][low: low + 50_000], c[inner][low: low + 50_000]
            put(-1 - int(mix64(mz[:1] ^ cl[:1].view(np.uint64))[0] % np.uint64(1 << 30)), mz, cl)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())],
            names=["bucket", "mz", "of"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, of, n = [], [], 0
        for b in batches:
            for c in chunks(b):
                words = Words(c.column(1))
                h = words.hashes()
                own, _ = sequence_hashes(words, h)
                at, best, where = minimizers(words, h, WINDOW, KMER)
                if not len(at):
                    continue
                new = np.ones(len(at), dtype=bool)
                new[1:] = where[1:] != where[:-1]
                value.append(best[new])
                of.append(own[words.row[at[new]]])
                n += int(new.sum())
                if n >= AT_ONCE:
                    yield from flush(value, of)
                    value, of, n = [], [], 0
        if value:
            yield from flush(value, of)
    return deal


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket -> (class, mz), 48 bits each, of the minimizers seen in
    several classes."""
    for group in key_groups(batches, 1):
        mz, of = _unpack(group.column(1).to_pylist()), _unpack(group.column(2).to_pylist())
        if group.column(0)[0].as_py() >= 0:
            mz, of, several = _runs(mz, of)
            mz, of = mz[several], of[several]
        for low in range(0, len(mz), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[low: low + 50_000].astype(np.int64)) for x in (of, mz)],
                names=["of", "mz"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, h1, marks of (mz, hot), last) -> candidate segments, and the
    pieces of a text that has copies up to the id ``last``."""
    for b in batches:
        for c in chunks(b):
            words = Words(c.column(1))
            h = words.hashes()
            own, second = sequence_hashes(words, h)
            run, _ = runs_of(words, h, WINDOW)
            ids, last = c.column(0), c.column(4).to_numpy()
            mine = own == c.column(2).to_numpy()
            raw = words.buf.tobytes()

            def rows(shard, s1, row, start, size, last, whole):
                """Spans of ``size`` windows from the word ``start`` of the batch on."""
                low, high = words.starts[start], words.ends[start + size + WINDOW - 2]
                return pa.RecordBatch.from_arrays(
                    [pa.array(shard.view(np.int64)), pa.array(s1.view(np.int64)), ids.take(pa.array(row)),
                     pa.array(last), pa.array(own[row]), pa.array((start - words.first[row]).astype(np.int64)),
                     pa.array(np.full(len(row), whole)),
                     pa.array([raw[x:y] for x, y in zip(low.tolist(), high.tolist())], pa.binary())],
                    names=["shard", "s1", "doc_id", "last", "h1", "start", "whole", "words"])

            copied = np.flatnonzero(mine & (last > ids.to_numpy()))
            if len(copied):
                windows = np.diff(words.first)[copied] - WINDOW + 1
                pieces = -(-windows // PIECE)
                row = np.repeat(copied, pieces)
                k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                size = np.minimum(PIECE, np.repeat(windows, pieces) - k * PIECE)
                salt = mix64(k.astype(np.uint64) + np.uint64(1))
                yield rows(second.view(np.uint64)[row] ^ salt, own.view(np.uint64)[row] ^ salt, row,
                           words.first[row] + k * PIECE, size, last[row], True)
            at, best, where = minimizers(words, h, WINDOW, KMER)
            marks = c.column(3)
            flat = marks.flatten()
            of = np.repeat(np.arange(c.num_rows), marks.value_lengths().to_numpy())
            salt = mix64(np.arange(c.num_rows, dtype=np.uint64) + np.uint64(1))
            known = flat.field("mz").to_numpy().view(np.uint64) ^ salt[of]
            hot = flat.field("hot").to_numpy(zero_copy_only=False).astype(bool)
            row = words.row[at]
            order = np.argsort(known)
            known, hot = known[order], hot[order]
            key = (best >> np.uint64(16)) ^ salt[row]
            place = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            candidate = (known[place] == key) & mine[row] if len(known) else np.zeros(len(at), bool)
            split = hot[place] & candidate if len(known) else candidate
            at, best, where, split = at[candidate], best[candidate], where[candidate], split[candidate]
            if not len(at):
                continue
            new = np.ones(len(at), dtype=bool)
            new[1:] = (where[1:] != where[:-1]) | (at[1:] != at[:-1] + 1) | split[1:]
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(at)))  # windows per segment
            start = at[first]
            row = words.row[start]
            # a segment is known by its words: a hash of their running hashes
            total = np.zeros(len(h) + 1, dtype=np.uint64)
            np.cumsum(mix64(run + np.uint64(1)), out=total[1:])
            s1 = mix64(run[start] ^ mix64(total[start + size] - total[start]) + size.astype(np.uint64))
            yield rows(np.where(split[first], run[start], best[first]), s1, row, start, size,
                       ids.to_numpy()[row], False)


def _indexing(report):
    """Distinct segments and pieces of one shard -> which windows of a segment
    (bits from the first on) ``report`` finds in an earlier document, for its
    first owner and for later ones (0 without any); of a piece, whether all."""
    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, 1):
            words = Words(group.column("words").combine_chunks())
            h = words.hashes()
            doc, last = group.column("first").to_numpy(), group.column("last").to_numpy()
            whole = group.column("whole").to_numpy().astype(bool)
            index = FMIndex(h, words.first, doc)
            sizes = np.diff(words.first)

            def ask(rows: np.ndarray, as_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """(row, place) of the reported windows of some rows."""
                bounds = np.append(0, np.cumsum(sizes[rows]))
                of = np.repeat(np.arange(len(rows)), sizes[rows])
                place = np.arange(bounds[-1]) - bounds[of]
                hit = report(index, h[words.first[rows][of] + place], bounds, as_doc[rows], WINDOW)
                return rows[of[hit]], place[hit]

            bits, later = np.zeros(len(doc), dtype=np.int64), np.zeros(len(doc), dtype=np.int64)
            row, place = ask(np.flatnonzero(~whole), doc)
            np.add.at(bits, row, np.int64(1) << place)
            row, place = ask(np.flatnonzero(~whole & (last > doc)), last)
            np.add.at(later, row, np.int64(1) << place)
            row, _ = ask(np.flatnonzero(whole), last)
            later[whole] = (np.bincount(row, minlength=len(doc)) == sizes - WINDOW + 1)[whole]
            yield pa.RecordBatch.from_arrays(
                [*(group.column(k).combine_chunks() for k in ("key", "s1", "first", "n")),
                 pa.array(bits), pa.array(later)], names=["shard", "s1", "first", "n", "bits", "later"])
    return indexed


def _meet(rows: DataFrame, keys: DataFrame, on: list[str], hot: int, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keys``, whose column ``n`` counts each key's rows; ``total``
    is no less than its sum, so that the keys above the bound, which are broadcast,
    are fewer than HOT_KEYS and no task gathers the rows of one."""
    often = F.col("n") > max(hot, total // HOT_KEYS)
    top = F.broadcast(keys.where(often).drop("n"))
    return rows.join(top, on).unionByName(
        rows.join(top.select(*on), on, "left_anti").join(keys.where(~often).drop("n"), on, how))


def _cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, marks of (h1, start, bits)) -> the words that stay; start
    -1 says that the whole text is a copy."""
    for b in batches:
        for c in chunks(b):
            words = Words(c.column(1))
            own, _ = sequence_hashes(words, words.hashes())
            marks = c.column(2)
            flat = marks.flatten()
            row = np.repeat(np.arange(c.num_rows), marks.value_lengths().fill_null(0).to_numpy())
            h1, start, bits = (flat.field(k).to_numpy() for k in ("h1", "start", "bits"))
            mine = h1 == own[row]
            row, start, bits = row[mine], start[mine], bits[mine]
            cover = np.zeros(len(words.starts) + 1, dtype=np.int64)
            whole = row[start < 0]
            np.add.at(cover, words.first[whole], 1)
            np.add.at(cover, words.first[whole + 1], -1)
            for j in range(WINDOW - KMER + 1):
                on = (start >= 0) & (bits >> j & 1 == 1)
                at = words.first[row[on]] + start[on] + j
                np.add.at(cover, at, 1)
                np.add.at(cover, at + WINDOW, -1)
            gone = np.cumsum(cover)[:-1] > 0
            lost = np.concatenate([[0], np.cumsum(gone)])
            removed = lost[words.first[1:]] - lost[words.first[:-1]]
            raw, kept = words.buf.tobytes(), []
            for i in range(c.num_rows):
                if not removed[i]:
                    kept.append(b" ".join(raw[words.offs[i]: words.offs[i + 1]].split()))
                    continue
                stay = np.flatnonzero(~gone[words.first[i]: words.first[i + 1]]) + words.first[i]
                kept.append(b" ".join([raw[x:y] for x, y in zip(words.starts[stay].tolist(),
                                                                 words.ends[stay].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [c.column(0), pa.array(words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame, hot: int = HOT, report=repeated_windows) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words that
    stay, joined by one space).  ``report`` searches a shard's index."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = cut(docs.where("doc_id is not null").mapInArrow(
        _named, "doc_id long, n_words long, h1 long, h2 long").where(f"n_words >= {WINDOW}"))
    classes = cut(named.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.first("n_words").alias("n_words"),
        F.count(F.lit(1)).alias("n")))
    several = F.col("last") > F.col("rep")
    total, twice, rows = classes.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum(F.when(several, F.col("n_words"))), F.lit(0)),
        F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(1, total // (4 * PER_BUCKET))  # about two minimizers for nine words
    dealt = docs.where("doc_id is not null").mapInArrow(_deal(buckets), "bucket long, mz binary, of binary")
    shared = written(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _shared, "of long, mz long").distinct())
    often = cut(shared.groupBy("mz").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select(
        "mz", "n", F.lit(True).alias("hot")))
    candidates = _meet(shared, often, ["mz"], hot, shared.count(), "left").groupBy("of").agg(
        F.collect_list(F.struct("mz", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("marks"))
    marks = (classes.withColumn("of", F.shiftrightunsigned("h1", 16)).join(candidates, "of", "left")
             .where(several | F.col("marks").isNotNull())
             .select(F.col("rep").alias("doc_id"), "h1", "last", F.coalesce(
                 "marks", F.array().cast("array<struct<mz:bigint,hot:boolean>>")).alias("marks")))
    segments = written(docs.join(marks, "doc_id").select("doc_id", "text", "h1", "marks", "last").mapInArrow(
        _segments, "shard long, s1 long, doc_id long, last long, h1 long, start long, whole boolean, words binary"))
    distinct = segments.groupBy("shard", "s1", "whole").agg(
        F.min(F.struct("doc_id", "words")).alias("_m"), F.max("last").alias("last"), F.count(F.lit(1)).alias("n"))
    shards, apart = max(1, total // PER_SHARD), max(1, twice // PER_SHARD)
    key = F.xxhash64("shard")
    hits = written(distinct.select(
        F.when(F.col("whole"), F.pmod(key, F.lit(apart)) + shards).otherwise(F.pmod(key, F.lit(shards))).alias("part"),
        F.col("shard").alias("key"), "s1", F.col("_m.doc_id").alias("first"), "last", "n", "whole",
        F.col("_m.words").alias("words")).repartition("part").sortWithinPartitions("part").mapInArrow(
            _indexing(report), "shard long, s1 long, first long, n long, bits long, later long"))
    owners = segments.select("shard", "s1", "doc_id", "h1", "start", "whole")
    found = _meet(owners.where("not whole"), hits.where("bits <> 0 or later <> 0"), ["shard", "s1"], hot,
                  owners.count()).select(
        "doc_id", "h1", "start", F.when(F.col("doc_id") > F.col("first"), F.col("later"))
        .otherwise(F.col("bits")).alias("bits")).where("bits <> 0")
    confirmed = (owners.where("whole").join(hits.select("shard", "s1", "later"), ["shard", "s1"])
                 .groupBy("h1", F.col("doc_id").alias("rep")).agg(F.min("later").alias("all")).where("all = 1"))
    gone = cut(classes.where(several).join(confirmed, ["h1", "rep"]).select("h1", "h2", "rep", "n"))
    copies = _meet(named.select("doc_id", "h1", "h2"), gone, ["h1", "h2"], hot, rows).where("doc_id > rep").select(
        "doc_id", "h1", F.lit(-1).cast("long").alias("start"), F.lit(0).cast("long").alias("bits"))
    cuts = found.union(copies).distinct().groupBy(F.col("doc_id").alias("_id")).agg(
        F.collect_list(F.struct("h1", "start", "bits")).alias("marks"))
    return docs.join(cuts, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "marks").mapInArrow(
        _cut_words, "doc_id long, n_words long, n_removed long, kept string")


def op5_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_WORDS = "regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
s AS (
  SELECT doc_id, p, array_to_string(w[p : p + {WINDOW - 1}], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM d)),
first AS (SELECT win, min(doc_id) AS m FROM s GROUP BY win),
hit AS (SELECT doc_id, list(p) AS ps FROM s JOIN first USING (win) WHERE m < doc_id GROUP BY doc_id),
gone AS (
  SELECT doc_id, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + {WINDOW})))) AS g FROM hit),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
lost AS (SELECT doc_id, unnest(g) AS i FROM gone),
kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.i) FILTER (lost.i IS NULL) AS t, count(lost.i) AS r
  FROM word LEFT JOIN lost ON word.doc_id = lost.doc_id AND word.i = lost.i GROUP BY word.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(r, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
