"""Operator 13, phrase collocations from depth-truncated suffix subtrees.

Texts are cut at punctuation and line ends into pieces, pieces into words; all
counts are per language.  The suffix that starts at a word, truncated after
``DEPTH`` words or at the piece's end, is a leaf of the language's word suffix
trie, and the count of a phrase is the total of the leaves below its node.  The
trie is never built whole (elastic-range style):

1. *Vertical partitioning.*  Prefixes of one word are counted.  A prefix of more
   than a budget of suffixes (``BUDGET``, or one in ``SHARE`` of all) is extended by a second word, and these longer
   prefixes are counted in turn; one over budget again is extended to the third
   word, which is a leaf.  The counts above a partition's prefix come
   from this step.
2. *Grouping.*  Prefixes are put into groups by hash, as many groups as make half
   a budget of suffixes each on average, so a group's memory is bounded by the
   budget, whatever the corpus or a word's share of it.
3. *Subtrees.*  Leaves with equal words are added up where they are read, and sent
   to their group.  Each group sorts its leaves and reads the count of every
   node off the leaf totals below it, independently of all other groups.

A suffix is also cut before a word of fewer than ``MIN_COUNT`` occurrences: no
longer phrase can be a candidate.  The words and prefixes asked for inside tasks
(frequent, over budget) are broadcast as bitmaps of ``BITS`` bits by hash: of one
size for any corpus, and exact in effect, as a bit that is set by another word
only sends more leaves, or extends a prefix that needed no extension.

A word stands as 64 bits of hash of language and word while it is counted; that
no two words share one is checked over the whole vocabulary, and the count
starts anew with another seed if two do.

Scale: three scans of the texts (two where no prefix is over budget); leaves are
pre-aggregated in blocks of ``BLOCK``; no key's rows meet in one task beyond the
budget.  Lookups of counts are one join on exploded keys, which adaptive
execution may split.

Defined cases: a null text is empty, a null language is ``und``; very long texts
are read in slices that end where a piece ends, so only a single piece is held
whole; equal scores rank by count, then by phrase; repeated rows count as often
as they stand; an empty table gives no rows; other columns are ignored.  Scores
are exact for counts below 10^16.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import cut, key_groups, table, written
from .textkernel import mix64, text_bytes

MIN_COUNT, TOP = 10, 2000
#: Parts that a language's phrases are ranked in before they are ranked together.
TOP_PARTS = 16
#: A longer phrase hides its parts from this share (percent) of their count on.
HIDE_PERCENT = 50
#: Words of a suffix (the code below names them h1, h2, h3).
DEPTH = 3
#: Suffixes of a prefix that one group may hold: so many, and this share of all at most,
#: so that groups are even in small corpora too.
BUDGET, SHARE = 500_000, 256
#: Bits of the broadcast sets (8 MB each).
BITS = 1 << 26
#: Bytes of text handled at once, and leaves that are added up before they are sent.
SLICE_BYTES, BLOCK = 1_500_000, 250_000
NO_LANG = "und"

_LEAF = "g long, h1 long, h2 long, h3 long, n long"
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


#: Longer words are hashed one by one.
_LONG = 64
_BASE = 0x9E3779B97F4A7C15  # odd: it has an inverse modulo 2**64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_power_cache: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _power_cache.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        _power_cache[base] = have = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


@dataclass
class Slice:
    """Words of some bytes (``data``, lower case): bounds, piece, language (an index
    of ``names``) and key of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    names: list[str]
    key: np.ndarray

    def distinct(self) -> tuple[np.ndarray, list[str], list[str], np.ndarray]:
        """The distinct words of each language: key, language, word, occurrences."""
        size = np.zeros(len(self.starts) + 1, dtype=np.int64)
        np.cumsum(self.ends - self.starts, out=size[1:])
        words = pa.Array.from_buffers(pa.large_binary(), len(self.starts), [
            None, pa.py_buffer(size), pa.py_buffer(self.data[~_GAP[self.data]])]).dictionary_encode()
        code = np.frombuffer(words.indices.buffers()[1], np.int32)[:len(self.starts)]
        count = np.bincount(code.astype(np.int64) * len(self.names) + self.lang)
        both = np.flatnonzero(count)
        at = np.zeros(len(count), dtype=np.int64)
        at[code.astype(np.int64) * len(self.names) + self.lang] = np.arange(len(code))
        _, offs, text = words.dictionary.buffers()
        offs, text = np.frombuffer(offs, np.int64).tolist(), text.to_pybytes()
        word, lang = both // len(self.names), both % len(self.names)
        return (self.key[at[both]], [self.names[i] for i in lang.tolist()],
                [text[offs[i]:offs[i + 1]].decode() for i in word.tolist()], count[both])


def _bounds(data: np.ndarray, offs: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``limit`` bytes that end where a piece ends."""
    low = 0
    while low < len(data):
        high = min(low + limit, len(data))
        if high < len(data):
            row = int(offs[np.searchsorted(offs, high, side="right") - 1])
            ends = np.flatnonzero(_BREAK[data[low:high]])
            if row > low:
                high = row
            elif len(ends):
                high = low + int(ends[-1]) + 1
            else:
                stop = int(offs[np.searchsorted(offs, high, side="right")])
                ends = np.flatnonzero(_BREAK[data[high:stop]])
                high = high + int(ends[0]) + 1 if len(ends) else stop
        yield low, high
        low = high


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64 bits of hash of every word: a polynomial over its bytes, from sums over all
    bytes; long words, for which such polynomials can be made to collide, by XXH3."""
    n = len(data)
    value = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(value[data] * _powers(_BASE, n), out=total[1:])
    out = (total[ends] - total[starts]) * _powers(pow(_BASE, -1, 1 << 64), n + 1)[starts]
    for i in np.flatnonzero(ends - starts > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes(), seed)
    return mix64(out + (ends - starts).astype(np.uint64))


def _parts(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``batch`` of about ``limit`` bytes of text together, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(ends):
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(low, high - low)
        low = high


def slices(batch: pa.RecordBatch, seed: int, limit: int) -> Iterator[Slice]:
    """The words of a batch of (text, lang)."""
    for part in _parts(batch, limit):
        yield from _slices(part, seed, limit)


def _slices(batch: pa.RecordBatch, seed: int, limit: int) -> Iterator[Slice]:
    data, offs = text_bytes(batch.column(0))
    lang = batch.column(1).fill_null(NO_LANG).dictionary_encode()
    lang_of, names = lang.indices.to_numpy(), lang.dictionary.to_pylist()
    seeds = np.array([xxhash.xxh3_64_intdigest(x.encode(), seed) for x in names], dtype=np.uint64)
    for low, high in _bounds(data, offs, limit):
        b = _LOWER[data[low:high]]
        word = ~_GAP[b]
        inner = offs[(offs > low) & (offs < high)] - low
        before, after = np.zeros(len(b), bool), np.zeros(len(b), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        before[inner], after[inner - 1] = False, False
        starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        if not len(starts):
            continue
        row = np.searchsorted(offs, starts + low, side="right") - 1
        piece = np.searchsorted(np.flatnonzero(_BREAK[b]), starts) + row
        key = mix64(_hashes(b, starts, ends, seed) + seeds[lang_of[row]]).view(np.int64)
        key[key == 0] = 1  # 0 stands for "no word"
        yield Slice(b, starts, ends, piece, lang_of[row], names, key)


def _vocabulary(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch, seed, SLICE_BYTES):
                key, lang, word, n = s.distinct()
                yield pa.RecordBatch.from_arrays([
                    pa.array(key), pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n)],
                    ["h", "lang", "word", "n"])
    return run


def vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """Rows (h, lang, word, n) of all words, and the seed with which ``h`` is unique."""
    for seed in range(1, 9):
        words = written(texts.mapInArrow(_vocabulary(seed), "h long, lang string, word string, n long")
                        .groupBy("h", "lang", "word").agg(F.sum("n").alias("n")))
        if words.groupBy("h").count().where("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("no seed keeps the words apart")


def bitmap(rows: DataFrame, key: Column) -> bytes:
    """The set of ``key`` modulo ``BITS``: at most BITS / 2^15 rows of 4 KB reach the driver."""
    at = F.pmod(key, F.lit(BITS))
    parts = rows.select(F.shiftright(at, 15).alias("part"), at.bitwiseAND(32767).alias("bit")).groupBy("part").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    out = bytearray(BITS // 8)
    for part, bits in parts.collect():
        out[part * 4096:(part + 1) * 4096] = bits
    return bytes(out)


def _held(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key & np.int64(BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _joined(*keys: np.ndarray) -> np.ndarray:
    """One key of several words in order."""
    acc = np.zeros(len(keys[0]), dtype=np.uint64)
    for k in keys:
        acc = mix64(acc + k.view(np.uint64))
    return acc.view(np.int64)


def _added(cols: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``cols`` in their order, and the sums of ``n``."""
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    at = np.flatnonzero(new)
    return [c[at] for c in cols], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _next(s: Slice, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: whether a suffix goes on to the next word, and the keys of the
    next two words (0 where the suffix ends before)."""
    n = len(s.key)
    known = _held(frequent, s.key)
    goes = np.zeros(n, dtype=bool)
    goes[:-1] = known[:-1] & known[1:] & (s.piece[1:] == s.piece[:-1])
    second, third = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    second[:-1] = np.where(goes[:-1], s.key[1:], 0)
    third[:-1] = np.where(goes[:-1], second[1:], 0)
    return goes, second, third


def _extensions(seed: int, frequent, heavy):
    """Occurrences of two-word prefixes whose first word is over budget."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, big = (np.frombuffer(x.value, np.uint8) for x in (frequent, heavy))
        for batch in batches:
            for s in slices(batch, seed, SLICE_BYTES):
                goes, second, _ = _next(s, known)
                at = np.flatnonzero(goes & _held(big, s.key))
                (h1, h2), n = _added([s.key[at], second[at]], np.ones(len(at), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1, h2, _joined(h1, h2), n)], ["h1", "h2", "k", "n"])
    return run


def _leaves(seed: int, groups: int, frequent, heavy, heavier):
    """Leaves of two words or more, with the group of their prefix."""
    def packed(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        cols = [np.concatenate(c) for c in zip(*parts)]
        cols, n = _added(cols[:-1], cols[-1])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (*cols, n)], ["g", "h1", "h2", "h3", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, big, bigger = (np.frombuffer(x.value, np.uint8) for x in (frequent, heavy, heavier))
        held: list[list[np.ndarray]] = []
        for batch in batches:
            for s in slices(batch, seed, SLICE_BYTES):
                goes, second, third = _next(s, known)
                long = _held(big, s.key)
                at = np.flatnonzero(goes & ~(long & (third == 0)))  # such a leaf is counted as a prefix
                h1, h2, h3, long = s.key[at], second[at], third[at], long[at]
                two = _joined(h1, h2)
                prefix = np.where(long, np.where(_held(bigger, two), _joined(h1, h2, h3), two), _joined(h1))
                held.append([prefix.view(np.uint64) % np.uint64(groups), h1, h2, h3, np.ones(len(at), dtype=np.int64)])
                held[-1][0] = held[-1][0].astype(np.int64)
                if sum(len(x[0]) for x in held) >= BLOCK:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)
    return run


def _subtrees(min_count: int, heavy):
    """The nodes of ``min_count`` occurrences or more of each group's subtrees,
    from two words on (two words only where the group has the whole prefix)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        big = np.frombuffer(heavy.value, np.uint8)
        for group in key_groups(batches, 1):
            (h1, h2, h3), total = _added([group.column(i).to_numpy() for i in (1, 2, 3)], group.column(4).to_numpy())
            inner = np.ones(len(h1), dtype=bool)
            inner[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            at = np.flatnonzero(inner)
            below = np.add.reduceat(total, at)
            two = (below >= min_count) & ~_held(big, h1[at])
            three = (total >= min_count) & (h3 != 0)
            cols = [np.concatenate([h1[at][two], h1[three]]), np.concatenate([h2[at][two], h2[three]]),
                    np.concatenate([np.zeros(int(two.sum()), np.int64), h3[three]]),
                    np.concatenate([below[two], total[three]])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["h1", "h2", "h3", "a"])
    return run


def phrases(texts: DataFrame, words: DataFrame, seed: int, min_count: int = MIN_COUNT, budget: int = BUDGET) -> DataFrame:
    """Rows (h1, h2, h3, a) of all phrases of two (h3 = 0) or three words with
    ``a`` >= ``min_count`` occurrences."""
    spark = texts.sparkSession
    share = spark.sparkContext.broadcast
    often = words.where(F.col("n") >= min_count)
    suffixes = often.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    budget = min(budget, max(1, suffixes // SHARE))
    frequent = share(bitmap(often, F.col("h")))
    over = words.where(F.col("n") > budget)
    heavy, heavier = share(bitmap(over, F.col("h"))), share(bytes(BITS // 8))
    known = spark.createDataFrame([], "h1 long, h2 long, k long, n long")
    if not over.isEmpty():
        known = cut(texts.mapInArrow(_extensions(seed, frequent, heavy), known.schema)
                    .groupBy("h1", "h2", "k").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
        heavier = share(bitmap(known.where(F.col("n") > budget), F.col("k")))
    groups = max(1, -(-2 * suffixes // budget))
    leaves = texts.mapInArrow(_leaves(seed, groups, frequent, heavy, heavier), _LEAF)
    nodes = leaves.repartition("g").sortWithinPartitions("g").mapInArrow(
        _subtrees(min_count, heavy), "h1 long, h2 long, h3 long, a long")
    return written(nodes.unionByName(known.select("h1", "h2", F.lit(0).cast("long").alias("h3"), F.col("n").alias("a"))))


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)) of long columns, exact for counts below 10^16."""
    return F.expr(f"(1000000BD * cast({a} AS decimal(16,0)) * cast({a} AS decimal(16,0))) "
                  f"div (cast({left} AS decimal(16,0)) * cast({right} AS decimal(16,0)))")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select("text", "lang")
    words, seed = vocabulary(texts)
    nodes = phrases(texts, words, seed, min_count, budget)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    # a phrase of two words that stands mostly in one of three is dropped
    inside = nodes.where("h3 <> 0").select("a", F.explode(F.array(
        F.struct(F.col("h1").alias("_1"), F.col("h2").alias("_2")),
        F.struct(F.col("h2").alias("_1"), F.col("h3").alias("_2")))).alias("_p"))
    inside = inside.groupBy("_p._1", "_p._2").agg(F.max("a").alias("_longer"))
    kept = nodes.join(inside, (F.col("h3") == 0) & (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")), "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < HIDE_PERCENT * F.col("a"))).select("h1", "h2", "h3", "a")
    # the counts that a score needs: l1, r1 for the cut after one word, l2, r2 after two
    none = F.lit(0).cast("long")

    def asked(role: str, first: Column, second: Column = none) -> Column:
        return F.struct(F.lit(role).alias("role"), first.alias("k1"), second.alias("k2"))

    h1, h2, h3 = F.col("h1"), F.col("h2"), F.col("h3")
    parts = F.when(h3 == 0, F.array(asked("l1", h1), asked("r1", h2))).otherwise(F.array(
        asked("l1", h1), asked("r1", h2, h3), asked("l2", h1, h2), asked("r2", h3), asked("mid", h2)))
    known = (words.where(F.col("n") >= min_count).select(F.col("h").alias("k1"), none.alias("k2"), F.col("n").alias("f"), "lang", "word")
             .unionByName(nodes.where("h3 = 0").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("a").alias("f")),
                          allowMissingColumns=True))
    looked = kept.select("h1", "h2", "h3", "a", F.explode(parts).alias("_q")).select(
        "h1", "h2", "h3", "a", "_q.role", "_q.k1", "_q.k2").join(known, ["k1", "k2"])

    def of(role: Column, value: str) -> Column:
        return F.max(F.when(role, F.col(value)))

    role = F.col("role")
    found = looked.groupBy("h1", "h2", "h3", "a").agg(
        F.max("lang").alias("lang"), *[of(role == x, "f").alias(x) for x in ("l1", "r1", "l2", "r2")],
        of(role == "l1", "word").alias("w1"), of((role == "mid") | ((role == "r1") & (h3 == 0)), "word").alias("w2"),
        of(role == "r2", "word").alias("w3"))
    found = found.withColumns({"s1": score("a", "l1", "r1"), "s2": score("a", "l2", "r2"), "phrase": F.concat_ws(" ", "w1", "w2", "w3")})
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    scored = found.select("lang", "phrase", "a", *[F.when(second, F.col(f"{x}2")).otherwise(F.col(f"{x}1")).alias(y)
                                                  for x, y in (("l", "l"), ("r", "r"), ("s", "score"))])
    # first in parts of a language, so that the last step reads TOP_PARTS * top rows of one at most
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: Plain form: all phrases counted as strings.
ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), spots AS (
    SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM worded
), grams AS (
    SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, ws[i:i + k - 1] AS own, count(*) AS f
    FROM spots, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL
), n AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM grams WHERE f >= 10),
inside AS (
    SELECT lang, part, max(f) AS longer FROM (
        SELECT lang, f, unnest([array_to_string(own[1:2], ' '), array_to_string(own[2:3], ' ')]) AS part FROM often WHERE k = 3)
    GROUP BY ALL
), kept AS (
    SELECT o.* FROM often o LEFT JOIN inside i ON o.k = 2 AND o.lang = i.lang AND o.phrase = i.part
    WHERE o.k >= 2 AND (longer IS NULL OR 100 * longer < 50 * f)
), cuts AS (
    SELECT lang, phrase, own, f AS a, unnest(range(1, k)) AS c FROM kept
), scored AS (
    SELECT u.lang, u.phrase, u.a, x.f AS l, y.f AS r, u.c,
           (1000000::HUGEINT * u.a * u.a) // (x.f::HUGEINT * y.f) AS score
    FROM cuts u JOIN often x ON x.lang = u.lang AND x.phrase = array_to_string(u.own[1:c], ' ')
    JOIN often y ON y.lang = u.lang AND y.phrase = array_to_string(u.own[c + 1:], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM lowest JOIN n USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""
