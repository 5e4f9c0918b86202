"""Operator 1, benchmark decontamination by spaced-seed hashing (native).

Words are maximal runs of letters and digits of the lower-cased text.  A
document overlaps a benchmark item where ``WINDOW`` consecutive words of the
item stand in the document, in order, with at most 2 of the 13 substituted (an
item of 9 to 12 words must stand there whole with at most 1 substituted, one
of 8 words unchanged; shorter items are no evidence and are ignored).

* Seeds: every mask of ``MASKS`` picks 6 of up to 8 consecutive words and
  ignores the rest; its hash is taken at every word of the items and of the
  documents.  The masks are lossless: whatever words of such a window are
  substituted, one mask at one place sees none of them (tested by enumeration).
* Join: the items' seeds are broadcast and meet the documents' seeds as they
  are generated, inside one code-generated stage; no document seed is shuffled.
* Verification: around each hit, along its diagonal, every window that holds
  the seed is compared word by word.

The benchmark is cut into segments and joined in blocks of at most about
``MAX_SEEDS`` seeds, so the broadcast is bounded at any benchmark size (each
block is one more scan of the documents).  Equal segments are broadcast once,
without item ids; those join the verified windows by shuffle.

Scale: one scan of the documents, and shuffles of the few verified windows.

Defined cases: null and empty texts overlap nothing; rows with one id are
reported together (a null id like any other); equal items are each reported;
very long items are compared in overlapping segments; an empty table of
either kind gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import cut, keyed, table

WINDOW = 13
MIN_WORDS = 8
#: Word offsets that each mask keeps.
MASKS = ((0, 1, 2, 3, 4, 6), (0, 1, 2, 3, 5, 6), (0, 3, 4, 5, 6, 7))
MAX_SEEDS = 300_000
SEGMENT = 500


def allowed(words: int) -> int:
    """Substitutions allowed in a window of so many words."""
    return 2 if words >= 13 else 1 if words >= 9 else 0


def _word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(df: DataFrame, at: str) -> DataFrame:
    """One row per mask and word ``at`` that has the mask's span of words after it."""
    def seed(i: int, mask: tuple[int, ...]) -> Column:
        picked = [F.get("_h", F.col(at) + o) for o in mask]
        return F.when(F.col(at) + (mask[-1] + 1) <= F.size("_h"), F.struct(
            F.xxhash64(F.lit(i), *picked).alias("seed"), F.lit(mask[-1] + 1).alias("span")))

    # outer: an inner explode would compute the word hashes again in a filter below it
    return (df.select("*", F.posexplode_outer("_h").alias(at, "_word")).drop("_word")
            .select("*", F.explode(F.array(*[seed(i, m) for i, m in enumerate(MASKS)])).alias("_s"))
            .where("_s is not null").select(*df.columns, at, "_s.seed", "_s.span"))


def _windows() -> Column:
    """First words (in the segment) of the windows that hold the hit and agree:
    ``_x`` and ``_y`` are the words around it from ``_from`` on in the document
    (of ``_n`` words) and from ``_start`` on in the segment (of ``_m`` words)."""
    w = f"least({WINDOW}, _m)"
    low = f"greatest(0, _q + span - {w}, _q - _p)"
    high = f"least(_q, _m - {w}, _n - {w} - _p + _q)"
    most = f"case when _m >= 13 then {allowed(13)} when _m >= 9 then {allowed(9)} else 0 end"
    return F.expr(
        f"case when {low} <= {high} then filter(sequence({low}, {high}), a -> aggregate("
        f"sequence(0, {w} - 1), 0, (c, x) -> c + case when get(_x, _p - _q + a + x - _from) = "
        f"get(_y, a + x - _start) then 0 else 1 end) <= {most}) end")


def _around(words: str, at: str) -> tuple[Column, Column]:
    """The words that a window holding the seed at ``at`` can reach, and where they start."""
    start = F.greatest(F.lit(0), F.col(at) + F.col("span") - WINDOW)
    return F.slice(words, start + 1, F.lit(2 * WINDOW)), start


def segments(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct segments of the items (_segment, _g), and the items of each
    (_segment, item_id): equal items are one row of the first table only."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             _word_hashes(F.col("text")).alias("_all")).where(f"size(_all) >= {MIN_WORDS}")
    starts = F.expr(f"sequence(0, greatest(0, size(_all) - {WINDOW}), {SEGMENT})")
    every = cut(items.select("item_id", "_all", F.explode(starts).alias("_at")).select(
        "item_id", F.slice("_all", F.col("_at") + 1, F.lit(SEGMENT + WINDOW - 1)).alias("_g"))
        .withColumn("_segment", F.xxhash64("_g")))
    return cut(every.select("_segment", "_g").distinct()), every.select("_segment", "item_id").distinct()


def _matches(docs: DataFrame, parts: DataFrame, ids: list[str]) -> DataFrame:
    """One row per matched window: ``ids``, _segment, first_word, last_word."""
    seeds = parts.agg(F.coalesce(F.sum(F.size("_g")), F.lit(0))).first()[0] * len(MASKS)
    blocks = max(1, -(-seeds // MAX_SEEDS))
    words = docs.select(*ids, _word_hashes(F.col("text")).alias("_h"))
    found = []
    for i in range(blocks):
        part = parts.where(F.pmod(F.col("_segment"), F.lit(blocks)) == i)
        keyed = _seeds(part.select("_segment", F.col("_g").alias("_h")), "_q").drop("_h", "span")
        # both broadcasts hold one block: about MAX_SEEDS seeds, and their words; a hit
        # keeps the words around it only, as a long text may have very many
        words_x, from_x = _around("_h", "_p")
        hits = _seeds(words, "_p").join(F.broadcast(keyed), "seed").select(
            *ids, "_p", "_q", "span", "_segment", words_x.alias("_x"), from_x.alias("_from"),
            F.size("_h").alias("_n"))
        words_y, from_y = _around("_g", "_q")
        hits = hits.join(F.broadcast(part), "_segment").select(
            *ids, "_p", "_q", "span", "_x", "_from", "_n", "_segment", words_y.alias("_y"),
            from_y.alias("_start"), F.size("_g").alias("_m"))
        good = hits.select(*ids, "_segment", (F.col("_p") - F.col("_q")).alias("_d"), "_m",
                           F.explode_outer(_windows()).alias("_a")).where("_a is not null")
        found.append(good.select(
            *ids, "_segment", (F.col("_d") + F.col("_a")).alias("first_word"),
            (F.col("_d") + F.col("_a") + F.least(F.lit(WINDOW), F.col("_m")) - 1).alias("last_word")))
    return reduce(DataFrame.unionByName, found)


def overlaps(docs: DataFrame, benchmark: DataFrame, ids: list[str]) -> DataFrame:
    """One row per document and item that overlap: the ``ids`` columns of
    ``docs``, item_id, first_word and last_word (0-based, of the matched words
    in the document, over all its matched windows)."""
    parts, owners = segments(benchmark)
    span = [F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word")]
    every = _matches(docs, parts, ids).groupBy(*ids, "_segment").agg(*span)
    # by shuffle: a segment may be in any number of items
    return every.join(owners.hint("merge"), "_segment").groupBy(*ids, "item_id").agg(*span)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that overlap no benchmark item."""
    rows = keyed(docs)
    bad = _matches(rows.select("_k1", "_k2", "_row.text"), segments(benchmark)[0], ["_k1", "_k2"])
    return rows.join(bad.select("_k1", "_k2").distinct(), ["_k1", "_k2"], "left_anti").select("_row.*")


def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return overlaps(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])


#: The same windows found without seeds: a window of 13 words with 2
#: substitutions (9 to 12 with 1, 8 with none) holds 4 unchanged words in a row.
ORACLE = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS h FROM documents),
b AS (
  SELECT item_id, g, least({WINDOW}, len(g)) AS w,
         CASE WHEN len(g) >= 13 THEN 2 WHEN len(g) >= 9 THEN 1 ELSE 0 END AS most
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS g FROM benchmark)
  WHERE len(g) >= {MIN_WORDS}),
dg AS (
  SELECT doc_id, p, h[p] || ' ' || h[p + 1] || ' ' || h[p + 2] || ' ' || h[p + 3] AS gram
  FROM (SELECT doc_id, h, unnest(range(1, len(h) - 2)) AS p FROM d)),
bg AS (
  SELECT item_id, q, g[q] || ' ' || g[q + 1] || ' ' || g[q + 2] || ' ' || g[q + 3] AS gram
  FROM (SELECT item_id, g, unnest(range(1, len(g) - 2)) AS q FROM b)),
diagonals AS (
  SELECT DISTINCT doc_id, item_id, p - q AS diagonal FROM dg JOIN bg USING (gram)),
windows AS (
  SELECT doc_id, item_id, diagonal, h, g, w, most, unnest(range(1, len(g) - w + 2)) AS a
  FROM diagonals JOIN d USING (doc_id) JOIN b USING (item_id)),
matched AS (
  SELECT doc_id, item_id, diagonal + a - 1 AS first_word, diagonal + a + w - 2 AS last_word
  FROM windows
  WHERE diagonal + a >= 1 AND diagonal + a + w - 1 <= len(h)
    AND len(list_filter(range(a, a + w), lambda x: h[diagonal + x] <> g[x])) <= most)
SELECT doc_id, item_id, min(first_word) AS first_word, max(last_word) AS last_word
FROM matched GROUP BY doc_id, item_id
"""
