"""Operator 12, filter interaction audit: recursive CTE over filter orders.

What a filter removes depends on the filters before it.  The audit applies every
order of the filters and reports each step's effect, per part of the corpus.

* Each document becomes a mask: one bit per filter that it fails.  Documents of
  equal part and mask are counted together (``cells``), so the orders are never
  applied to documents, only to at most 2^k masks per part.
* A recursive CTE (``steps``) starts from all masks and the empty prefix.  Each
  level extends every prefix by each letter that it lacks, and carries the bits
  applied before the step and after it; so every level emits, for each mask,
  what its step does to documents of that mask.
* The cells join the emitted steps by mask, and a sum per part and prefix gives
  the step's counts.  An order's first steps are those of its prefixes, so each
  prefix is counted once and handed to the orders that begin with it; a step's
  share in a filter's ``shapley`` is its count times the number of such orders.

A duplicate is found by hash: the smallest doc_id of every text (SHA-256), joined
back by (text, doc_id), so a text that a third of all rows share is spread by id.

Scale: one scan of the texts, narrow rows after it; all groups are pre-aggregated.
The steps are broadcast: k filters make 2^k * (k + k (k - 1) + ...) rows, 10,400
for five, whatever the corpus; ``MAX_FILTERS`` bounds k, as Spark bounds a
recursion's rows.

Defined cases: a null text is the empty text, and equal to other empty texts; a
null source is the part '' (as an empty one); very long texts are read whole; a
null doc_id is never smaller or larger than another, so such rows are no
duplicates and have no labels; rows that repeat a doc_id and text are no
duplicates of each other; an id labelled several times is good (toxic) if one
label says so; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import cut, table

#: Filters audited at most: six give 125,184 steps, seven would pass a million.
MAX_FILTERS = 6
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 2

Filter = Callable[[Column, Column], Column]
#: Failure conditions by letter, of a text and its words.
FILTERS: dict[str, Filter] = {
    "A": lambda text, words: F.size(words) < MIN_WORDS,
    "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
    "C": lambda text, words: 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > MAX_UPPER_PERCENT * F.length(text),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: The letter of "equals the text of a smaller doc_id".
DUPLICATE = "E"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def masks(docs: DataFrame, filters: dict[str, Filter] = FILTERS) -> DataFrame:
    """doc_id, part, ``text_key`` and ``mask`` (bit i: fails the i-th filter) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), ""))
    bits = [F.when(fails(F.col("text"), F.col("words")), 1 << i).otherwise(0) for i, fails in enumerate(filters.values())]
    mask = F.lit(0)
    for b in bits:
        mask = mask + b
    return rows.select("doc_id", "part", F.sha2("text", 256).alias("text_key"), mask.alias("mask"))


def cells(docs: DataFrame, labels: DataFrame, filters: dict[str, Filter] = FILTERS) -> DataFrame:
    """Documents (``n``), and those labelled good and toxic, per part and mask;
    the duplicates' bit follows those of ``filters``."""
    rows = cut(masks(docs, filters).groupBy("text_key", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    first = rows.groupBy(F.col("text_key").alias("_key")).agg(F.min("doc_id").alias("_first"))
    rows = rows.join(first, (F.col("text_key") == F.col("_key")) & (F.col("doc_id") == F.col("_first")), "left")
    copy = F.when(F.col("doc_id").isNotNull() & F.col("_first").isNull(), 1 << len(filters)).otherwise(0)
    label = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    # rows without an id are spread by their text; the flag keeps them from every label
    rows = rows.select("part", "n", (F.col("mask") + copy).alias("mask"), F.col("doc_id").isNull().alias("_none"),
                       F.coalesce("doc_id", F.xxhash64("text_key")).alias("_doc"))
    found = rows.join(label.withColumn("_some", F.lit(False)),
                      (F.col("_doc") == F.col("_id")) & (F.col("_none") == F.col("_some")), "left")
    return found.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.coalesce(F.col("good") * F.col("n"), F.lit(0))).alias("good"),
        F.sum(F.coalesce(F.col("toxic") * F.col("n"), F.lit(0))).alias("toxic"))


def steps(spark: SparkSession, letters: str) -> DataFrame:
    """Every prefix of every order of ``letters``, with every mask: prefix, step,
    letter and its bit, and the bits applied ``before`` and with the step."""
    each = ", ".join(f"struct('{x}' AS letter, {1 << i} AS bit)" for i, x in enumerate(letters))
    return spark.sql(f"""
        WITH RECURSIVE steps(prefix, step, letter, bit, mask, before, applied) AS (
            SELECT '', 0, '', 0, mask, 0, 0 FROM (SELECT explode(sequence(0, {(1 << len(letters)) - 1})) AS mask)
            UNION ALL
            SELECT concat(prefix, next.letter), step + 1, next.letter, next.bit, mask, applied, applied | next.bit
            FROM steps LATERAL VIEW explode(filter(array({each}), x -> (x.bit & applied) = 0)) AS next
        )
        SELECT * FROM steps WHERE step > 0""")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Filter] = FILTERS,
          duplicate: str = DUPLICATE) -> DataFrame:
    """One row per part, order of all filters and step: part, filter_order, step and
    the long counts ``COUNTS`` and ``shapley`` of the step's filter."""
    letters = "".join(filters) + duplicate
    if len(letters) > MAX_FILTERS or len(set(letters)) < len(letters) or not letters.isalnum():
        raise ValueError(f"one to {MAX_FILTERS} filters, each with a letter of its own")
    every = cut(steps(docs.sparkSession, letters))
    own = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    counts = {"kept": (F.col("mask").bitwiseAND(F.col("applied")) == 0, "n"), "removed": (own & ~gone, "n"),
              "redundant": (own & gone, "n"), "unique_fails": (F.col("mask") == F.col("bit"), "n"),
              "good_lost": (own & ~gone, "good"), "toxic_lost": (own & ~gone, "toxic")}
    done = cells(docs, labels, filters).join(F.broadcast(every), "mask").groupBy("part", "prefix", "step", "letter").agg(
        *[F.sum(F.when(when, F.col(what)).otherwise(F.lit(0))).cast("long").alias(name) for name, (when, what) in counts.items()])
    # orders that begin with a prefix: those of the letters that it lacks
    orders = F.expr(f"factorial({len(letters)} - step)")
    done = done.withColumn("shapley", F.sum(F.col("removed") * orders).over(Window.partitionBy("part", "letter")).cast("long"))
    whole = every.where((F.col("step") == len(letters)) & (F.col("mask") == 0)).select(
        F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.col("step"))).alias("_step"))
    whole = whole.select("filter_order", F.expr("left(filter_order, _step)").alias("prefix"))
    return done.join(F.broadcast(whole), "prefix").select("part", "filter_order", "step", *COUNTS, "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Plain form: every order as a permutation, its filters compared one by one.
ORACLE = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), marks AS (
    SELECT coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic, doc_id FROM labels
), fails AS (
    SELECT d.part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
           100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
           regexp_matches(text, '[#$%&*|]') AS d,
           d.doc_id > min(d.doc_id) OVER (PARTITION BY text) AS e,
           coalesce((SELECT bool_or(good) FROM marks m WHERE m.doc_id = d.doc_id), false) AS good,
           coalesce((SELECT bool_or(toxic) FROM marks m WHERE m.doc_id = d.doc_id), false) AS toxic
    FROM docs d
), cells AS (
    SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
           || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS failed,
           count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM fails GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
named AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[1:step - 1] AS past FROM steps
), flat AS (
    SELECT part, filter_order, step, own, failed, n, good, toxic, contains(failed, own) AS hit,
           past <> '' AND regexp_matches(failed, '[' || past || '-]') AS gone FROM cells, named
), sums AS (
    SELECT part, filter_order, step, own, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
    FROM flat GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM sums"""
