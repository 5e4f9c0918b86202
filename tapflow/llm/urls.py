"""Operator 8, URL filters: fixed host rules, then mined association rules.

A fixed rule fits its host and all subdomains where the path starts with the
rule's path; the longest that fits decides.  Every other url is judged by
association rules:

* A url is a set of tokens: scheme, host suffixes, words (runs of letters) of
  the host but its last label, path words and their runs of letters in lower
  case, file ending, query keys and values, and whether it has a fragment.
* Labels belong to urls: a url is bad when a listed word (``HOST_WORDS``,
  ``PATH_WORDS``) stands in its host or path, and good otherwise (``marked``).
  The ``labels`` table is not used: it covers ids of ``documents``, and equal
  ids of ``pages`` are other things.  Fixed verdicts are no labels either: what
  a fixed rule says holds inside its host and path only.  ``mine`` takes
  labels by page id (bad when quality is 0 or toxic is 1) where there are some.
* Labelled urls are transactions of their tokens; Spark's FP-growth mines the
  token combinations of the bad ones, and the rules "tokens -> bad" are pruned
  by support (``MIN_ROWS`` bad urls, whatever the size of the corpus),
  confidence and by any shorter rule that is as confident.
* A listed word by itself is a rule of confidence 1, however few urls have it
  (``listed``).
* Inverted index: each rule is filed under its rarest token.  A url's tokens
  meet the index, the rule's other tokens are checked in place, and the most
  confident rule that holds gives the verdict (block); without one: allow.

Scale: FP-growth runs on Spark over the bad urls, confidence is counted over
all of them by a join, in groups of equal token sets; urls are judged once
each, however often they are repeated.  FP-growth sees no token that cannot be
part of a longer rule that stays: one that only bad urls have (it is a rule
itself), one that all urls have, and all but one of the tokens that always
stand together (the others are put back into the rules).  The index and the
token table are broadcast only when their counted size is within
``MAX_BROADCAST_RULES``, and joined by shuffle beyond.

Defined cases: a null url, or one without "://", has an empty host and path,
no tokens, and is allowed; labels may be null or missing; without labelled
urls nothing is mined; very long urls are read whole; repeated urls get the
same verdict; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import cut, table

#: (verdict, host, path) of the fixed rules.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: A rule holds for this many bad urls at least, and this share of the urls with its tokens.
MIN_ROWS, MIN_CONFIDENCE = 20, 0.6
#: Rules that are broadcast at most.
MAX_BROADCAST_RULES = 20_000
#: Words (whole, between non-letters) that make a url bad: in its host, and in its path.
HOST_WORDS = ("adult", "bet", "bets", "betting", "casino", "casinos", "pills", "poker", "porn", "viagra", "xxx")
PATH_WORDS = ("casino", "casinos", "porn", "viagra", "xxx")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (length, rule, verdict) of the longest fixed rule that fits, or null."""
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                   F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return F.array_max(F.array(*fits))


def tokens(url: Column) -> Column:
    """The distinct tokens of a url; none without "://"."""
    url = F.coalesce(url, F.lit(""))
    labels = F.split(host_of(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("host:"), F.array_join(F.slice(labels, -i, i), ".")))
    names = F.split(F.array_join(F.slice(labels, 1, F.size(labels) - 1), "."), "[^\\p{L}]+")
    names = F.transform(F.filter(names, lambda w: w != ""), lambda w: F.concat(F.lit("word:"), w))
    words = F.filter(F.split(path_of(url), r"[/._-]+"), lambda w: w.rlike("[^0-9]"))
    runs = F.filter(F.split(F.translate(path_of(url), UPPER, LOWER), "[^\\p{L}]+"), lambda w: w != "")
    words = F.transform(F.concat(words, runs), lambda w: F.concat(F.lit("path:"), w))
    ending = F.concat(F.lit("end:"), F.regexp_extract(path_of(url), r"(\.[A-Za-z0-9]+|/)$", 1))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    keys = F.transform(pairs, lambda p: F.concat(F.lit("key:"), F.substring_index(p, "=", 1)))
    every = F.array_distinct(F.concat(
        F.array(F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1)), ending,
                F.concat(F.lit("fragment:"), F.contains(url, F.lit("#")).cast("string"))),
        suffixes, names, words, keys, F.transform(pairs, lambda p: F.concat(F.lit("pair:"), p))))
    return F.when(F.contains(url, F.lit("://")), every).otherwise(F.array().cast("array<string>"))


#: The tokens that a listed word shows in: a host word, the host's last label, a path word.
LISTED = tuple([f"{kind}:{w}" for w in HOST_WORDS for kind in ("word", "host")] + [f"path:{w}" for w in PATH_WORDS])


def marked(pages: DataFrame) -> DataFrame:
    """The distinct urls of ``pages`` with ``_bad``: 1 when a listed word stands in host or path."""
    bad = F.arrays_overlap(tokens(F.col("url")), F.array(*map(F.lit, LISTED)))
    return pages.select("url").where("url is not null").distinct().withColumn("_bad", bad.cast("int"))


def mine(pages: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``learn`` from labels by page id; a url with several labels is bad when one of them says so."""
    bad = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("_bad")).where("_bad is not null")
    return learn(pages.select(F.col("page_id").cast("long").alias("_id"), "url").join(bad, "_id")
                 .groupBy("url").agg(F.max("_bad").alias("_bad")), **options)


def learn(urls: DataFrame, min_rows: int = MIN_ROWS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules from distinct urls with ``_bad`` (0 or 1) as rows (key, items, confidence,
    support): key is the rarest token of ``items``.  Empty when there is nothing to learn from."""
    baskets = cut(urls.select(
        F.xxhash64(F.lit(1), "url").alias("_k1"), F.xxhash64(F.lit(2), "url").alias("_k2"), "_bad",
        tokens(F.col("url")).alias("items")).where("size(items) > 0"))
    empty = baskets.sparkSession.createDataFrame(
        [], "key string, items array<string>, confidence double, support double")
    n, n_bad = baskets.agg(F.count(F.lit(1)), F.coalesce(F.sum("_bad"), F.lit(0))).first()
    if n_bad < min_rows:
        return empty
    # tokens of the same urls (equal counts, and 128 bits over the urls) are one class
    each = cut(baskets.select("_k1", "_k2", "_bad", F.explode("items").alias("t")).groupBy("t").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_bad").alias("bad"), F.bit_xor("_k1").alias("_x1"),
        F.bit_xor("_k2").alias("_x2")).where(F.col("bad") >= min_rows))
    classes = cut(each.groupBy("n", "bad", "_x1", "_x2").agg(F.min("t").alias("t"), F.collect_list("t").alias("same")))
    # a longer rule with a token of bad urls only, or of all urls, is redundant
    mixed = classes.where((F.col("bad") < F.col("n")) & (F.col("n") < n)).select("t", "n")
    small = mixed.count() <= MAX_BROADCAST_RULES
    met = baskets.select("_k1", "_k2", "_bad", F.explode("items").alias("t")).join(
        F.broadcast(mixed) if small else mixed.hint("merge"), "t")
    sets = cut(met.groupBy("_k1", "_k2").agg(
        F.max("_bad").alias("_bad"), F.array_sort(F.collect_list("t")).alias("basket")))
    rules = classes.select(F.array("t").alias("items"), "bad", "n")
    bad_sets = sets.where("_bad = 1").select(F.col("basket").alias("items"))
    m = bad_sets.count()
    if m >= min_rows:
        # half a row less: the product with m must not round up beyond min_rows
        model = FPGrowth(itemsCol="items", minSupport=(min_rows - 0.5) / m).fit(bad_sets)
        found = cut(model.freqItemsets.where("size(items) > 1").select(
            F.array_sort("items").alias("items"), F.col("freq").alias("bad")))
        filed = found.select("items", "bad", F.explode("items").alias("t")).join(mixed, "t").groupBy("items", "bad").agg(
            F.min(F.struct("n", "t"))["t"].alias("key"))
        filed = F.broadcast(filed) if found.count() <= MAX_BROADCAST_RULES else filed.hint("merge")
        held = sets.groupBy("basket").agg(F.count(F.lit(1)).alias("_c")).select(
            "basket", "_c", F.explode("basket").alias("key")).join(filed, "key").where(
            F.size(F.array_except("items", "basket")) == 0)
        rules = rules.unionByName(held.groupBy("items", "bad").agg(F.sum("_c").alias("n")))
    rules = cut(rules.select("items", (F.col("bad") / F.col("n")).alias("confidence"), (F.col("bad") / n).alias("support"))
                .where(F.col("confidence") >= min_confidence))
    if rules.isEmpty():
        return empty
    # a rule is redundant when one of its parts (one token less) is a rule that is as confident
    part = rules.select("items", "confidence", F.posexplode("items").alias("_i", "_t")).select(
        F.col("items").alias("whole"), F.col("confidence").alias("_c"),
        F.array_remove(F.col("items"), F.col("_t")).alias("items"))
    weak = part.join(rules, "items").where("confidence >= _c").select(F.col("whole").alias("items"))
    kept = rules.join(weak.distinct(), "items", "left_anti")
    # every choice of one token per class
    choice = kept.select("*", F.explode("items").alias("t")).join(classes.select("t", "same"), "t").groupBy(
        "items", "confidence", "support").agg(F.collect_list("same").alias("_same"))
    kept = choice.select("confidence", "support", F.explode(F.expr(
        "aggregate(_same, array(cast(array() as array<string>)), (a, s) -> "
        "flatten(transform(a, x -> transform(s, t -> concat(x, array(t))))))")).alias("items")).withColumn(
        "items", F.array_sort("items"))
    rarest = kept.select("items", F.explode("items").alias("t")).join(each.select("t", "n"), "t").groupBy("items").agg(
        F.min(F.struct("n", "t")).alias("_r"))
    return cut(kept.join(rarest, "items").select(F.col("_r.t").alias("key"), "items", "confidence", "support"))


def listed(rules: DataFrame) -> DataFrame:
    """``rules`` and one rule for each listed word, with support 0 where it was not mined."""
    own = rules.sparkSession.createDataFrame([(t, [t], 1.0, 0.0) for t in LISTED], rules.schema)
    return rules.unionByName(own).groupBy("key", "items").agg(
        F.max("confidence").alias("confidence"), F.max("support").alias("support"))


def judge(pages: DataFrame, rules: DataFrame, max_broadcast: int = MAX_BROADCAST_RULES) -> DataFrame:
    """page_id, host, path, rule (the fixed rule or null), verdict, and
    ``mined`` (the tokens of the indexed rule that decided, or null)."""
    url = F.col("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url)
    index = F.broadcast(rules) if rules.count() <= max_broadcast else rules.hint("merge")
    open_ = (rows.where(fixed(host_of(url), path_of(url)).isNull()).select("url").distinct()
             .select("url", tokens(url).alias("_tokens")).select("url", "_tokens", F.explode("_tokens").alias("key")))
    held = open_.join(index, "key").where(F.size(F.array_except("items", "_tokens")) == 0)
    best = held.groupBy(F.col("url").alias("_url")).agg(F.max(F.struct("confidence", "support", "items")).alias("_m"))
    out = rows.join(best, F.col("url") == F.col("_url"), "left")
    rule = fixed(host_of(url), path_of(url))
    return out.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], F.when(F.col("_m").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(rule.isNull(), F.array_join(F.col("_m.items"), " ")).alias("mined"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages, listed(learn(marked(pages))))
