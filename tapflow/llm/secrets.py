"""Operator 7, secret scans by sliding-window entropy (native).

Base spans (assign, access, hex) are found by the contract's patterns and
always stay.  Candidate strings (long runs of token characters) are judged by
the Shannon entropy of a sliding window:

* A candidate belongs to the narrowest character class that holds all its
  characters (hex, upper-case and digits, base64); each class has a window
  length and a threshold in bits.
* The window's counts are kept incrementally: a step takes one character out
  and one in, and changes ``sum(c log2 c)`` by the difference of two table
  entries; the entropy is ``log2(w) - sum(c log2 c) / w``.
* An allow list suppresses candidates that look random and are not secret:
  words of letters only, UUIDs, file names and paths, digit groups, runs of
  one pattern, and placeholders such as ``EXAMPLE``.

Accepted candidates that overlap no base span are added as kind ``entropy``.
Everything is a column expression: no Python runs on the executors.

Scale: one scan, no shuffle; nothing but one document's text is held.

Defined cases: null and empty texts have no span; very long texts and
candidates are read whole, in time that grows with their length; repeated rows are judged alike; ids may be null or
repeated; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .spans import SPAN, spans
from .tables import table

BASE = ("assign", "access", "hex")
ADDED = "entropy"

# The contract's patterns: keywords in either case; runs are possessive.
ASSIGN = (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
          r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]++)")
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{24,}+"
#: Candidate strings: at least 20 token characters, tried from the first one on.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"

ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Class: (pattern of the whole candidate, window, entropy in bits asked for).
CLASSES = {"hex": ("^[0-9a-f]+$|^[0-9A-F]+$", 16, 2.9), "upper": ("^[0-9A-Z]+$", 16, 3.2),
           "base64": ("^[A-Za-z0-9+/_=-]+$", 20, 3.6)}
ALLOWED = (r"^[A-Za-z_-]+$|^[0-9_=-]+$|^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
           r"|EXAMPLE|example|^(.{1,4})\1++$|^/?[a-z0-9_-]++(?:/[a-z0-9_-]++)++/?$")

_TOP = max(w for _, w, _ in CLASSES.values())
_CLOGC = [0.0] + [c * math.log2(c) for c in range(1, _TOP + 2)]


def window_entropy(token: Column, window: Column) -> Column:
    """The highest entropy (bits per character) of any window of ``window``
    characters of ``token``; of the whole token if it is shorter.

    A fold over pairs of the character that enters and the one that leaves; its
    state is the window's counts, their ``sum(c log2 c)`` and the best so far, so
    the time grows with the token's length and nothing else."""
    table_ = F.array(*[F.lit(x) for x in _CLOGC])
    bound = F.struct(F.transform(F.split(token, ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1).alias("code"),
                     F.least(window, F.length(token)).alias("w"))

    def of(v: Column) -> Column:
        w = v["w"]
        left = F.slice(F.concat(F.array_repeat(F.lit(-1), w), v["code"]), F.lit(1), F.size(v["code"]))
        pairs = F.zip_with(v["code"], left, lambda new, old: F.struct(new.alias("new"), old.alias("old")))
        zero = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("n"), F.lit(0).alias("i"),
                        F.lit(0.0).alias("s"), F.lit(0.0).alias("best"))

        def step(acc: Column, pair: Column) -> Column:
            new, old = pair["new"], pair["old"]
            c_old = F.get(acc["n"], old)
            s_left = F.when(old >= 0, acc["s"] - F.get(table_, c_old) + F.get(table_, c_old - 1)).otherwise(acc["s"])
            c_new = F.get(acc["n"], new) - F.when(old == new, 1).otherwise(0)
            s = s_left - F.get(table_, c_new) + F.get(table_, c_new + 1)
            counts = F.transform(acc["n"], lambda c, k: F.when((k == new) & (k != old), c + 1)
                                 .when((k == old) & (k != new), c - 1).otherwise(c))
            return F.struct(counts.alias("n"), (acc["i"] + 1).alias("i"), s.alias("s"), acc["best"].alias("best"))

        def judged(acc: Column, pair: Column) -> Column:
            # bound once: the sum is used twice
            return F.transform(F.array(step(acc, pair)), lambda x: F.struct(
                x["n"].alias("n"), x["i"].alias("i"), x["s"].alias("s"),
                F.when(x["i"] >= w, F.greatest(x["best"], F.log2(w.cast("double")) - x["s"] / w))
                .otherwise(x["best"]).alias("best")))[0]

        return F.aggregate(pairs, zero, judged, lambda acc: acc["best"])

    return F.transform(F.array(bound), of)[0]


def _secret(x: Column) -> Column:
    m = x["m"]
    window = F.lit(CLASSES["base64"][1])
    asked = F.lit(CLASSES["base64"][2])
    for pattern, w, bits in reversed(list(CLASSES.values())[:-1]):
        window = F.when(m.rlike(pattern), w).otherwise(window)
        asked = F.when(m.rlike(pattern), bits).otherwise(asked)
    return ~m.rlike(ALLOWED) & (window_entropy(m, window) >= asked)


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the three base span lists, and ``entropy``."""
    text = F.col("text")
    empty = F.array().cast(SPAN)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns({
        "assign": F.filter(spans(text, ASSIGN, text.rlike("[:=]")), lambda x: F.length(
            F.regexp_extract(x["m"], "[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)$", 1)) >= 6),
        "access": F.filter(spans(text, ACCESS, F.contains(text, F.lit("AKIA"))), lambda x: F.length(x["m"]) >= 20),
        "hex": spans(text, HEX, text.rlike("[0-9a-f]{24}")),
        "_candidates": spans(text, CANDIDATE, text.rlike("[A-Za-z0-9+/_=-]{20}")),
    }).drop("text")
    found = found.select("doc_id", *[F.coalesce(k, empty).alias(k) for k in (*BASE, "_candidates")])
    every = F.concat(*[F.col(k) for k in BASE])
    free = F.transform(F.array(every), lambda base: F.filter("_candidates", lambda x: ~F.exists(
        base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))))[0]
    return found.select("doc_id", *BASE, F.filter(free, _secret).alias(ADDED))


def _said(kind: str) -> Column:
    return F.transform(F.col(kind), lambda x: F.struct(
        x["s"].alias("s"), F.lit((*BASE, ADDED).index(kind)).alias("k"),
        F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")).alias("t")))


def _joined(*kinds: str) -> Column:
    ordered = F.array_sort(F.concat(*[_said(k) for k in kinds]))
    return F.array_join(F.transform(ordered, lambda x: x["t"]), ",")


def op7_entropy_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents")).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(*BASE), 256).alias("base_sha256"), _joined(*BASE, ADDED).alias("spans"))
