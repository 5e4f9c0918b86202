"""Spans of regular expressions as columns, with built-in functions only.

Spark has no function that returns where a pattern matches; the places follow
from the pieces between the matches: ``split`` keeps them, and the lengths of
the pieces and matches before one add up to its start.  Positions count code
points, ends are exclusive.

All patterns here must not recurse in Java's matcher on long texts: repeated
groups are possessive, and a run is only tried from its first character.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:bigint,e:bigint,m:string,before:string,after:string>>"
#: Characters kept before and after a match, as its context.
CONTEXT = 40
#: Matches that are appended one by one before they are put together.
BLOCK = 256


def spans(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """The leftmost non-overlapping matches of ``pattern``: start, end, match and
    context.  Where ``gate`` is false the text is known to have none."""
    return F.when(gate if gate is not None else F.lit(True),
                  _spans(text, pattern)).otherwise(F.lit(None).cast(SPAN))


def _spans(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    none = F.array().cast(SPAN)
    # a fold over blocks of matches, and inside a fold over a block's matches: with
    # one fold alone, appending would copy all spans so far for every match
    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int"))
    zero = F.struct(pieces.alias("p"), found.alias("m"), F.lit(0).cast("long").alias("at"), none.alias("out"))

    def block(acc: Column, b: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), (b * BLOCK).cast("int").alias("i"), none.alias("out"))

        def step(own: Column, m: Column) -> Column:
            piece = F.get(acc["p"], own["i"])
            s = own["at"] + F.length(piece)
            span = F.struct(s.cast("long").alias("s"), (s + F.length(m)).cast("long").alias("e"),
                            m.alias("m"), F.right(piece, F.lit(CONTEXT)).alias("before"),
                            F.left(F.get(acc["p"], own["i"] + 1), F.lit(CONTEXT)).alias("after"))
            return F.struct((s + F.length(m)).cast("long").alias("at"), (own["i"] + 1).alias("i"),
                            F.concat(own["out"], F.array(span)).alias("out"))

        inner = F.aggregate(F.slice(acc["m"], b * BLOCK + 1, F.lit(BLOCK)), start, step)
        return F.transform(F.array(inner), lambda x: F.struct(
            acc["p"].alias("p"), acc["m"].alias("m"), x["at"].alias("at"),
            F.concat(acc["out"], x["out"]).alias("out")))[0]

    return F.when(F.size(found) > 0, F.aggregate(blocks, zero, block, lambda acc: acc["out"])).otherwise(none)
