"""Operator 12 against a plain walk through all orders, document by document."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tapflow.llm import audit

GOOD = " ".join(f"w{i}" for i in range(210))
DOCS = [
    (1, GOOD, "x"), (2, GOOD, "x"), (3, GOOD, "y"), (2, GOOD, "x"), (4, None, None), (5, "", ""), (6, " \t\n", None),
    (7, "word " * 300, "x"), (8, "WORD " * 300, "x"), (9, GOOD + " $", "y"), (10, GOOD + " $", None),
    (None, GOOD, "x"), (None, GOOD, "x"), (None, None, None), (11, "a|b" * 100_000, "y"), (12, "A" * 500_000, "y"),
    (13, "é ü " * 250, "z"), (0, "late " * 5, "z"), (14, "late " * 5, "x"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (7, None, 1), (8, 0, 1), (9, 1, 1), (None, 1, 1), (99, 1, 1), (14, 1, 0)]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    clash = ["mask", "part", "n", "words", "text_key", "prefix", "good", "_id", "_key", "step", "letter"]
    return (docs.select("*", *[F.lit("own").alias(c) for c in clash]),
            spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))


def failing(doc_id, text):
    t = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", t)
    smaller = [d for d, other, _ in DOCS if d is not None and doc_id is not None and d < doc_id and (other or "") == t]
    tests = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
             "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": bool(smaller)}
    return {x for x, bad in tests.items() if bad}


def brute():
    facts = [(s or "", failing(d, t), any(x == d and q == 1 for x, q, _ in LABELS if x is not None),
              any(x == d and q == 1 for x, _, q in LABELS if x is not None)) for d, t, s in DOCS]
    out = {}
    shapley = {}
    for order in map("".join, permutations("ABCDE")):
        for part in {f[0] for f in facts}:
            left = [f for f in facts if f[0] == part]
            for i, x in enumerate(order):
                hit = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                own = [f for f in facts if f[0] == part and x in f[1]]
                out[part, order, i + 1] = (len(left), len(hit), len(own) - len(hit), sum(f[1] == {x} for f in own),
                                           sum(f[2] for f in hit), sum(f[3] for f in hit))
                shapley[part, x] = shapley.get((part, x), 0) + len(hit)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_every_order(tables):
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.audit(*tables).collect()}
    assert got == brute()


def test_types_and_empty_tables(tables):
    docs, labels = tables
    out = audit.audit(docs, labels)
    assert dict(out.dtypes) == {"part": "string", "filter_order": "string", "step": "int",
                                **{c: "bigint" for c in (*audit.COUNTS, "shapley")}}
    assert audit.audit(docs.limit(0), labels).count() == 0
    plain = audit.audit(docs, labels.limit(0))
    assert plain.agg(F.sum("good_lost"), F.sum("toxic_lost")).first()[:] == (0, 0)


def test_own_filters(tables):
    docs, labels = tables
    two = audit.audit(docs, labels, {"S": lambda text, words: F.length(text) < 3}, "D")
    assert sorted({(r.filter_order, r.step) for r in two.collect()}) == [("DS", 1), ("DS", 2), ("SD", 1), ("SD", 2)]
    with pytest.raises(ValueError):
        audit.audit(docs, labels, dict.fromkeys("ABCDFG", audit.FILTERS["A"]))


def test_recursion_has_every_prefix(spark):
    got = audit.steps(spark, "ABC").collect()
    assert len(got) == 8 * (3 + 6 + 6)
    assert {r.prefix for r in got} == {"".join(p) for k in (1, 2, 3) for p in permutations("ABC", k)}
    assert all(r.applied == r.before + r.bit for r in got)
