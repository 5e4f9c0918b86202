"""Substring dedup against brute force, and that only the index removes words."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapflow.llm import substrings


def corpus():
    """Copies, long copies of several pieces, shared passages, near copies, one
    passage in most documents, windows that repeat inside one document."""
    rng = random.Random(4)

    def text(n):
        return [f"w{rng.randrange(400)}" for _ in range(n)]

    common, passages = text(20), [text(rng.randrange(13, 60)) for _ in range(8)]
    long = text(700)
    rows = [(1, long), (5, long), (9, long + ["tail"]), (12, ["head"] + long[100:500]), (13, text(12))]
    for i in range(20, 90):
        words = text(rng.randrange(0, 80))
        for part in rng.sample(passages, rng.randrange(0, 3)) + ([common] if i % 3 else []):
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        rows.append((i, words))
    rows += [(100 + i, rows[10 + i % 5][1]) for i in range(40)]
    rows.append((200, common * 3))
    rng.shuffle(rows)
    return [(d, " ".join(w)) for d, w in rows]


def brute(rows):
    first, out = {}, {}
    for d, t in rows:
        w = t.split()
        for i in range(len(w) - 12):
            k = tuple(w[i: i + 13])
            first[k] = min(d, first.get(k, d))
    for d, t in rows:
        w = t.split()
        gone = {i + j for i in range(len(w) - 12) if first[tuple(w[i: i + 13])] < d for j in range(13)}
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("hot", [2, substrings.HOT])
def test_as_brute_force(docs, rows, hot):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(docs, hot).collect()}
    assert got == brute(rows)


def test_only_the_index_removes(docs):
    """With an index that reports nothing every word stays, whatever the hashes group."""
    silent = substrings.without_repeats(docs, report=lambda index, words, bounds, doc, window: np.zeros(len(words), bool))
    assert silent.agg(F.sum("n_removed")).first()[0] == 0
