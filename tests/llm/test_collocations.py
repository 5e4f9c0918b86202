"""Operator 13 against counted strings, on small and large budgets."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tapflow.llm import collocations

LOWER = {i: i + 32 for i in range(65, 91)}
HOT = "New York city, new york state; the the the the. of the day " * 40
DOCS = [
    (HOT, "en"), (HOT, "en"), (HOT, None), (HOT, "und"), (None, "en"), ("", None), (" \t\r\n", "de"),
    ("a b\tc d\x0be f! a b c. " * 30, "de"), ("ÄÖ É ÄÖ É x " * 60, "fr"), ("word " * 5_000, "xx"),
    ("one two three one two three " * 12, ""), ("x" * 300_000 + " y z " + "p q " * 200_000, "long"),
    ("tie one, tie two, " * 15, "ties"), ("zeta one, zeta two, " * 15, "ties"),
]


def brute(rows, min_count=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(zip(*[w[i:] for i in range(k)]))
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= min_count}
        hidden = {p[i:i + 2] for p, c in often.items() if len(p) == 3 for i in (0, 1) if 100 * c >= 50 * counts[p[i:i + 2]]}
        scored = []
        for p, a in often.items():
            if len(p) > 1 and p not in hidden:
                s, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def docs(spark):
    clash = ["h1", "h2", "h3", "a", "n", "k1", "word", "rank", "role", "_p", "g", "score"]
    return spark.createDataFrame(DOCS, "text string, lang string").select("*", *[F.lit("own").alias(c) for c in clash])


@pytest.mark.parametrize("budget", [collocations.BUDGET, 400, 30])
def test_small_table(docs, budget):
    """30: words and pairs of words are over budget, so prefixes of all lengths occur."""
    got = sorted(tuple(r) for r in collocations.collocations(docs, budget=budget).collect())
    assert got == brute(DOCS)
    assert len({r[0] for r in got}) > 5


def test_types_top_and_empty(docs):
    out = collocations.collocations(docs, min_count=5, top=3)
    assert out.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"),
                          ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]
    assert sorted(tuple(r) for r in out.collect()) == brute(DOCS, 5, 3)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_budgets_agree_on_documents(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    want = sorted(tuple(r) for r in collocations.collocations(docs).collect())
    assert want == brute([(r.text, r.lang) for r in docs.collect()])
    assert sorted(tuple(r) for r in collocations.collocations(docs, budget=100).collect()) == want


def test_slices_end_at_pieces():
    """Any slice length gives the same words and pieces."""
    batch = pa.RecordBatch.from_pydict({"text": pa.array([t for t, _ in DOCS[:11]]), "lang": pa.array([g for _, g in DOCS[:11]])})

    def phrases(limit):
        seen = Counter()
        for s in collocations.slices(batch, 1, limit):
            same = s.piece[1:] == s.piece[:-1]
            seen.update(zip(s.key[:-1][same].tolist(), s.key[1:][same].tolist()))
        return seen

    whole = phrases(1 << 30)
    assert sum(whole.values()) > 5_000
    assert all(phrases(limit) == whole for limit in (1, 7, 100, 5_000))


def test_scores_are_exact(spark):
    values = [(10**15 - 1, 10**15, 10**16 - 1), (10, 10, 10), (3 * 10**9, 4 * 10**12, 10**13), (7, 9, 11)]
    df = spark.createDataFrame(values, "a long, l long, r long").select("*", collocations.score("a", "l", "r").alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in df.collect())


def test_bitmap_is_a_set(spark):
    keys = np.random.default_rng(3).integers(-2**62, 2**62, 3_000)
    bits = np.frombuffer(collocations.bitmap(spark.createDataFrame([(int(k),) for k in keys], "h long"), F.col("h")), np.uint8)
    assert collocations._held(bits, keys).all()
    assert collocations._held(bits, keys + 1).mean() < 0.01
