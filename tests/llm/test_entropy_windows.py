"""Operator 7's added spans against plain window entropies, and very long candidates."""

import math
import random
import re
import time

import pytest

from conftest import SF001
from tapflow.llm import pii, secrets

BASE = [(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[1]) >= 6),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]
ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def best_window(token, w):
    w = min(w, len(token))
    best = 0.0
    for i in range(len(token) - w + 1):
        part = token[i:i + w]
        best = max(best, math.log2(w) - sum(n * math.log2(n) for n in map(part.count, set(part))) / w)
    return best


def entropy_spans(text):
    base = [m.span() for p, ok in BASE for m in re.finditer(p, text) if ok(m)]
    out = []
    for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", text):
        t = m[0]
        if any(s < m.end() and m.start() < e for s, e in base):
            continue
        kind = next(k for k, (p, _, _) in secrets.CLASSES.items() if re.search(p, t))
        _, w, asked = secrets.CLASSES[kind]
        allowed = (re.fullmatch("[A-Za-z_-]+|[0-9_=-]+|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", t)
                   or "EXAMPLE" in t or "example" in t or any(t == t[:k] * (len(t) // k) for k in (1, 2, 3, 4))
                   or ("/" in t.strip("/") and re.fullmatch("/?[a-z0-9_-]+(/[a-z0-9_-]+)+/?", t)))
        if not allowed and best_window(t, w) >= asked - 1e-9:
            out.append(m.span())
    return out


def test_added_spans(spark):
    r = random.Random(4)
    docs = [x.text for x in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    docs += [" ".join("".join(r.choice(a) for _ in range(r.randint(18, 60))) for _ in range(40))
             for a in (ALNUM, "0123456789ABCDEF", "0123456789abcdef-", "abcXYZ012+/_=", ALNUM.upper(), "ab/cd/0") for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {x.doc_id: [(s.s, s.e) for s in x.entropy] for x in secrets.find(df).collect()}
    want = {i: entropy_spans(t or "") for i, t in enumerate(docs)}
    assert got == want
    assert sum(map(len, want.values())) > 100


def random_token(alphabet, n, seed=5):
    r = random.Random(seed)
    return "".join(r.choice(alphabet) for _ in range(n))


PARTS = "/".join(f"part{i}" for i in range(100_000))
LONG = {"path": (PARTS, False), "Path": (PARTS.replace("p", "P"), False), "dots": (PARTS.replace("/", "."), False),
        "hex": (random_token("0123ABCDEF", 1_000_000), True), "upper": (random_token(ALNUM[26:], 1_000_000), True),
        "base64": (random_token(ALNUM + "+/", 1_000_000), True), "words": (random_token("abc_", 1_000_000), False),
        "digits": (random_token("0123456789", 1_000_000), False), "one": ("aB1" * 300_000, False), "slashes": ("/" * 1_000_000, False),
        "mail": ("a" * 500_000 + "@" + "b." * 200_000 + "c", False)}


def test_very_long_candidates(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in LONG.items()], "k string, text string").selectExpr(
        "cast(hash(k) as long) AS doc_id", "text")
    ids = {r[0]: r[1] for r in spark.createDataFrame([(k,) for k in LONG], "k string").selectExpr("cast(hash(k) as long)", "k").collect()}
    got = {ids[r.doc_id]: [(s.s, s.e) for s in r.entropy] for r in secrets.find(df).collect()}
    whole = {k: [(0, len(t))] if secret else [] for k, (t, secret) in LONG.items()}
    assert {k: got[k] for k in ("hex", "upper", "base64", "words", "digits", "one", "path", "slashes")} == {
        k: whole[k] for k in ("hex", "upper", "base64", "words", "digits", "one", "path", "slashes")}
    spans = {ids[r.doc_id]: r.email for r in pii.find(df).select("doc_id", "email").collect()}
    assert [(s.s, s.e) for s in spans["mail"]] == [(0, 900_002)]


def test_time_grows_with_length(spark):
    def took(n):
        df = spark.createDataFrame([(1, random_token(ALNUM, n))], "doc_id long, text string")
        secrets.find(df).collect()
        best = math.inf
        for _ in range(2):
            start = time.perf_counter()
            assert [(s.s, s.e) for s in secrets.find(df).first().entropy] == [(0, n)]
            best = min(best, time.perf_counter() - start)
        return best

    short, long = took(2_000), took(200_000)
    assert long < 100 * max(short, 0.5)


@pytest.mark.parametrize("window", [5, 16, 20])
def test_window_entropy(spark, window):
    from pyspark.sql import functions as F
    tokens = [random_token("ab01", n, n) for n in (1, 2, window - 1, window, window + 1, 60)]
    df = spark.createDataFrame([(t,) for t in tokens], "t string")
    got = [r.h for r in df.select(secrets.window_entropy(F.col("t"), F.lit(window)).alias("h")).collect()]
    assert got == pytest.approx([best_window(t, window) for t in tokens])
