"""Weak supervision on planted spans with known truth: precision, recall, reliabilities."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapflow.llm import pii


def check_digit(stem):
    return next(d for d in "0123456789" if sum(
        (int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c)) for i, c in enumerate(reversed(stem + d))) % 10 == 0)


def card(rng):
    stem = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return stem + check_digit(stem)


def iban(rng, good):
    """A German iban, or one with a wrong check, a wrong length or no known country."""
    body = "".join(rng.choice("0123456789") for _ in range(18))
    n = 98 - int(body + "131400") % 97
    if not good:
        body = body[:rng.choice([14, 18])]
        n = (n + 40) % 90 + 2
    raw = f"{'DE' if good else rng.choice(['DE', 'ZZ'])}{n:02d}{body}"
    return " ".join(raw[i: i + 4] for i in range(0, len(raw), 4))


def planted(rng):
    """(kind, text before, span, text after, true) of every kind."""
    given, names = ["John", "Maria", "Peter", "Alice"], ["Okafor", "Lindqvist", "Moreau", "Tanaka"]
    d4 = lambda: f"{rng.randrange(1000, 9999)}"
    pair = card(rng)
    cue = lambda words: words if rng.random() < 0.75 else "so it says "
    four = " ".join(pair[i: i + 4] for i in range(0, 16, 4))
    return [
        ("iban", cue("pay to the bank account "), iban(rng, True), rng.choice([" by transfer", " by friday"]), True),
        ("iban", cue("the part number is "), iban(rng, False), " in the list", False),
        ("ssn", cue("her social security number is "), f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{d4()}",
         rng.choice([" of the patient", " on file"]), True),
        ("ssn", cue("the serial of this model "), f"9{rng.randrange(10, 99)} {rng.randrange(10, 99)}-{d4()}", " is blank", False),
        ("street", cue("they live at "), f"{rng.randrange(1, 999)} {rng.choice(names)} {rng.choice(['Street', 'Avenue', 'Lane'])}",
         ", Springfield and more", True),
        ("street", cue("as seen in chapter "), f"{rng.randrange(1900, 2020)} {rng.choice(['March', 'October'])} {rng.choice(names)}",
         " table of it", False),
        ("person", "we met Dr. ", f"{rng.choice(given)} {rng.choice(names)}", " said nothing", True),
        ("person", "please contact ", rng.choice(["Customer Support", "Sales", "Support"]), " for the release", False),
        ("card_grouped", "the card was " + four + " ", four, " and paid", True),
        ("email_spelled", "write me an email to ", f"{rng.choice(given).lower()}.x (at) gmail (dot) com", " today", True),
    ]


@pytest.fixture(scope="module")
def planted_docs(spark):
    rng, rows, truth = random.Random(9), [], {}
    for i in range(120):
        for kind, before, span, after, true in planted(rng):
            rows.append((len(rows), before + span + after))
            truth[len(rows) - 1] = (kind, len(before), len(before) + len(span), true)
    return spark.createDataFrame(rows, "doc_id long, text string"), truth


def test_precision_and_recall_by_kind(planted_docs):
    docs, truth = planted_docs
    added = {r.doc_id: r.added for r in pii.find(docs).select("doc_id", "added").collect()}
    right, wrong, missed = defaultdict(int), defaultdict(int), defaultdict(int)
    for doc, (kind, s, e, true) in truth.items():
        name = f"{kind}:{s}:{e}"
        if true:
            (right if name in added[doc] else missed)[kind] += 1
        elif name in added[doc]:
            wrong[kind] += 1
    for kind in pii.WEAK[:-1]:
        assert right[kind] >= 0.95 * (right[kind] + missed[kind]), (kind, right, missed)
        assert wrong[kind] <= 0.05 * right[kind], (kind, right, wrong)


def test_reliabilities(planted_docs):
    """Estimated vote shares of every labeler lie within 0.1 of those on the truth."""
    docs, truth = planted_docs
    got = pii.candidates(docs).select("doc_id", F.explode("judged").alias("x")).select("doc_id", "x.*").collect()
    for kind in ("iban", "ssn", "street", "person"):
        k = pii.KINDS.index(kind)
        seen = [(r, truth[r.doc_id][3]) for r in got if r.f_kind == k and truth[r.doc_id][0] == kind]
        votes = np.array([[r[f] for f in pii.LABELERS] for r, _ in seen])
        true = np.array([t for _, t in seen])
        post, shares, prior = pii.expectation_maximisation(
            votes, np.ones(len(votes)), 1 / (1 + np.exp(-2.0 * votes.sum(axis=1) + 1.0)))
        assert abs(prior - true.mean()) < 0.1
        for side in (0, 1):
            for j in range(len(pii.LABELERS)):
                for v in range(3):
                    assert abs(shares[side, j, v] - (votes[true == side, j] == v - 1).mean()) < 0.1, (kind, side, j, v)
        assert sum(len(set(votes[:, j])) > 1 for j in range(len(pii.LABELERS))) >= 4
