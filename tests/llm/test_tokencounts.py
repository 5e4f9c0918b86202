"""Operator 11 against the tokenizer library on whole texts."""

import os

import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF0001
from tapflow.llm import tokencounts

PATH = public_tokenizers.path(tokencounts.TOKENIZER)
TEXTS = [
    None, "", " ", "   ", "\n\n\n", " \t x  \n  y ", "it's 'stuff' we'll ''s I'd'll 'S don't've", "a<|endoftext|>b <|endoftext|>",
    "  <|endoftext|>  tail", "<|endoftext", "x1y2 3.14 -- ... !!! $%& a_b", "Ünï ćödé 日本語 テスト ١٢٣ ½ ² Ⅷ", "   x　​ y﻿",
    "👩‍👩‍👧 🇩🇪 é ̀́", "꟎꟏ ՘ ₏౜ x", "a\x00b\x1c\x1d\x85c\x7f", "ｆｕｌｌ １２", "\U0002ebf0\U00031350\U000323af z",
    "word " * 60_000, "x" * 300_000, "1a" * 120_000, " " * 200_000 + "z", "é" * 3_000, "same text", "same text", "q" * 511 + " end",
    "hello " * 513, "hello" + " hello" * 511, "hello" + " hello" * 512,
]


@pytest.fixture(scope="module")
def tok():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i % 7 == 6 else i // 2, t) for i, t in enumerate(TEXTS)]
    clash = ["n_bytes", "n_tokens", "over_limit", "whole"]
    return spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("own").alias(c) for c in clash])


def expected(tok, rows, limit):
    out = []
    for d, t in rows:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        out.append((d, len((t or "").encode()), n, n > limit))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [512, 0])
def test_odd_texts(docs, tok, limit):
    got = tokencounts.count_tokens(docs, PATH, limit)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    want = expected(tok, [(r.doc_id, r.text) for r in docs.collect()], limit)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert tokencounts.count_tokens(docs.limit(0), PATH).count() == 0


def test_documents(spark, tok):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = sorted((tuple(r) for r in tokencounts.op11_token_counts(spark, SF0001).collect()), key=str)
    assert got == expected(tok, [(r.doc_id, r.text) for r in docs.collect()], 512)
    assert any(r[3] for r in got) and not all(r[3] for r in got)


def test_proof(tok):
    proof = tokencounts.prove(PATH)
    assert len(proof.whole) > 45_000
    assert all(len(tok.encode(x, add_special_tokens=False).ids) == 1 for x in sorted(proof.whole)[::50])
    assert "<|endoftext|>" in proof.added


def test_odd_points_are_found(tok):
    strict = regex.compile(r" ?[a-z]+| ?\p{N}+| ?[^\sa-z\p{N}]+|\s+(?!\S)|\s+")
    assert tokencounts.odd_points(tok, strict, list("aBé1 !")) == {"B", "é"}


def test_small_cache_and_blocks(tok, monkeypatch):
    """The cache is emptied again and again, and long texts are cut into blocks."""
    monkeypatch.setattr(tokencounts, "CACHE", 50)
    monkeypatch.setattr(tokencounts, "BLOCK", 7)
    counter = tokencounts.Counter(tok, tokencounts.prove(PATH))
    texts = [t or "" for t in TEXTS if len(t or "") < 5_000] + [f"unseen{i}wörd {i * 7919}" for i in range(400)]
    want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [counter.count([t])[0] for t in texts] == want
    assert [n for i in range(0, len(texts), 9) for n in counter.count(texts[i:i + 9])] == want


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        tokencounts.prove(public_tokenizers.path("word_bpe_49k.json"))
