"""Operator 11, token counts with a whole-token shortcut.

A byte-level BPE tokenizer first splits a text by a pattern into pre-tokens, and
merges the bytes of each by itself.  Most pre-tokens of ordinary text are one
vocabulary entry, so their merges need not be run:

* *Offline proof* (``prove``, on the driver, once per tokenizer file).  Every
  vocabulary entry is decoded to its text and encoded alone by the tokenizer
  library; those that come back as one token, and pass the pre-tokenizer whole,
  are the shortcut set.
* *Counting* (``count_tokens``).  Tasks split texts by the pattern.  A pre-token in
  the shortcut set counts 1; each other one is merged by the library when it is
  first met, and remembered (at most ``CACHE`` at a time).
* The splitting pattern is held against the library too: a code point's class
  (letter, number, space, other) is compared when a task first meets it, as the two
  know different versions of Unicode.  Texts with a code point that differs, or with
  the string of an added token, are encoded whole by the library.

Scale: one scan, no shuffle; the set (at most the vocabulary) is broadcast, and a
task holds one batch of texts, the cache and ``BLOCK`` pre-tokens.

Defined cases: null and empty texts have 0 bytes and 0 tokens; very long texts
are read whole, in blocks of pre-tokens; repeated rows are counted alike; ids may
be null or repeated; an empty table gives no rows; other columns are ignored.
Only tokenizers of the stated kind are taken (no normalizer, byte-level pattern
without a prefix space, no template); others are refused by ``prove``.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .tables import table
from .textkernel import chunks

TOKENIZER = "byte_bpe_50k.json"
MAX_TOKENS = 512
#: Merged pre-tokens that a task remembers, and pre-tokens of one text held at once.
CACHE, BLOCK = 400_000, 100_000
#: The byte-level splitting pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Proof:
    """What was proved of a tokenizer file."""

    whole: frozenset[str]       # pre-tokens that are one token
    added: tuple[str, ...]      # strings of added tokens


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    ones for themselves, the others from U+0100 on in byte order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _known(spec: dict) -> bool:
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    return (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not spec.get("normalizer") and not spec.get("post_processor") and model["type"] == "BPE"
            and not model.get("dropout"))


def odd_points(tok: Tokenizer, pattern: regex.Pattern, points: list[str]) -> set[str]:
    """The code points that the library's splitter classes unlike the pattern: after a
    letter, a number and a mark, each class of a character splits in another way."""
    probe = "".join(f"a{c}1{c}!{c} " for c in points)
    ours, theirs = set(), set()
    ours.update(m.start() for m in pattern.finditer(probe))
    theirs.update(low for _, (low, _) in tok.pre_tokenizer.pre_tokenize_str(probe))
    return {points[at // 7] for at in ours ^ theirs}


_proofs: dict[str, Proof] = {}


def prove(path: str) -> Proof:
    """Encode every vocabulary entry alone, and compare the classes of all code points."""
    if path not in _proofs:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not _known(spec):
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        tok = Tokenizer.from_file(path)
        added = tuple(x["content"] for x in spec.get("added_tokens", []))
        byte = _byte_of()
        entries = []
        for entry in tok.get_vocab(with_added_tokens=False):
            try:
                entries.append(bytes(byte[c] for c in entry).decode())
            except (KeyError, UnicodeDecodeError):  # part of a character, or no byte string: never a pre-token
                continue
        pattern = regex.compile(PATTERN)
        odd = odd_points(tok, pattern, sorted(set("".join(entries))))
        if any(c.isascii() for c in odd):
            raise ValueError(f"{path}: its splitter classes ASCII characters in another way")
        codes = tok.encode_batch_fast(entries, add_special_tokens=False)
        whole = frozenset(e for e, c in zip(entries, codes)
                          if len(c.ids) == 1 and pattern.findall(e) == [e] and odd.isdisjoint(e))
        _proofs[path] = Proof(whole, added)
    return _proofs[path]


class Counter:
    """Tokens of texts: proved pre-tokens count 1, others are merged when first met."""

    def __init__(self, tok: Tokenizer, proof: Proof):
        self.tok, self.proof = tok, proof
        self.pattern = regex.compile(PATTERN)
        self.known = dict.fromkeys(proof.whole, 1)
        self.points: set[str] = set()   # code points whose class has been compared
        self.odd: set[str] = set()      # those that the pattern classes unlike the library
        self.strange: set[str] = set()  # known pre-tokens that hold an odd code point

    def meet(self, tokens: list[str]) -> None:
        """Merge those of ``tokens`` that are not known yet, in one call."""
        new = set(tokens).difference(self.known)
        if len(self.known) + len(new) > len(self.proof.whole) + CACHE:
            self.known = dict.fromkeys(self.proof.whole, 1)
            self.strange = set()
            new = set(tokens).difference(self.known)
        new = list(new)
        self.known.update(zip(new, map(len, self.tok.encode_batch_fast(new, add_special_tokens=False))))
        wide = [t for t in new if not t.isascii()]
        points = sorted(set("".join(wide)) - self.points)
        if points:
            self.points.update(points)
            self.odd |= odd_points(self.tok, self.pattern, points)
        if self.odd:
            self.strange.update(t for t in wide if not self.odd.isdisjoint(t))

    def _whole_text(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False))

    def long(self, text: str) -> int:
        """One text, in blocks of its pre-tokens."""
        total, found = 0, self.pattern.finditer(text)
        while tokens := [m[0] for m in islice(found, BLOCK)]:
            self.meet(tokens)
            if not self.strange.isdisjoint(tokens):
                return self._whole_text(text)
            total += sum(map(self.known.__getitem__, tokens))
        return total

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each of some texts, of about ``CHUNK_BYTES`` together or one text."""
        plain = [not any(a in t for a in self.proof.added) for t in texts]
        if len(texts) == 1 and plain[0]:
            return [self.long(texts[0])]
        split = [self.pattern.findall(t) if ok else [] for t, ok in zip(texts, plain)]
        self.meet([x for tokens in split for x in tokens])
        known = self.known.__getitem__
        return [self._whole_text(t) if not ok or (self.strange and not self.strange.isdisjoint(tokens)) else sum(map(known, tokens))
                for t, ok, tokens in zip(texts, plain, split)]


_counters: dict[str, Counter] = {}


def _counts(path: str, proof, max_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if path not in _counters:
            _counters[path] = Counter(Tokenizer.from_file(path), proof.value)
        for batch in batches:
            for part in chunks(batch):
                text = part.column(1).fill_null("")
                n = pa.array(_counters[path].count(text.to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pc.binary_length(text).cast(pa.int64()), n, pc.greater(n, max_tokens)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def count_tokens(docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens as the library encodes
    the text without special tokens added, over_limit (more than ``max_tokens``).
    ``path``: a tokenizer file that the driver and all executors can open."""
    proof = docs.sparkSession.sparkContext.broadcast(prove(path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_counts(path, proof, max_tokens), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
