"""Vectorised text helpers that run inside Arrow tasks.

One Arrow column of texts is handled as one byte buffer: word bounds, word
hashes and shingle hashes of all its rows come from a few numpy passes, with
no Python loop over words.  A word is a maximal run of bytes other than
``0x20`` and ``0x09-0x0D`` (the contract's ``[^\\x20\\x09-\\x0D]+``; UTF-8
continuation bytes never fall in that range, so bytes and characters agree).

Null texts count as empty.  ``chunks`` bounds the memory of a task: a batch is
processed in slices of at most ``CHUNK_BYTES`` bytes of text (or one row, when
a single text is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; the numpy temporaries take about 40 times that.
CHUNK_BYTES = 2_000_000

_SEED = 20240611
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUE = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER_VALUE = _BYTE_VALUE.copy()
_LOWER_VALUE[65:91] = _BYTE_VALUE[97:123]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        _powers[name] = have = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes as uint8, and row offsets (n + 1) into them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type):
        col = col.fill_null(b"").cast(pa.large_binary())
    else:
        col = col.fill_null("").cast(pa.large_string())
    _, off, data = col.buffers()
    offs = np.frombuffer(off, dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    if data is None or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offs[0]: offs[-1]], offs - offs[0]


def chunks(batch: pa.RecordBatch, text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose ``text`` bytes stay within ``limit`` (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    _, offs = text_bytes(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < n:
        stop = int(np.searchsorted(offs, offs[start] + limit, side="right")) - 1
        stop = min(n, max(start + 1, stop))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """Word bounds of a slice of texts.

    ``starts``/``ends``: byte bounds of every word; ``first``: index of each
    row's first word (n + 1 entries); ``row``: each word's row.
    """

    def __init__(self, col: pa.Array):
        self.buf, self.offs = text_bytes(col)
        n = len(self.buf)
        word = ~IS_SPACE[self.buf]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0] = False
            before[1:] = word[:-1]
            after[-1] = False
            after[:-1] = word[1:]
            inner = self.offs[1:-1]
            inner = inner[(inner > 0) & (inner < n)]
            before[inner] = False
            after[inner - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offs)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of every word's bytes (``lower``: A-Z as a-z)."""
        n = len(self.buf)
        table = _LOWER_VALUE if lower else _BYTE_VALUE
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[self.buf] * _power("up", _BASE, n), out=total[1:])
        value = (total[self.ends] - total[self.starts]) * _power("down", _BASE_INV, n + 1)[self.starts]
        return mix64(value + (self.ends - self.starts).astype(np.uint64))


def runs_of(words: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each word on, and a mask of the words that
    have ``k`` words left in their row."""
    n = len(hashes)
    out = np.zeros(n, dtype=np.uint64)
    if n >= k:
        acc = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            acc = acc * np.uint64(0xD6E8FEB86659FD93) + hashes[j: n - k + 1 + j]
        out[: n - k + 1] = mix64(acc)
    left = words.first[words.row + 1] - np.arange(n)
    return out, left >= k


def shingle_sets(words: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``k``-word shingle hashes of every row, sorted within the
    row, and row offsets into them.  A row with fewer words has its whole word
    sequence as its one shingle; a row without words has none."""
    rows = len(words.counts)
    run, full = runs_of(words, hashes, k)
    value, row = run[full], words.row[full]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for i, r in enumerate(short):
            acc = np.uint64(words.counts[r])
            with np.errstate(over="ignore"):
                for h in hashes[words.first[r]: words.first[r + 1]]:
                    acc = acc * np.uint64(0xD6E8FEB86659FD93) + h
            extra[i] = acc
        value = np.concatenate([value, mix64(extra)])
        row = np.concatenate([row, short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    if len(value):
        new = np.empty(len(value), bool)
        new[0] = True
        new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
        value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(rows + 1))


def sequence_hashes(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of every row's whole word sequence."""
    place = (np.arange(len(hashes)) - words.first[words.row]).astype(np.uint64)
    out = []
    for odd in (0xD1B54A32D192ED03, 0xAEF17502108EF2D9):
        total = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(mix64(hashes + mix64(place * np.uint64(odd) + np.uint64(odd))), out=total[1:])
        out.append(total[words.first[1:]] - total[words.first[:-1]])
    return out[0].view(np.int64), out[1].view(np.int64)


def minimizers(words: Words, hashes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of ``window`` consecutive words of one row: index of their
    first word, the smallest hash of the ``k``-word runs inside, and the index
    of the (first) run that has it."""
    run, _ = runs_of(words, hashes, k)
    n = len(hashes)
    left = words.first[words.row + 1] - np.arange(n)
    at = np.flatnonzero(left >= window)
    best, where = run[at], at.copy()
    for j in range(1, window - k + 1):
        other = run[at + j]
        less = other < best
        best = np.where(less, other, best)
        where = np.where(less, at + j, where)
    return at, best, where
