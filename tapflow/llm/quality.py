"""Operator 9, quality classifier: histogram gradient-boosted trees.

Document statistics (``features``) are computed in Arrow batches; the trees
are boosted in numpy over binned values of a bounded, documented sample of
labelled rows (``MAX_TRAIN``: ids chosen by a hash, equal rows of an id once,
and at most an even share of rows for each id, by a hash), flattened into
arrays, and every document is scored by a vectorised walk of those arrays.
Only the text enters a score: not label, language, source or id.

Rows whose ``crc32(doc_id as text) mod 4`` is 2 are never learned from.

Scale: one pass over the texts scores them; the training rows come from a
broadcast join with at most about ``MAX_TRAIN`` ids, and are reduced to as many
rows on the executors.  No shuffle of texts, no state beyond one slice of a batch.

Defined cases: null text is the empty text, which has a score like any other;
a label that is null, or not 0 or 1, is ignored, and an id labelled several
times counts as its lowest label; without labels of both classes every score
is the mean label, or 1 with no label at all; very long texts are read whole;
repeated rows are scored alike; a null id is held out only if crc32 of the
empty text says so; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import table
from .textkernel import Words, chunks

#: Labelled rows that the trees are fitted on, about, at most.
MAX_TRAIN = 20_000
THRESHOLD = 0.7
TREES, DEPTH, BINS, RATE, L2, MIN_ROWS = 60, 4, 64, 0.2, 1.0, 8
HELD_OUT_FOLD, FOLDS = 2, 4

FEATURES = ("log_bytes", "words", "word_bytes", "upper", "digits", "sentence", "other_marks", "pipes",
            "bangs", "non_ascii", "lines", "spaces", "same_as_last", "distinct", "longest_word",
            "marked_words", "upper_words", "longest_run")

_CLASS = {
    "upper": list(range(65, 91)), "digits": list(range(48, 58)), "sentence": [*b".,;:?'\"()-"],
    "other_marks": [*b"#$%&*+/<=>@[\\]^_`{}~"], "pipes": [*b"|"], "bangs": [*b"!"],
    "non_ascii": list(range(128, 256)), "lines": [10], "spaces": [32, 9, 11, 12, 13],
}


def _table(values: list[int]) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[values] = 1
    return out


_TABLES = {k: _table(v) for k, v in _CLASS.items()}
_MARKS = _TABLES["other_marks"] + _TABLES["pipes"] + _TABLES["bangs"]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _most(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, dtype=np.int64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.maximum.reduceat(values, bounds[full])
    return out


def features(col: pa.Array) -> np.ndarray:
    """(rows, len(FEATURES)) statistics of texts; all ratios, so 0 for an empty one."""
    w = Words(col)
    n_bytes = np.diff(w.offs)
    n_words = w.counts
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    h = w.hashes()
    size = w.ends - w.starts
    same = np.zeros(len(h), dtype=np.int64)
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])
    order = np.lexsort((h, w.row))
    hs, rs = h[order], w.row[order]
    new = np.ones(len(h), dtype=np.int64)
    if len(h) > 1:
        new[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
    # the longest run of one word: distance between words that differ from the last
    starts = np.flatnonzero(same == 0)
    run = np.diff(np.append(starts, len(h)))
    run_bounds = np.searchsorted(starts, w.first)
    cum = {k: np.concatenate([[0], np.cumsum(t[w.buf])]) for k, t in
           (("marks", _MARKS), ("upper", _TABLES["upper"]))}
    marked = (cum["marks"][w.ends] - cum["marks"][w.starts] > 0).astype(np.int64)
    loud = (2 * (cum["upper"][w.ends] - cum["upper"][w.starts]) > size).astype(np.int64)
    out = {
        "log_bytes": np.log1p(n_bytes), "words": np.log1p(n_words),
        "word_bytes": _sums(size, w.first) / per_word,
        "same_as_last": _sums(same, w.first) / per_word,
        "distinct": _sums(new, w.first) / per_word, "longest_word": np.log1p(_most(size, w.first)),
        "marked_words": _sums(marked, w.first) / per_word,
        "upper_words": _sums(loud, w.first) / per_word, "longest_run": np.log1p(_most(run, run_bounds)),
    }
    for name, t in _TABLES.items():
        out[name] = _sums(t[w.buf], w.offs) / per_byte
    return np.stack([out[k] for k in FEATURES], axis=1)


@dataclass
class Model:
    """Complete binary trees of one depth as flat arrays: node ``i`` of a tree
    has children ``2 i + 1`` and ``2 i + 2``."""

    feature: np.ndarray    # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes): left if value <= threshold
    leaf: np.ndarray       # (trees, leaves)
    base: float
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        margin = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            margin += leaf[node - inner]
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Model:
    """Boost ``trees`` trees on the logistic loss over per-feature histograms."""
    none = np.zeros((0, 0))
    if len(y) == 0 or y.min() == y.max():
        return Model(none, none, none, 0.0, float(y.mean()) if len(y) else 1.0)
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            at = node - first
            best = np.full(width, 1e-9)
            for j in range(m):
                k = len(edges[j]) + 1
                if k == 1:
                    continue
                cell = at * k + binned[:, j]
                gs, hs, cs = (np.bincount(cell, v, width * k).reshape(width, k)
                              for v in (g, h, np.ones(n)))
                gl, hl, cl = (np.cumsum(v, axis=1)[:, :-1] for v in (gs, hs, cs))
                ga, ha, ca = (v.sum(axis=1, keepdims=True) for v in (gs, hs, cs))
                gain = gl ** 2 / (hl + L2) + (ga - gl) ** 2 / (ha - hl + L2) - ga ** 2 / (ha + L2)
                gain[(cl < MIN_ROWS) | (ca - cl < MIN_ROWS)] = 0
                cut = gain.argmax(axis=1)
                top = gain[np.arange(width), cut]
                better = np.flatnonzero(top > best)
                best[better] = top[better]
                feature[t, first + better] = j
                threshold[t, first + better] = edges[j][cut[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        end = node - inner
        gs, hs = np.bincount(end, g, leaves), np.bincount(end, h, leaves)
        leaf[t] = -RATE * gs / (hs + L2)
        margin += leaf[t, end]
    return Model(feature, threshold, leaf, base)


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on the labelled documents outside the held-out fold, at most about
    ``max_train`` of them by a hash of the id."""
    good = labels.where("quality in (0, 1) and doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("_y"))
    good = good.where(fold(F.col("_id")) != HELD_OUT_FOLD)
    share = min(1.0, max_train / max(1, good.count()))
    chosen = good.where(F.pmod(F.xxhash64(F.lit(3), "_id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                x = features(c.column(2))
                yield pa.RecordBatch.from_arrays(
                    [c.column(0), c.column(1), pa.array(list(x), pa.list_(pa.float64()))],
                    names=["id", "y", "x"])

    # equal rows of an id count once, and an id sends its even share of max_train rows
    # at most, by a hash: an id that many rows have weighs no more than that
    each = max(1, max_train // max(1, chosen.count()))
    by_hash = Window.partitionBy("id").orderBy(F.xxhash64(F.lit(5), "id", "x"), "x")
    rows = (docs.join(F.broadcast(chosen), F.col("doc_id").cast("long") == F.col("_id"))
            .select(F.col("_id"), F.col("_y").cast("int"), "text")
            .mapInArrow(stats, "id long, y int, x array<double>").distinct()
            .withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= each).drop("_n").toArrow())
    x = np.array(rows.column("x").to_pylist(), dtype=float).reshape(rows.num_rows, len(FEATURES))
    y, ids = (rows.column(k).to_numpy().astype(float) for k in ("y", "id"))
    order = np.lexsort((*x.T, y, ids))  # rows arrive in any order
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier), predicted (score >= 0.7)."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                s = model.score(features(c.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [c.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scored, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not reject."""
    at = docs.columns.index("text")

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                yield c.filter(pa.array(model.score(features(c.column(at))) >= THRESHOLD))

    return docs.mapInArrow(passed, docs.schema)


def op9_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "score", "predicted")
