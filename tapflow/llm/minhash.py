"""Operator 3, MinHash near-dedup with SuperMinHash signatures.

A document's set is its distinct ``k``-word shingles (``A-Z`` lower-cased; a
shorter text is one shingle, an empty one has none).  Documents are linked
when ``100 * intersection >= threshold * union`` of their full sets.

* Documents with equal sets form one class; its smallest id represents it.
* SuperMinHash: step ``j`` gives every shingle the ``j``-th slot of a
  pseudorandom permutation of its own and the value ``j + r``.  Slots filled
  in an earlier step are final, so a document stops as soon as all its slots
  are filled (long ones after one or two steps).  Values of one shingle never
  share a slot, which lowers the variance of the estimate.
* Banding: ``BANDS`` keys of ``ROWS`` slots; at similarity 0.8 a pair shares no
  key with probability 5e-8.
* Verification in two passes, on full sets recomputed from the texts.  First
  every member of a bucket against the bucket's smallest id, its leader: most
  groups are connected by that alone, with one pair per member instead of all
  pairs.  Then, where a leader's partners still belong to several components,
  all pairs of them from different components, tile by tile inside the tasks,
  which return links between components only.
* Union-find grouping by ``components``.

Scale: texts are shuffled once per verification pass and reduced to sets in
the tasks; the band keys are all that is kept per document.  A leader with many
partners is split over salted groups, each with a copy of its text; in the
second pass its partners are split into pairs of tiles.

Defined cases: null and empty texts have no shingle and link with nothing;
rows with one id are one document (they stay or go together); a null id links
with nothing and is kept; repeated texts are one class; very long texts are
read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import cut, key_groups, table, tile_pairs
from .textkernel import Words, chunks, mix64, shingle_sets

BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
#: Partners that one copy of a leader's text serves; partners per tile.
PARTNERS, TILE = 256, 256
#: Shingles that are multiplied at once when a tile's sets are intersected.
COLUMNS = 4096


def signatures(value: np.ndarray, bounds: np.ndarray, m: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures (rows, m) of sets of 64-bit values: the step in
    the top 8 bits of each entry, 24 bits of the value below."""
    rows = len(bounds) - 1
    sig = np.full(rows * m, 0xFFFFFFFF, dtype=np.uint32)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    live = np.arange(len(value))
    perm = None
    for j in range(m):
        if not len(live):
            break
        rnd = mix64(value[live] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pick = (j + (rnd & np.uint64(0xFFFFFFFF)) % np.uint64(m - j)).astype(np.int64)
        if j == 0:
            slot = pick
        else:
            if perm is None:  # the state after step 0: identity with one swap
                perm = np.tile(np.arange(m, dtype=np.uint8), (len(live), 1))
                perm[np.arange(len(live)), first[live]] = 0
            at = np.arange(len(live))
            slot = perm[at, pick].astype(np.int64)
            perm[at, pick] = perm[at, j]
        entry = (rnd >> np.uint64(40)).astype(np.uint32) | np.uint32(j << 24)
        np.minimum.at(sig, row[live] * m + slot, entry)
        open_ = (sig.reshape(rows, m) == 0xFFFFFFFF).any(axis=1)
        keep = open_[row[live]]
        if j == 0:
            first = pick
        elif perm is not None and not keep.all():
            perm = perm[keep]
        live = live[keep]
    return sig.reshape(rows, m)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, BANDS) 64-bit keys of the signatures' bands."""
    part = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0xA24BAED4963EE407)
    for i in range(ROWS):
        key = mix64(key ^ part[:, :, i])
    return key


def _sign(k: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in chunks(b):
                words = Words(c.column(1))
                value, bounds = shingle_sets(words, words.hashes(lower=True), k)
                n = np.diff(bounds)
                ends = [np.concatenate([[np.uint64(0)], np.cumsum(mix64(value ^ np.uint64(x)))])
                        for x in (1, 2)]
                k1, k2 = ((e[bounds[1:]] - e[bounds[:-1]]).view(np.int64) for e in ends)
                sig = signatures(value, bounds)
                keys = band_keys(sig).view(np.int64)
                full = n > 0
                offs = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [c.column(0), pa.array(n.astype(np.int64)), pa.array(k1), pa.array(k2),
                     pa.ListArray.from_arrays(pa.array(offs), pa.array(keys[full].ravel()))],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands"])
    return sign


def _confirm(k: int, threshold: int):
    """Rows (a, salt, role, doc, text) sorted by the first three: role 0 holds
    the leader's text, role 1 a partner's."""
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader_of, leaders = None, []
        for b in batches:
            for c in chunks(b):
                words = Words(c.column(4))
                value, bounds = shingle_sets(words, words.hashes(lower=True), k)
                a, salt, role, doc = (c.column(i).to_numpy() for i in range(4))
                found = []
                for i in range(c.num_rows):
                    own = value[bounds[i]: bounds[i + 1]]
                    if leader_of != (a[i], salt[i]):
                        leader_of, leaders = (a[i], salt[i]), []
                    if role[i] == 0:
                        leaders.append(own.copy())
                        continue
                    for lead in leaders:
                        at = np.minimum(np.searchsorted(lead, own), max(len(lead) - 1, 0))
                        both = int((lead[at] == own).sum()) if len(lead) and len(own) else 0
                        if both and 100 * both >= threshold * (len(lead) + len(own) - both):
                            found.append(i)
                            break
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(a[found]), pa.array(doc[found])],
                                                     names=["a", "b"])
    return confirm


def confirmed(pairs: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """The ``pairs`` (a, b) whose documents' full sets reach the threshold."""
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("long").alias("_n"))
    salted = pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("_n")))
    rows = (salted.select("a", "salt", F.lit(1).alias("role"), F.col("b").alias("doc"))
            .union(salted.select("a", "salt", F.lit(0), "a").distinct()))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where("doc is not null")
    return (rows.join(texts, "doc").select("a", "salt", "role", "doc", "text")
            .repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
            .mapInArrow(_confirm(k, threshold), "a long, b long"))


def shared_counts(value: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    _, code, times = np.unique(value, return_inverse=True, return_counts=True)
    several = times[code] > 1  # what one set alone holds is in no intersection
    row, code = row[several], np.unique(code[several], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for low in range(0, int(code.max(initial=-1)) + 1, COLUMNS):
        at = slice(*np.searchsorted(code, [low, low + COLUMNS]))
        held = np.zeros((len(bounds) - 1, COLUMNS), dtype=np.float32)
        held[row[at], code[at] - low] = 1
        out += held[left] @ held[right].T
    return out.astype(np.int64)


def _merge(k: int, threshold: int):
    """Rows (a, _lo, _hi, _tile, lab, text) of tile pairs -> links between the
    components ``lab`` that a pair of their texts joins."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_groups(batches, 3):
            lo, hi = group.column("_lo")[0].as_py(), group.column("_hi")[0].as_py()
            tile, lab = group.column("_tile").to_numpy(), group.column("lab").to_numpy()
            if (lab == lab[0]).all():
                continue
            sets = [shingle_sets(w, w.hashes(lower=True), k) for c in group.to_batches()
                    for w in [Words(c.column(5))]]
            value = np.concatenate([v for v, _ in sets])
            size = np.concatenate([np.diff(b) for _, b in sets])
            left, right = np.flatnonzero(tile == lo), np.flatnonzero(tile == hi)
            both = shared_counts(value, np.concatenate([[0], np.cumsum(size)]), left, right)
            either = size[left][:, None] + size[right][None, :] - both
            near = (100 * both >= threshold * either) & (lab[left][:, None] != lab[right][None, :])
            pairs = np.unique(np.stack([np.minimum(lab[left][:, None], lab[right][None, :])[near],
                                        np.maximum(lab[left][:, None], lab[right][None, :])[near]], axis=1), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
    return merge


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles (set size), component_id
    (smallest id reachable over links), kept (doc_id = component_id)."""
    signed = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sign(k), "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"))
    classes = cut(signed.where("n_shingles > 0 and doc_id is not null").groupBy(
        "k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep")))
    # a document id with several texts represents several classes
    reps = cut(signed.join(classes, (F.col("doc_id") == F.col("rep")) & (
        signed.k1 == classes.k1) & (signed.k2 == classes.k2), "left_semi").select(
            F.col("doc_id").alias("rep"), "bands"))
    keys = reps.select(F.explode("bands").alias("key"), "rep")
    shared = keys.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("_last")).where("a < _last")
    pairs = cut(keys.join(shared, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct())
    links = cut(confirmed(pairs, docs, k, threshold))
    found = components(links)
    # partners of one leader that are still in several components
    partners = pairs.join(found, F.col("b") == F.col("node"), "left").select(
        "a", "b", F.coalesce("component", "b").alias("lab"))
    split = partners.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("lab").alias("lo"),
                                      F.max("lab").alias("hi")).where("lo < hi").select("a", "n")
    open_ = partners.join(split, "a")
    texts = docs.select(F.col("doc_id").cast("long").alias("b"), "text").where("b is not null")
    late = cut(tile_pairs(open_, ["a"], F.col("n"), F.col("b"), TILE).join(texts, "b")
               .select("a", "_lo", "_hi", "_tile", "lab", "text")
               .repartition("a", "_lo", "_hi").sortWithinPartitions("a", "_lo", "_hi")
               .mapInArrow(_merge(k, threshold), "a long, b long"))
    if not late.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(late))
    placed = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    # rows of one id stay together: an id takes the smallest component of its texts
    out = signed.select("doc_id", "n_shingles", "k1", "k2").join(
        placed, ["k1", "k2", "n_shingles"], "left").select(
            "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(
                "component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, whose document represents its group."""
    gone = near_duplicates(docs, k, threshold).where("not kept").select("doc_id").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.join(gone, "doc_id", "left_anti").select("_row.*")


def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, threshold=80)


#: Plain form: every pair that shares a shingle, compared on full sets.
ORACLE = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM worded),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM common c JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c.n >= 80 * (p.n + q.n - c.n)),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
component AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component c ON d.doc_id = c.x LEFT JOIN size s ON s.doc_id = d.doc_id
"""
