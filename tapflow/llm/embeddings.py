"""Operator 2, embedding near-dedup by a subspace pigeonhole join.

Unit vectors with cosine ``c`` are at squared distance ``2 - 2 c``.  Rotated
vectors are split into ``BLOCKS`` low-dimensional blocks, and the squared
budget ``T = 2 - 2 c`` is shared among the blocks in proportion to their
variance: two vectors within ``T`` are within the block's share in at least
one block, so a pair that exceeds its share in every block is dropped.

* Cells: sampled vectors are pivots; a vector's cell is its nearest pivot.  For
  ``x`` in the cell of ``p`` and ``y`` in that of ``q``, ``(x - y)(p - q)`` is at
  most ``sqrt(T) |p - q|`` if they are linked: only rows whose distances to the
  border between their cells add up to no more are compared.
* Verification: what is left is tested by its leading coordinates, then by the
  blocks' shares, and confirmed by the cosine in double precision.
* Links: every vector's links are counted, and its smallest neighbour group
  becomes one link per task, which is enough for the components.

Scale: equal vectors are one class, joined once.  Classes are packed by cell
into tiles of about ``TILE_BYTES`` (a large cell takes several), one row and partition
each, in the shared folder; a task reads a tile and one after the other some of
those that it meets from there.  So a vector is shuffled once after grouping,
whatever the number of cells, and no task holds a whole cell.  Links never leave
the tasks one by one.

Defined cases: vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing; vectors of different lengths never
link (each length is a join of its own); a null id links with nothing, is its
own and is kept; rows that share an id and a vector are each counted as a
vector; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import cut, single_rows, stored, table, written

COSINE = 0.95
BLOCKS = 4
#: Vectors that the budgets are fitted on, at most; every vector is joined.
SAMPLE = 2_000
#: Vectors per pivot aimed at; pivots, and numbers in them, at most.
PER_PIVOT, PIVOTS, PIVOT_NUMBERS = 5_000, 8_192, 1 << 20
#: Bytes of a tile's vectors at most, and tiles that a table gets at least, if they have ``SQUARE`` rows.
TILE_BYTES, TILES = 10 << 20, 12
#: Tasks, for each tile, that its pairs with the others are dealt to.
TASKS = 4
#: Cells whose borders are measured at once; rows multiplied at once of two cells, and of one.
CELLS, STRIP, SQUARE = 32, 64, 1_000
#: Coordinates that a pair is tested by first.
LEAD = 28
SEED = 7
SLACK = 1e-9


@dataclass
class Space:
    """The rotation of one vector length, the columns and budgets of its blocks,
    the whole squared budget and the rotated pivots."""

    rotation: np.ndarray
    columns: list[slice]
    budget: list[float]
    whole: float
    pivots: np.ndarray

    def cells(self, turned: np.ndarray) -> np.ndarray:
        return (turned @ self.pivots.T).argmax(axis=1).astype(np.int64)


def unit_vectors(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)  # no overflow in the norm
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, pivots: int, cosine: float = COSINE, blocks: int = BLOCKS, seed: int = SEED) -> Space:
    """Rotation, budgets and pivots from a bounded sample of unit vectors."""
    dim = sample.shape[1]
    rotation, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    edges = np.linspace(0, dim, min(blocks, dim) + 1).astype(int)
    columns = [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]
    turned = sample @ rotation
    spread = np.array([turned[:SAMPLE, c].var(axis=0).sum() + 1e-12 for c in columns])
    budget = list((2 - 2 * cosine) * spread / spread.sum() + SLACK)
    chosen = np.unique(turned[:pivots].astype(np.float32), axis=0)
    return Space(rotation, columns, budget, 2 - 2 * cosine + SLACK, chosen)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _turned(space: Space, raw: np.ndarray) -> np.ndarray:
    """Rotated unit vectors in single precision."""
    out, rotation = np.empty(raw.shape, dtype=np.float32), space.rotation.astype(np.float32)
    for low in range(0, len(raw), SQUARE):
        v = raw[low: low + SQUARE]
        v = (v / np.abs(v).max(axis=1, keepdims=True)).astype(np.float32)  # no overflow in the norm
        out[low: low + SQUARE] = (v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]) @ rotation
    return out


def _homes(space: Space, raw: np.ndarray) -> np.ndarray:
    return np.concatenate([space.cells(_turned(space, raw[low: low + SQUARE]))
                           for low in range(0, len(raw), SQUARE)])


def _sizes(space: Space, dim: int):
    """Rows per cell in a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(space.pivots), dtype=np.int64)
        for b in batches:
            if b.num_rows:
                total += np.bincount(_homes(space, _matrix(b.column(0), dim)), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "size"])
    return count


def layout(sizes: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first tile, tiles) of each cell, and the number of tiles: a cell of over
    ``tile`` rows has several of its own, smaller ones share tiles."""
    several = np.maximum(1, -(-sizes // tile))
    first, n, held = np.zeros(len(sizes), dtype=np.int64), 0, 0
    for c in np.flatnonzero(several == 1):
        if held + sizes[c] > tile:
            n, held = n + 1, 0
        first[c], held = n, held + sizes[c]
    n += 1
    for c in np.flatnonzero(several > 1):
        first[c], n = n, n + several[c]
    return first, several, int(n)


def _place(space: Space, dim: int, first: np.ndarray, several: np.ndarray):
    """Rows with their tile and cell; the rows of a cell that has several tiles are dealt by their hash."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cell = _homes(space, _matrix(b.column(3), dim))
            tile = first[cell] + b.column(1).to_numpy() % several[cell]
            yield pa.RecordBatch.from_arrays([pa.array(tile.astype(np.int32)), pa.array(cell), *b.columns],
                                             names=["tile", "cell", *b.schema.names])
    return place


def _pack(dim: int):
    """The rows of a partition, which are those of a tile, as one row of bytes, sorted by cell."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        tile = held[0].column(0)[0].as_py()
        numbers = [np.concatenate([b.column(i).to_numpy() for b in held]) for i in (1, 2, 3, 4)]
        raw = np.concatenate([_matrix(b.column(5), dim) for b in held])
        del held
        order = np.argsort(numbers[0], kind="stable")
        packed = [x[order].tobytes() for x in (*numbers, raw)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([tile], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]],
            names=["tile", "cell", "rep", "ck", "copies", "vectors"])
    return pack


class _Tile:
    """A tile's arrays; rows of one cell are next to each other."""

    def __init__(self, space: Space, row: dict[str, pa.Scalar], dim: int, kind: type):
        self.id = row["tile"].as_py()
        cell, self.rep, self.ck, self.copies = (
            np.frombuffer(row[k].as_buffer(), np.int64) for k in ("cell", "rep", "ck", "copies"))
        self.raw = np.frombuffer(row["vectors"].as_buffer(), kind).reshape(-1, dim)  # a view of the batch
        self.turned = _turned(space, self.raw)
        self.start = np.flatnonzero(np.diff(cell, prepend=-1))
        self.end = np.append(self.start[1:], len(cell))
        self.cell = cell[self.start]

    def border(self, space: Space, own: range, others: np.ndarray) -> np.ndarray:
        """For each of ``others`` (pivots) and each row of the cells ``own``: its
        product with its own pivot less that with the other."""
        low = self.start[own[0]]
        turned = self.turned[low: self.end[own[-1]]]
        home = np.concatenate([self.turned[self.start[i]: self.end[i]] @ space.pivots[self.cell[i]] for i in own])
        return home[None, :] - space.pivots[others] @ turned.T


def _beside(v: np.ndarray, left: bool) -> np.ndarray:
    """Vectors with their norms put beside them, so that a product of left and right
    ones is minus half their squared distance."""
    half = -(v * v).sum(axis=1, keepdims=True) / 2
    ones = np.ones_like(half)
    return np.concatenate([v, *((half, ones) if left else (ones, half))], axis=1).astype(np.float32)


def _within(x: np.ndarray, y: np.ndarray, budget: float) -> np.ndarray:
    """Pairs whose squared distance may be within ``budget``, in single precision."""
    return _beside(x, True) @ _beside(y, False).T >= np.float32(-budget / 2 - 1e-4)


def _meetings(space: Space, a: _Tile, b: _Tile) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple]]]:
    """(rows of ``a``, rows of ``b``, rectangles) of two cells: every pair within the
    whole budget is in a rectangle, (low, high, left, right, whether only pairs above
    its diagonal count), of places in the rows."""
    radius, slack = np.sqrt(space.whole), 1e-5 + 2.5e-7 * space.pivots.shape[1]
    for i in range(0, len(a.cell), CELLS):
        own = range(i, min(i + CELLS, len(a.cell)))
        for j in range(i if a is b else 0, len(b.cell), CELLS):
            other = range(j, min(j + CELLS, len(b.cell)))
            x, y = a.border(space, own, b.cell[j: other[-1] + 1]), b.border(space, other, a.cell[i: own[-1] + 1])
            at_x, at_y = a.start[own] - a.start[i], b.start[other] - b.start[j]
            p, q = (space.pivots[t].astype(np.float64) for t in (a.cell[own], b.cell[other]))
            gap = np.sqrt(np.maximum((p * p).sum(axis=1)[:, None] + (q * q).sum(axis=1) - 2 * p @ q.T, 0))
            most = radius * gap + slack
            least_x, least_y = np.minimum.reduceat(x, at_x, axis=1).T, np.minimum.reduceat(y, at_y, axis=1)
            meet = least_x + least_y <= most
            if a is b:
                meet &= np.arange(i, own[-1] + 1)[:, None] <= np.arange(j, other[-1] + 1)
            for k, m in zip(*(t.tolist() for t in np.nonzero(meet))):
                rows, cols = np.arange(a.start[i + k], a.end[i + k]), np.arange(b.start[j + m], b.end[j + m])
                if a.cell[i + k] == b.cell[j + m]:  # one cell: no border
                    yield rows, cols, [
                        (low, low + SQUARE, left, left + SQUARE, a is b and low == left)
                        for low in range(0, len(rows), SQUARE) for left in range(low if a is b else 0, len(cols), SQUARE)]
                    continue
                far_x = x[m, at_x[k]: at_x[k] + len(rows)]
                far_y = y[k, at_y[m]: at_y[m] + len(cols)]
                by_x = np.flatnonzero(far_x <= most[k, m] - least_y[k, m])
                by_y = np.flatnonzero(far_y <= most[k, m] - least_x[k, m])
                by_x, by_y = by_x[far_x[by_x].argsort()], by_y[far_y[by_y].argsort()]
                ends = far_y[by_y].searchsorted(most[k, m] - far_x[by_x[::STRIP]], side="right").tolist()
                yield rows[by_x], cols[by_y], [(low, low + STRIP, 0, end, False)
                                               for low, end in zip(range(0, len(by_x), STRIP), ends) if end]


def _merge(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the groups of ``u`` and ``v``; ``root`` holds each one's smallest member."""
    while True:
        u, v = root[u], root[v]
        apart = u != v
        if not apart.any():
            return
        u, v = u[apart], v[apart]
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root[:] = root[root]


def _linked(space: Space, a: _Tile, b: _Tile, cosine: float) -> Iterator[pa.RecordBatch]:
    """The linked vectors of two tiles (or of one): how many vectors each links,
    and the smallest id of its component inside the tiles."""
    tiles = [a] if a is b else [a, b]
    rep, ck, copies = (np.concatenate([getattr(t, k) for t in tiles]) for k in ("rep", "ck", "copies"))
    shift, weight = len(a.raw) if len(tiles) > 1 else 0, copies.astype(np.float64)
    n, root = np.zeros(len(rep)), np.arange(len(rep))
    threshold = np.float32(-space.whole / 2 - 1e-4)
    lead_a, lead_b = _beside(a.turned[:, :LEAD], True), _beside(b.turned[:, :LEAD], False)
    apart: list[tuple[np.ndarray, np.ndarray]] = []
    squares = ((rows, cols, p, q, r) for rows, cols, found in _meetings(space, a, b)
               for p, q in [(lead_a.take(rows, axis=0), lead_b.take(cols, axis=0).T)] for r in found)
    for rows, cols, p, q, (low, high, left, right, above) in squares:
        half = p[low:high] @ q[:, left:right]
        if half.max() < threshold:
            continue
        near, x, y = half >= threshold, rows[low:high], cols[left:right]
        if above:
            near &= np.tri(len(x), len(y), -1, dtype=bool).T
        if not near.any():
            continue
        keep_x, keep_y = near.any(axis=1), near.any(axis=0)
        x, y, near = x[keep_x], y[keep_y], near[np.ix_(keep_x, keep_y)]
        share = np.zeros_like(near)
        for c, budget in zip(space.columns, space.budget):  # the pigeonhole
            share |= _within(a.turned[x, c], b.turned[y, c], budget)
        near &= share
        if not near.any():
            continue
        keep_x, keep_y = near.any(axis=1), near.any(axis=0)
        x, y, near = x[keep_x], y[keep_y], near[np.ix_(keep_x, keep_y)]
        near &= unit_vectors(a.raw[x].astype(np.float64)) @ unit_vectors(b.raw[y].astype(np.float64)).T >= cosine
        if not near.any():
            continue
        y = y + shift
        n[x] += near @ weight[y]
        n[y] += near.T @ weight[x]
        i, j = np.nonzero(near & (root[x][:, None] != root[y][None, :]))
        apart.append((x[i], y[j]))
        if sum(len(u) for u, _ in apart) > SQUARE:
            _merge(root, *(np.concatenate(t) for t in zip(*apart)))
            apart = []
    if apart:
        _merge(root, *(np.concatenate(t) for t in zip(*apart)))
    label = np.full(len(rep), np.iinfo(np.int64).max)
    np.minimum.at(label, root, rep)
    at = np.flatnonzero(n)
    for low in range(0, len(at), 10 * SQUARE):
        r = at[low: low + 10 * SQUARE]
        yield pa.RecordBatch.from_arrays(
            [pa.array(t) for t in (rep[r], ck[r], n[r].astype(np.int64), label[root[r]])],
            names=["rep", "ck", "n", "label"])


def _links(space: Space, dim: int, cosine: float, kind: type):
    """Rows of two tiles -> their linked vectors."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = None
        for batch in batches:
            for i in range(batch.num_rows):
                one, other = ({k[2:]: batch.column(k)[i] for k in batch.schema.names if k[:2] == side}
                              for side in ("a_", "b_"))
                if a is None or a.id != one["tile"].as_py():
                    a = None  # before the next one is made
                    a = _Tile(space, one, dim, kind)
                b = a if a.id == other["tile"].as_py() else _Tile(space, other, dim, kind)
                yield from _linked(space, a, b, cosine)
                del one, other, b
            del batch
    return link


def _joined(classes: DataFrame, dim: int, n: int, cosine: float, tile: int | None) -> DataFrame:
    """(rep, ck, n, label) rows of all ``n`` vectors of one length."""
    single = classes.schema["embedding"].dataType.simpleString() == "array<float>"
    array, kind = ("array<float>", np.float32) if single else ("array<double>", np.float64)
    own = classes.where(F.size("embedding") == dim).select(
        "rep", "ck", "copies", F.col("embedding").cast(array).alias("embedding"))
    pivots = max(1, min(n // PER_PIVOT, PIVOTS, PIVOT_NUMBERS // dim))
    wanted = max(SAMPLE, pivots)
    draw = F.xxhash64(F.lit(SEED), "embedding")
    share = min(1 << 20, -(-(wanted * 5 // 4 << 20) // n))  # of 2^20: about wanted * 5 / 4 vectors
    first = own.where(F.pmod(draw, F.lit(1 << 20)) < share).orderBy(F.xxhash64(F.lit(~SEED), "embedding"), "rep")
    sample = unit_vectors(_matrix(first.limit(wanted).select("embedding").toArrow().column("embedding"), dim).astype(np.float64))
    space = fit(sample, pivots, cosine)
    sizes = np.zeros(len(space.pivots), dtype=np.int64)
    for r in own.select("embedding").mapInArrow(_sizes(space, dim), "cell long, size long").groupBy("cell").agg(
            F.sum("size").alias("size")).collect():  # a row per pivot
        sizes[r.cell] = r.size
    rows = tile or max(1, min(TILE_BYTES // (dim * np.dtype(kind).itemsize), max(n // TILES, SQUARE)))
    first, several, n_tiles = layout(sizes, rows)
    placed = own.mapInArrow(_place(space, dim, first, several),
                            f"tile int, cell long, rep long, ck long, copies long, embedding {array}")
    tiles = cut(placed.repartitionById(n_tiles, F.col("tile")).mapInArrow(
        _pack(dim), "tile int, cell binary, rep binary, ck binary, copies binary, vectors binary"))
    left, right = (tiles.select(*[F.col(c).alias(f"{side}_{c}") for c in tiles.columns]) for side in "ab")
    # a task reads one tile of either side at a time: no shuffle, no copies
    pairs = left.join(right.hint("shuffle_replicate_nl"), F.col("a_tile") <= F.col("b_tile")).coalesce(TASKS * n_tiles)
    return pairs.mapInArrow(_links(space, dim, cosine, kind), "rep long, ck long, n long, label long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, tile: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked directly),
    component_id (smallest id reachable), kept (vec_id = component_id)."""
    e = F.col("embedding")
    sound = (F.col("vec_id").isNotNull() & (F.size(e) > 0)
             & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists(e, lambda x: x != 0))
    # 128 bits of hash stand for a vector when its class is joined back
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumns({
        "ck": F.when(F.coalesce(sound, F.lit(False)), F.xxhash64("embedding")),
        "ck2": F.xxhash64(F.lit(SEED), "embedding")})
    classes, drop = stored(rows.where("ck is not null").groupBy("embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("ck").alias("ck"),
        F.first("ck2").alias("ck2")))
    dims = sorted(classes.groupBy(F.size("embedding")).count().collect())
    none = vectors.sparkSession.createDataFrame([], "rep long, ck long, n long, label long")
    joins = [_joined(classes, d, n, cosine, tile) for d, n in dims]
    classes = written(classes.select("rep", "ck", "ck2", "copies"))
    drop()  # the tiles hold the vectors now
    with single_rows(vectors.sparkSession):
        found = cut(reduce(DataFrame.union, joins, none))
    counts = found.groupBy("rep", "ck").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("label").alias("b")))
    known = (classes.join(counts, ["rep", "ck"], "left")
             .join(groups, F.col("rep") == F.col("node"), "left")
             .select("ck", "ck2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    return (rows.select("vec_id", "ck", "ck2").join(known, ["ck", "ck2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op2_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
component AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component c ON vec_id = c.x LEFT JOIN degree d ON vec_id = d.x
"""
