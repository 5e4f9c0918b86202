"""op2 over many cells and tiles, against all pairs; what it takes of the disk."""

import contextlib
import os
import threading

import numpy as np
import pytest

from tapflow.llm import embeddings
from tapflow.session import shared_dir


def crowd(n: int, dim: int, seed: int) -> np.ndarray:
    """Random vectors, one large group of near copies and many pairs near the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[: n // 10] = x[0] + rng.standard_normal((n // 10, dim)) * 0.1
    x[n // 2: n // 2 + n // 5] = x[n // 4: n // 4 + n // 5] + rng.standard_normal((n // 5, dim)) * 0.33
    return x.astype(np.float32)


def table_of(spark, x: np.ndarray):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<float>")


def all_pairs(x: np.ndarray) -> tuple[list[int], list[int]]:
    u = embeddings.unit_vectors(x.astype(np.float64))
    links = (u @ u.T >= embeddings.COSINE) & ~np.eye(len(u), dtype=bool)
    label, before = np.arange(len(u)), None
    while before is None or (before != label).any():
        before, label = label, np.minimum(label, np.where(links, label[None, :], len(u)).min(axis=1))
    return links.sum(axis=1).tolist(), label.tolist()


@pytest.mark.parametrize("per_pivot, tile", [(20, 150), (200, None)])
def test_cells_and_tiles_miss_no_pair(spark, monkeypatch, per_pivot, tile):
    monkeypatch.setattr(embeddings, "PER_PIVOT", per_pivot)
    x = crowd(1_200, 24, 3)
    got = embeddings.near_duplicates(table_of(spark, x), tile=tile).orderBy("vec_id").collect()
    n_links, label = all_pairs(x)
    assert 0 < sum(n > 0 for n in n_links) < len(x)
    assert [r.n_links for r in got] == n_links
    assert [r.component_id for r in got] == label


def test_layout_splits_large_cells():
    first, several, n = embeddings.layout(np.array([5, 0, 31, 6, 4]), 10)
    assert several.tolist() == [1, 1, 4, 1, 1]
    assert first.tolist() == [0, 0, 2, 1, 1] and n == 6


def folder_bytes(root: str) -> int:
    total = 0
    for d, _, names in os.walk(root):
        for f in names:
            with contextlib.suppress(OSError):  # it may go meanwhile
                total += os.path.getsize(os.path.join(d, f))
    return total


def test_disk_does_not_follow_cells_and_tiles(spark):
    """Shuffles and the shared folder together take less than four times the vectors at
    any time; copies for every block, guest and tile took far more."""
    x = crowd(6_000, 64, 5)
    vectors = table_of(spark, x).repartition(4).cache()
    vectors.count()
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    dirs.append(shared_dir(spark).removeprefix("file:"))
    seen, over = [sum(map(folder_bytes, dirs))], threading.Event()

    def watch() -> None:
        while not over.wait(0.02):
            seen.append(sum(map(folder_bytes, dirs)))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert embeddings.near_duplicates(vectors, tile=500).count() == len(x)
    finally:
        over.set()
        watcher.join()
    vectors.unpersist()
    assert max(seen) - seen[0] < 4 * x.nbytes
